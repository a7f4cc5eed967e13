"""Phrase mining against plain Python on small tables."""

import random
import re
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tarmac.llm import phrases, queries
from tarmac.llm.oracle import ORACLE_SQL
from tarmac.llm.phrases import Trie, Words, mine_phrases

SCHEMA = "doc_id bigint, text string, lang string"


def mined(rows, longest=3, min_count=10, shadow_pct=50, top=2000):
    """All result rows, from plain counts of all phrases."""
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    frequent = {k: a for k, a in counts.items() if len(k) > 2 and a >= min_count}
    longer = defaultdict(int)
    for (lang, *w), a in frequent.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                longer[lang, *w[i : i + n]] = max(longer[lang, *w[i : i + n]], a)
    found = defaultdict(list)
    for key, a in frequent.items():
        if longer[key] and 100 * longer[key] >= shadow_pct * a:
            continue
        lang, *w = key
        sides = [(counts[lang, *w[:c]], counts[lang, *w[c:]]) for c in range(1, len(w))]
        score, _, left, right = min((1_000_000 * a * a // (x * y), c, x, y) for c, (x, y) in enumerate(sides))
        found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    )


def table(n=400, seed=3):
    draw = random.Random(seed)
    words = ["A", "b", "c", "é", "dd", "d", "New", "york", "city", "x" * 300]
    ends = [" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b", "! ", "  "]
    rows = [
        (i, "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 25))), draw.choice(["en", "en", "fr", None]))
        for i in range(n)
    ]
    return [*rows, (1, None, "en"), (None, "", None), (2, "new york city " * 3000, "en"), (3, "lone", "xx"), (3, "lone", "xx")]


@pytest.mark.parametrize("tries", [500_000, 7])
def test_against_plain_counts(spark, monkeypatch, tries):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", tries)
    monkeypatch.setattr(phrases, "TRIE_BYTES", 24 * tries)
    rows = table(150 if tries == 7 else 400)
    docs = spark.createDataFrame([(*r, "u") for r in rows], SCHEMA + ", phrase string").repartition(3)
    min_count = 40 if tries == 7 else 10
    assert sorted(map(tuple, mine_phrases(docs, min_count=min_count).collect())) == mined(rows, min_count=min_count)


def test_longer_phrases_and_a_small_top(spark):
    rows = table(200, 8)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mine_phrases(docs, longest=4, min_count=5, shadow_pct=80, top=9)
    assert sorted(map(tuple, got.collect())) == mined(rows, 4, 5, 80, 9)


def test_saturated_bitmaps_lose_nothing(spark, monkeypatch):
    rows = table(200, 4)
    monkeypatch.setattr(phrases, "_bitmap", lambda hashes: np.full(1 << 23, 255, np.uint8))
    got = mine_phrases(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect())) == mined(rows)


def test_hashes_travel_many_to_a_row(spark, monkeypatch):
    rows = [(i, f"w{i} w{i % 7} v{i % 11}. w{i % 3}", "en") for i in range(600)]
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("lang", "text AS body").coalesce(1)
    for parts in (1, 5):
        sums = phrases._sums(texts, 1, [], 10, parts)
        got = [r.hash for r in sums.collect()]
        words = Counter(w for _, t, _ in rows for w in t.replace(".", "").split())
        assert len(got) == len(set(got)) == sum(n >= 10 for n in words.values())
        plan = sums._jdf.queryExecution().toString()
        assert "hashes" in plan and "HashAggregate" not in plan


def test_tries_hold_ranges_within_their_bounds(monkeypatch):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 10)
    monkeypatch.setattr(phrases, "TRIE_BYTES", 100)
    assert phrases._tries([]) == []
    got = phrases._tries([(0, 4, 20), (1, 5, 30), (3, 3, 9), (4, 25, 50), (5, 2, 150)])
    assert got == [[(0, 1, 4), (1, 1, 5)], [(3, 1, 3)], [(4, 1, 9)], [(4, 10, 18)], [(4, 19, 25), (5, 1, 1)], [(5, 2, 2)]]


def test_passes_over_the_texts_do_not_follow_the_phrases(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 7)
    rows = table(120, 5)
    docs = spark.createDataFrame(rows, SCHEMA)
    passes, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *args: passes.append(args) or real(self, *args))
    assert sorted(map(tuple, mine_phrases(docs).collect())) == mined(rows)
    # One for each level, one that counts phrases, one that counts all words.
    assert len(passes) == 5


def test_words_of_each_language(spark):
    rows = table(50, 6)
    expected = Counter()
    for _, text, lang in rows:
        expected[lang or "und"] += len(re.findall(r"[^\x20\x09-\x0D.,;:!?]+", text or ""))
    docs = spark.createDataFrame([*rows, (9, " , ", "none"), (9, "a b", "")], SCHEMA)
    assert dict(map(tuple, phrases.word_totals(docs).collect())) == expected | {"none": 0, "": 2}


class Here:
    """Runs a function on batches in this process."""

    def __init__(self, *batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        self.given = list(run(iter(self.batches)))
        return self

    def groupBy(self, name):
        return self

    def applyInArrow(self, run, schema):
        whole = pa.Table.from_batches(self.given)
        parts = whole["part"].unique().to_pylist()
        return pa.concat_tables(run(whole.filter(pa.compute.field("part") == x)) for x in parts)


@pytest.mark.parametrize("buffered, tries, one_hash", [(1_000_000, 500_000, False), (40, 3, False), (200, 5, True)])
def test_phrases_meet_whatever_their_hashes(monkeypatch, buffered, tries, one_hash):
    draw = random.Random(5)
    words = ["a", "b", "ab", "eight888", "eight889", "é" * 9, "é" * 8 + "e", "x" * 300]
    texts = [" ".join(draw.choices(words, k=draw.randint(0, 9))) + draw.choice(["", ". ", "\n"]) for _ in range(90)]
    langs = [draw.choice(["en", "fr", "e\nn", ""]) for _ in texts]
    monkeypatch.setattr(phrases, "BUFFERED_PHRASES", buffered)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    monkeypatch.setattr(phrases, "WALKED", 11)
    monkeypatch.setattr(phrases, "TRIE_PHRASES", tries)
    if one_hash:
        monkeypatch.setattr(Words, "hashes", lambda self, langs, words, at: np.full(len(at), 77, np.uint64))
    cut = lambda rows: pa.RecordBatch.from_arrays([pa.array(langs[rows]), pa.array(texts[rows])], names=["lang", "body"])
    met = phrases._met(Here(cut(slice(0, 50)), cut(slice(50, None))), 3, [], 4)
    got = {(k, size): f for k, f, size in zip(*phrases._counted(met, 4, 2).to_pydict().values(), strict=True)}
    expected = Counter()
    for lang, text in zip(langs, texts, strict=True):
        w = text.rstrip(". \n").split()
        expected.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert got == {(f"{lang}\n{' '.join(w)} ".encode(), len(w)): n for (lang, *w), n in expected.items() if n >= 2}


def test_a_trie_takes_few_bytes_a_state():
    trie = Trie(pa.array(sorted(f"en\n{i:07d} ".encode() for i in range(0, 90_000, 9))))
    states = len(trie.check)
    assert sum(x.nbytes for x in vars(trie).values()) <= 9 * states + 4 * 10_000
    ends = np.array([trie.after(f"en\n{i:07d} ".encode()) for i in (0, 9, 89_991)])
    assert trie.number(ends).tolist() == [0, 1, 9999] and len(trie.number(ends - 1)) <= 2


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "only once", "en"), (2, None, None)], SCHEMA)
    assert mine_phrases(docs).collect() == []
    assert mine_phrases(docs.limit(0)).collect() == []


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    a = 987_654_321_987
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(a + 1).alias("l"), F.lit(a + 2).alias("r"))
    got = row.select(phrases._floor_share(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 1_000_000 * a * a // ((a + 1) * (a + 2))


def test_words_and_trie():
    text = "Ab  c,d".encode()
    words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert words.bytes.tobytes() == b"ab c\nd\n"
    keys = sorted(["en\nab ", "en\nab c ", "en\nd ", "fr\nab ", "en\nc d "], key=str.encode)
    trie = Trie(pa.array([k.encode() for k in keys]))
    met = trie.accepted(words, np.array([trie.after(b"en\n")]))
    assert sorted(keys[i] for i in met) == ["en\nab ", "en\nab c ", "en\nd "]
    assert trie.after(b"es\n") == -1


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    own = queries.op12_phrase_collocations(spark, folder)
    got = con.execute(ORACLE_SQL["op12_phrase_collocations"])
    assert [d[0] for d in got.description] == own.columns
    assert [t for _, t in own.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert sorted(map(tuple, own.collect())) == sorted(got.fetchall())
