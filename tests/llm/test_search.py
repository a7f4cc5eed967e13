"""Ranked search against plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest

from tarmac.llm import queries, search
from tarmac.llm.oracle import ORACLE_SQL
from tarmac.llm.search import Lists, rank_documents, terms_of_text

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(TERM.findall((text or "").translate(brute.LOWER)))


def ranked(docs, items, k=20):
    """(item, rank, document, score) from scores of all documents."""
    own = [(d, terms(t)) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    df = Counter(t for _, c, _ in own for t in c)
    documents, length = len(own), sum(n for _, _, n in own)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in own:
            m = 75 + (25 * n * documents) // length
            score = sum(
                q * math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, q in terms(text).items()
                if t in c
            )
            if score > 0:
                scores.append((-score, d is not None, d, score))
        scores.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, rank, d, score) for rank, (_, _, d, score) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def small(seed=1, n=300):
    draw = random.Random(seed)
    words = ["a", "B", "été", "x1", "long", "rare" + str(seed), "漢字", "zz", "it"] + [f"w{i}" for i in range(40)]
    text = lambda m: "".join(draw.choices(words, k=1)[0] + draw.choice([" ", ",", "-", "\x00", "\n"]) for _ in range(m))
    docs = [(i, text(draw.randint(0, 30))) for i in range(n)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (901, None), (902, ""), (903, "..."), (904, "long it " * 40_000)]
    items = [(i, text(draw.randint(1, 25))) for i in range(12)] + [(20, None), (21, "?"), (22, "nowhere"), (3, "a a b"), (None, "zz it")]
    return docs, items


@pytest.mark.parametrize("parts", [1, 5])
def test_against_all_scores(spark, parts):
    docs, items = small()
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, score int").repartition(parts)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id bigint, text string, rank int")
    got = rank_documents(d, i)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items)


def test_blocks_of_queries_and_other_k(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_QUERIES", 4)
    docs, items = small(2, 120)
    d, i = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(map(tuple, rank_documents(d, i, k=3).collect()), key=str) == ranked(docs, items, 3)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    i = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    for x, y in ((d.limit(0), i), (d, i.limit(0)), (d.limit(0), i.limit(0))):
        got = rank_documents(x, y)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert got.collect() == []


def test_reading_stops_early_and_stays_exact(monkeypatch):
    monkeypatch.setattr(search, "FIRST_READ", 2)
    draw = np.random.default_rng(3)
    size, many = 3000, 6
    entries = np.flatnonzero(draw.random(size * many) < 0.3)
    doc, term = entries // many, entries % many
    tf = draw.integers(1, 4, len(doc))
    n = np.maximum(np.bincount(doc, weights=tf, minlength=size).astype(np.int64), 1)
    weights = np.array([5000, 300, 20, 5000, 1, 0])
    lists = Lists(weights, size, int(n.sum()), n, doc, term, tf)
    damped = 75 + (25 * n * size) // int(n.sum())
    for query in ([(0, 1)], [(0, 2), (1, 1), (4, 1)], [(t, 1) for t in range(many)], [(5, 1)]):
        scores = np.zeros(size, np.int64)
        times = np.zeros(many, np.int64)
        for t, c in query:
            times[t] = c
        np.add.at(scores, doc, weights[term] * times[term] * ((10**9 * tf) // (1000 * tf + 12 * damped[doc])))
        want = [d for d in np.lexsort((np.arange(size), -scores)) if scores[d] > 0][:20]
        at, score = lists.best(query, 20, np.arange(size))
        assert at[:20].tolist() == want
        assert score[:20].tolist() == scores[want].tolist()


def test_terms():
    assert terms_of_text("Ab-c1_d[E]{f}é\x00É\x7f9") == [b"ab", b"c1", b"d", b"e", b"f", "é".encode(), "É".encode(), b"9"]
    assert terms_of_text(None) == []


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    own = queries.op13_nra_search(spark, folder)
    got = con.execute(ORACLE_SQL["op13_nra_search"])
    assert [d[0] for d in got.description] == own.columns
    assert sorted(map(tuple, own.collect())) == sorted(got.fetchall())
