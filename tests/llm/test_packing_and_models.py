"""Packing by exact round trip, both trained models against plain Python and held-out rows."""

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import cross_entropy, nbsvm, packing
from tarmac.llm.cross_entropy import cross_entropy_difference
from tarmac.llm.hashing import text_bytes
from tarmac.llm.queries import op8_nbsvm_quality

PACKING = public_tokenizers.path("byte_bpe_50k.json")


def check_windows(pieces, window):
    """Sequences have no gaps and no overlaps; only the last one of a task may be open."""
    sequences = defaultdict(list)
    for p in pieces:
        assert 1 <= p.length <= window and len(p.ids) == 4 * p.length
        sequences[p.sequence_id].append((p.offset, p.length))
    for number, own in sequences.items():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= window
        if end < window:
            assert number == max(s for s in sequences if s >> 40 == number >> 40)


@pytest.mark.parametrize(("window", "shard_docs", "partitions"), [(1024, 256, 1), (16, 3, 2), (1, 2, 1)])
def test_pieces_give_back_every_token(spark, window, shard_docs, partitions):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    texts = [prose(rng.choice([1, 4, 30, 90])) for _ in range(40)]
    texts += [texts[0]] * 20 + [None, "", " ", "it's <|endoftext|> here", "é漢\U0001f600\n\n\tx", prose(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("ids", F.lit("x"))
    docs = docs.withColumn("id", F.lit(0)).repartition(partitions)
    pieces = packing.pack_documents(docs, PACKING, public_tokenizers.PATTERN, window=window, shard_docs=shard_docs).collect()
    check_windows(pieces, window)
    library = Tokenizer.from_file(PACKING)
    of_doc = defaultdict(list)
    for p in pieces:
        of_doc[p.doc_id].append(p)
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids + [packing.END]
        got = []
        for p in sorted(of_doc[i], key=lambda p: p.start):
            assert p.start == len(got) and p.doc_tokens == len(want)
            got += np.frombuffer(p.ids, "<u4").tolist()
        assert got == want


def test_packing_repeated_rows_missing_ids_and_no_rows(spark):
    rows = [(None, "a b c"), (None, "a b c"), (4, "d"), (4, "d"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pieces = packing.pack_documents(docs, PACKING, public_tokenizers.PATTERN).collect()
    assert Counter(p.doc_id for p in pieces) == {None: 2, 4: 3}
    check_windows(pieces, packing.WINDOW)
    assert packing.pack_documents(docs.limit(0), PACKING, public_tokenizers.PATTERN).count() == 0


def test_long_texts_are_encoded_by_pieces_alike(monkeypatch):
    text = "Plain words, it's 12345 é漢\U0001f600\n\n  \tx " * 50
    whole = packing.Pieces(PACKING, public_tokenizers.PATTERN).encode(text)
    monkeypatch.setattr(packing, "LONG_TEXT", 10)
    monkeypatch.setattr(packing, "KEPT_PIECES", 3)
    parts = packing.Pieces(PACKING, public_tokenizers.PATTERN).encode(text)
    assert list(whole) == list(parts) == Tokenizer.from_file(PACKING).encode(text, add_special_tokens=False).ids


def test_single_white_space_needs_no_looking_ahead():
    pieces, library = packing.Pieces(PACKING, public_tokenizers.PATTERN), Tokenizer.from_file(PACKING)
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\x85", "\x1c", "\x1f", "\xa0", "\u3000", "\u200b", "a", "the", "'s", "'ll", "É", "1", "!", "漢"]
    for text in ["", " ", "a ", " a", "\n", *("".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(2000))]:
        assert list(pieces.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)
    asked = []
    pieces.whole = lambda text: asked.append(text) or []
    text = "Plain words, it's 12345 é漢\U0001f600\nx\x85y "
    assert list(pieces.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert asked == [] and list(pieces.encode("two  spaces")) == [] and asked == ["two  spaces"]


def test_scores_from_table_and_postings_are_equal(monkeypatch):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 200, n).astype(np.uint16) for n in rng.integers(1, 400, 60)]
    idf = rng.random(201)
    table = packing.Shard(docs, idf, 100.0)
    monkeypatch.setattr(packing, "TABLE_SHARE", 0)
    postings = packing.Shard(docs, idf, 100.0)
    assert table.table is not None and postings.table is None
    for terms in [*table.terms, np.array([200]), np.array([5, 200])]:
        assert table.scores(terms).tolist() == postings.scores(terms).tolist()


def test_distinct_ranks():
    rng = np.random.default_rng(3)
    stamp = np.zeros(50, np.int64)
    for n in (0, 1, 7, 300):
        ranks = rng.integers(0, 50, n)
        assert np.sort(packing._distinct(ranks, stamp)).tolist() == np.unique(ranks).tolist()


def test_shard_scores_are_bm25():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 30, n).astype(np.uint16) for n in (3, 10, 40, 1)]
    idf, mean = rng.random(31), 12.5
    index = packing.Shard(docs, idf, mean)
    seed = np.array([0, 3, 7, 29, 30])
    for score, ids in zip(index.scores(seed), docs, strict=True):
        tf = Counter(ids.tolist())
        norm = packing.K1 * (1 - packing.B + packing.B * len(ids) / mean)
        want = sum(idf[t] * tf[t] * (packing.K1 + 1) / (tf[t] + norm) for t in seed.tolist() if t in tf)
        assert score == pytest.approx(want)


def brute_losses(docs, vocabulary, smoothing=16.0):
    """Words and both models' mean losses by document; docs are (id, text, target)."""
    words = {d: brute.WORD.findall(t or "") for d, t, _ in docs}
    frequency = Counter(w for ws in words.values() for w in ws)
    ranked = frequency.most_common()
    assert vocabulary >= len(ranked) or ranked[vocabulary - 1][1] > ranked[vocabulary][1]
    known = {w for w, _ in ranked[:vocabulary]}
    size = len(known) + 1
    lists = {d: ["<start>"] + [w if w in known else "<unknown>" for w in ws] for d, ws in words.items()}
    out = {d: [len(ws)] for d, ws in words.items()}
    for model in ("target", "all"):
        single, history, pairs = Counter(), Counter(), Counter()
        for d, _, target in docs:
            if model == "all" or target:
                single.update(lists[d][1:])
                history.update(lists[d][:-1])
                pairs.update(zip(lists[d], lists[d][1:], strict=False))
        total = sum(single.values())
        for d, ws in lists.items():
            loss = 0.0
            for a, b in zip(ws, ws[1:], strict=False):
                share = (single[b] + 1) / (total + size)
                loss -= math.log((pairs[a, b] + smoothing * share) / (history[a] + smoothing))
            out[d].append(loss / (len(ws) - 1) if len(ws) > 1 else None)
    return out


@pytest.mark.parametrize(("cut", "frequent", "part"), [(None, 512, 4_000_000), (None, 3, 40), (12, 4, 25), (0, 2, 10)])
def test_cross_entropy_matches_plain_python(spark, cut, frequent, part):
    rng = random.Random(8)
    # The word wk is in the corpus often enough for its place to be certain.
    pool = [w for k in range(30) for w in [f"w{k}"] * (2 * (31 - k))]
    rng.shuffle(pool)
    docs, at = [], 0
    while at < len(pool):
        n = rng.choice([1, 2, 10, 60])
        docs.append((len(docs), "  ".join(pool[at : at + n]), rng.choice([True, False, None])))
        at += n
    docs += [(1000, None, True), (1001, "", False), (1002, " \n", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, target boolean").withColumn("row", F.lit("x"))
    vocabulary = 100 if cut is None else cut
    out = cross_entropy_difference(df, vocabulary=vocabulary, frequent=frequent, part_bigrams=part).collect()
    want = brute_losses(docs, vocabulary) if vocabulary else None
    assert len(out) == len(docs)
    for r in out:
        if r.doc_id >= 1000:
            assert (r.n_words, r.target_loss, r.background_loss, r.score) == (0, None, None, None)
        elif want:
            n, target, background = want[r.doc_id]
            assert r.n_words == n
            assert (r.target_loss, r.background_loss) == pytest.approx((target, background), abs=1e-8)
            assert r.score == pytest.approx(target - background, abs=1e-8)


@pytest.mark.parametrize(("frequent", "part"), [(512, 4_000_000), (3, 4000), (20, 40_000)])
def test_cross_entropy_knows_every_word(spark, frequent, part):
    # By default no vocabulary ends at 65,536 words: each rare word and bigram here counts by itself.
    rng = random.Random(9)
    docs = []
    for i in range(70):
        words = [f"r{rng.randrange(80_000)}" if rng.random() < 0.9 else f"w{rng.randrange(6)}" for _ in range(1100)]
        words += [f"s{1000 * i + k}" for k in range(1000)]
        docs.append((i, " ".join(words), i % 3 == 0))
    docs += [(90, "r1 r2 s3 r1 r2", True), (91, "s3", False)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, target boolean")
    assert len({w for _, t, _ in docs for w in t.split()}) > 100_000
    want = brute_losses(docs, 1_000_000)
    out = cross_entropy_difference(df, frequent=frequent, part_bigrams=part).collect()
    assert len(out) == len(docs)
    for r in out:
        n, target, background = want[r.doc_id]
        assert r.n_words == n
        assert (r.target_loss, r.background_loss) == pytest.approx((target, background), abs=1e-8)


def test_tokens_are_counted_while_they_are_made():
    # The library's own search for special tokens must have one to look for: none at all costs as much as the encoding.
    library = Tokenizer.from_file(PACKING)
    size = library.get_vocab_size(with_added_tokens=True)
    texts = ["a b a", "", f"so {packing.UNUSED_SPECIAL} é{packing.UNUSED_SPECIAL}", "a<|endoftext|>b", "one two one"]
    batch = pa.RecordBatch.from_pydict({"id": [5, 5, None, 7, 8], "body": texts})
    run = packing._tokens(PACKING, public_tokenizers.PATTERN, "<u2", size)
    out = pa.Table.from_batches(run(iter([batch.slice(0, 3), batch.slice(3)]))).to_pylist()
    want = [library.encode(t, add_special_tokens=False).ids + [packing.END] for t in texts]
    assert [np.frombuffer(r["ids"], "<u2").tolist() for r in out[:-1]] == want
    for r, ids in zip(out, want, strict=False):
        least = np.sort(packing.mix(np.unique(ids).astype(np.uint64) + np.uint64(1)))[: packing.SORT_TOKENS]
        assert r["seen"] is None and r["place"] == least.astype(">u8").tobytes()
    assert out[-1]["ids"] is None
    rows = pa.RecordBatch.from_pydict({"seen": [out[-1]["seen"]] * 2})
    got = {r["token"]: r["n"] for b in packing._frequencies(iter([rows])) for r in b.to_pylist()}
    counts = Counter(i for ids in want for i in set(ids))
    assert got == {**{i: 2 * n for i, n in counts.items()}, -1: 10, -2: 2 * sum(map(len, want))}
    assert list(run(iter([]))) == []
    assert "".join(packing.Pieces(PACKING, public_tokenizers.PATTERN).whole.__closure__[0].cell_contents._special_tokens) != ""


def test_cross_entropy_answers_grow_as_the_input(spark):
    # Sums that parts send back, and rows that carry them: 20 words for each part's worth, then 100.
    made = {}
    for n in (200, 1000):
        rng = random.Random(n)
        docs = [(i, " ".join(f"r{rng.randrange(40 * n)}" for _ in range(100)), i % 3 == 0) for i in range(n)]
        texts = spark.createDataFrame(docs, "row bigint, body string, target boolean").repartition(n // 100)
        hot = cross_entropy.hot_words(texts, None, 4, 125)
        out = cross_entropy.answered(texts, hot, np.zeros((2, hot.width**2), np.int64), 1000).filter("own is null")
        made[n] = out.agg(F.count(F.lit(1)), F.sum(F.length("sums")) / 16).first()
    assert made[1000][0] <= 10 * made[200][0]
    assert made[1000][1] <= 7.5 * made[200][1]


def test_cross_entropy_chunks_and_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(10)
    docs = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 3000}" for _ in range(rng.randrange(300))), i % 4 == 0) for i in range(120)]
    texts = spark.createDataFrame(docs, "row bigint, body string, target boolean").coalesce(1)
    hot = cross_entropy.hot_words(texts, None, 3, 60)
    counts = np.ones((2, hot.width**2), np.int64)
    batch = pa.RecordBatch.from_pandas(texts.toPandas(), preserve_index=False)
    losses = []
    for chunk, block, parts in ((250_000, 1_000_000, 1), (50, 1_000_000, 3), (20, 1, 7)):
        monkeypatch.setattr(cross_entropy, "CHUNK_BIGRAMS", chunk)
        monkeypatch.setattr(cross_entropy, "BLOCK_WORDS", block)
        monkeypatch.setattr("tarmac.llm.hashing.SLICE_BYTES", 1000)
        one_by_one = [batch.slice(i, 1) for i in range(batch.num_rows)]
        asked = pa.Table.from_batches(cross_entropy._requests(hot, counts, parts)(iter(one_by_one))).to_pandas()
        answers = pd.concat([cross_entropy._answers(hot)(g) for _, g in asked.groupby("part")])
        out = pd.concat([cross_entropy._gathered(g) for _, g in answers.groupby("block")])
        losses.append(out.sort_values("row").to_numpy())
    assert len(losses[0]) == len(docs)
    assert losses[1] == pytest.approx(losses[0], abs=1e-8) and losses[2] == pytest.approx(losses[0], abs=1e-8)


def test_cross_entropy_missing_ids_repeated_rows_and_no_rows(spark):
    rows = [(None, "a b", True), (None, "a b", True), (1, "c d", False), (1, "c d", False)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, target boolean")
    out = cross_entropy_difference(df).collect()
    assert Counter(r.doc_id for r in out) == {None: 2, 1: 2}
    assert all((r.score < 0) == (r.doc_id is None) for r in out)
    assert cross_entropy_difference(df.limit(0)).count() == 0


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(2)
    size, n = 60, 300
    rows = [np.unique(rng.integers(0, size, 8)) for _ in range(n)]
    scale, truth = rng.normal(size=size), rng.normal(size=size)
    labels = np.array([1.0 if truth[r].sum() + 0.5 * rng.normal() > 0 else -1.0 for r in rows])
    cost = np.full(n, 0.05)
    weights, bias = nbsvm.dual_descent(rows, labels, scale, cost)
    x = np.zeros((n, size + 1))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
    x[:, size] = 1.0

    def objective(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - labels * (x @ w))).sum()

    # Plain subgradient steps from zero as the other way to the same minimum.
    own, least, w = objective(np.append(weights, bias)), np.inf, np.zeros(size + 1)
    for step in range(1, 20_001):
        active = labels * (x @ w) < 1
        w = w - (w - (cost * labels * active) @ x) / step
        least = min(least, objective(w))
    assert own <= least * 1.005


def training_rows(spark, texts, labels):
    rows = [(i * 2654435761, y, t) for i, (t, y) in enumerate(zip(texts, labels, strict=True))]
    return spark.createDataFrame(rows, "draw bigint, label int, body string")


def test_scores_of_classes_nulls_and_empty_tables(spark):
    rng = random.Random(6)
    word = lambda y: rng.choice(["good", "fine", "clear"] if y else ["spam", "buy", "click"]) if rng.random() < 0.3 else f"w{rng.randrange(50)}"
    labels = [i % 2 for i in range(400)]
    texts = [" ".join(word(y) for _ in range(20)) for y in labels]
    model = nbsvm.fit(training_rows(spark, texts[:300], labels[:300]), fit_rows=100)
    docs = [(i if i else None, t) for i, t in enumerate(texts[300:])] + [(900, None), (900, ""), (901, " ")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit("x"))
    got = [(r.doc_id, r.score) for r in nbsvm.score(df, model).collect()]
    assert len(got) == len(docs) and all(0 <= s <= 1 for _, s in got)
    assert len({s for d, s in got if d in (900, 901)}) == 1
    right = [(s >= 0.5) == bool(labels[300 + (d or 0)]) for d, s in got if d not in (900, 901)]
    assert sum(right) / len(right) >= 0.95
    assert nbsvm.score(df.limit(0), model).count() == 0
    one_class = nbsvm.fit(training_rows(spark, ["a b"], [1]))
    none = nbsvm.fit(training_rows(spark, ["a"], [1]).limit(0))
    assert nbsvm.score(df.limit(1), one_class).first().score > 0.99
    assert nbsvm.score(df.limit(1), none).first().score == pytest.approx(0.5)


def test_ngrams_outside_the_fitted_rows_say_nothing(spark):
    texts = [f"{'good' if i % 2 else 'spam'} w{i} w{i % 7}" for i in range(200)]
    model = nbsvm.fit(training_rows(spark, texts, [i % 2 for i in range(200)]))
    unseen = " ".join(f"unseen{i}" for i in range(60_000))
    docs = [(1, ""), (2, unseen), (3, "good"), (4, f"good {unseen}")]
    got = {r.doc_id: r.score for r in nbsvm.score(spark.createDataFrame(docs, "doc_id bigint, text string"), model).collect()}
    assert got[1] == got[2] and got[3] == got[4] > got[1]


def test_class_counts_are_exact_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(nbsvm, "BLOCK", 100)
    rng = random.Random(4)
    labels = [i % 2 for i in range(600)]
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(9))) for _ in labels]
    want = [Counter(), Counter()]
    for t, y in zip(texts, labels, strict=True):
        words = t.split()
        want[y].update({*words, *zip(words, words[1:], strict=False)})
    rows = training_rows(spark, texts, labels)
    data, offsets = text_bytes(pa.array(texts))
    vocabulary = np.unique(nbsvm.ngrams(data, offsets)[0])
    counts = nbsvm.class_counts(rows, vocabulary)
    assert [sorted(c[c > 0].tolist()) for c in counts] == [sorted(w.values()) for w in want]


def test_held_out_quality(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    got = {r.doc_id: r for r in op8_nbsvm_quality(spark, folder).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for d, r in got.items())
    held = [(got[d].score, y) for d, y in truth.items() if d in got and got[d].held_out]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc >= 0.9, auc

    # Labels of held-out rows have no influence.
    turned = labels.withColumn("quality", F.when(nbsvm.fold("doc_id") == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    turned.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    again = {r.doc_id: r.score for r in op8_nbsvm_quality(spark, str(tmp_path)).collect()}
    assert again == pytest.approx({d: r.score for d, r in got.items()}, abs=1e-6)
