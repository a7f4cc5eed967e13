"""Near-duplicates, suffix arrays and connected components against brute force."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import minhash, suffix_dedup
from tarmac.llm.components import merge_components


def changed(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 40, 120, 300]))] for _ in range(40)]
    docs = [" ".join(b) for b in base]
    for b in base[:15]:
        for _ in range(rng.choice([1, 3])):
            docs.append(" ".join(changed(b, max(1, len(b) // 25), rng)))
    chain = base[-1] + [f"c{i}" for i in range(200)]
    for _ in range(25):
        chain = changed(chain, 3, rng)
        docs.append("  ".join(chain).upper())
    docs += [docs[3], docs[3] + "\n", "", " \t", None]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize(("width", "small", "seed"), [(2, 8, 1), (5, 2, 2), (3, 2, 3)])
def test_components_match_all_pairs(spark, width, small, seed):
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("id", F.lit("x"))
    out = minhash.near_duplicates(df, width=width, small_bucket=small).collect()
    want = brute.near_components(docs, width)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def near_group(n, seed):
    """Copies of one text with so many changes each that hardly two of them are linked with one another."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    return list(enumerate(" ".join(changed(base, rng.choice([2, 4, 5, 6, 7]), rng)) for _ in range(n)))


def test_judged_pairs_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    judged = []
    plain = minhash._Verifier.estimates

    def counting(self, pairs, least):
        judged.append(pairs.count())
        return plain(self, pairs, least)

    monkeypatch.setattr(minhash._Verifier, "estimates", counting)
    totals = []
    for n in (150, 300):
        docs = near_group(n, 7)
        judged.clear()
        out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.near_components(docs, 5)
        totals.append(sum(judged))
    assert totals[1] < 2.6 * totals[0] and totals[1] < 300 * 299 / 8


def test_links_by_lacking_and_by_added_shingles(spark):
    # Truncated copies lack the same shingles; a family with one long addition shares it; both far from the consensus.
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(changed(base, 2, rng)) for _ in range(12)]
    texts += [" ".join(changed(base[:88], k, rng)) for k in (0, 1, 2, 3)]
    texts += [" ".join(changed(base + [f"x{i}" for i in range(60)], k, rng)) for k in (0, 1, 2, 5)]
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    for width in (2, 5):
        out = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), width=width).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute.near_components(docs, width)


def test_a_repeated_id_is_not_taken_for_the_union_of_its_texts(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(changed(base, 5, rng))) for i in range(8)]
    half = [(50, " ".join(base[:80])), (50, " ".join(base[80:]))]
    out = minhash.near_duplicates(spark.createDataFrame(rows + half, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in out if r.doc_id == 50} == {50}


class _Known:
    """Links that are given instead of worked out."""

    kind = "bigint"

    def __init__(self, links):
        self.given = links

    def estimates(self, pairs, least):
        return pairs.withColumn("estimate", F.lit(0.9))

    def links(self, pairs):
        return pairs.join(self.given, ["a", "b"])


def test_large_bucket_whose_largest_component_changes(spark):
    # One bucket of 40: component A of 16, B and C of 12 each, which the first round joins to one of 24.
    size, key = 40, 7
    ids = spark.range(size).select("id", F.pmod(F.xxhash64(F.lit(key).cast("bigint"), "id"), F.lit(size)).alias("place"))
    place = {r.id: r.place for r in ids.collect()}
    early = [i for i in range(size) if place[i] < minhash.FIRST_HUBS]
    late = [i for i in range(size) if place[i] >= minhash.FIRST_HUBS]
    x, y, b, c = early[0], late[0], early[1], late[1]
    rest = [i for i in range(size) if i not in (x, y, b, c)]
    parts = [[x, *rest[:15]], [y, b, *rest[15:25]], [c, *rest[25:]]]
    assert [len(p) for p in parts] == [16, 12, 12]
    labels = spark.createDataFrame([(i, min(p)) for p in parts for i in p], "node bigint, label bigint")
    members = spark.createDataFrame([(key, i, size, 0) for i in range(size)], "key bigint, id bigint, size bigint, hub bigint")
    links = spark.createDataFrame([(min(p), max(p)) for p in ((b, c), (x, y))], "a bigint, b bigint")
    out = minhash._settled(members, labels, _Known(links), 8)
    assert {r.label for r in out.collect()} == {0}


def test_near_duplicates_without_ids_and_with_repeated_ids(spark):
    a = " ".join(f"a{i}" for i in range(50))
    b = " ".join(f"b{i}" for i in range(50))
    rows = [(5, a), (3, b), (7, a), (7, b), (None, a), (9, "c d e"), (9, "c d e")]
    out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=2).collect()
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in out if r.doc_id)
    assert got == [(3, 3, True), (5, 3, False), (7, 3, False), (7, 3, False), (9, 9, True), (9, 9, True)]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert minhash.near_duplicates(empty).count() == 0


def test_registers_estimate_similarity():
    rng = np.random.default_rng(5)
    for n in (30, 300, 3000):
        for shared in (0.0, 0.5, 0.8):
            pool = rng.integers(0, 2**63, 3 * n).astype(np.uint64)
            k = int(round(2 * shared / (1 + shared) * n))
            estimates = []
            for _ in range(8):
                rng.shuffle(pool)
                x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:k], pool[n : 2 * n - k]]))
                mixed = [minhash.registers(np.sort(minhash.mix(v)), np.zeros(n, np.int64), 1)[0] for v in (x, y)]
                chance = minhash.chance_agreement(np.array([float(n)]), np.array([float(n)]))[0]
                estimates.append(((mixed[0] == mixed[1]).mean() - chance) / (1 - chance))
            assert abs(np.mean(estimates) - k / (2 * n - k)) < 0.06


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    nodes = list(range(300))
    edges = [(i, i + 1) for i in range(0, 120)] + [(200, i) for i in range(150, 190)] + [(rng.choice(nodes), 299) for _ in range(2)]
    labels = spark.createDataFrame([(n, n) for n in nodes], "node bigint, label bigint")
    got = {r.node: r.label for r in merge_components(labels, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {n: n for n in nodes}
    for _ in nodes:
        before = dict(want)
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
        if want == before:
            break
    assert got == want


def byte_corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, passage = prose(12), prose(90)
    texts = [prose(rng.choice([0, 3, 40, 150])) for _ in range(30)]
    texts += [prose(20) + line + prose(20) for _ in range(20)] + [prose(8) + passage + prose(5) for _ in range(12)]
    texts += ["ab" * 100, "ab" * 101, "x" * 199, "x" * 200, "x" * 450, texts[5], texts[5], passage, None, "", "\0" * 300]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("length", "shard", "split", "seed"), [(200, 4_000_000, 10_000, 1), (60, 2000, 3, 2), (40, 500, 2, 3)])
def test_repeats_match_brute_force(spark, length, shard, split, seed):
    texts = byte_corpus(seed)
    raw = [(t or "").encode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("row", F.lit("x"))
    out = suffix_dedup.remove_repeats(df, length=length, shard_bytes=shard, split_contexts=split).collect()
    want = brute.without_repeats(raw, length)
    for r in out:
        n, runs, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(raw[r.doc_id]), n, runs, brute.sha256(kept))
    assert len(out) == len(texts)


def test_repeated_rows_and_missing_ids(spark):
    rng = random.Random(9)
    text, other = ("".join(rng.choices("abcdefgh", k=n)) for n in (260, 300))
    rows = [(None, text), (None, text), (1, other), (2, "short"), (2, "short")]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in out) == [(0, 260), (0, 260), (1, 0), (2, 0), (2, 0)]
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_only_context_of_an_anchor_is_not_sorted(monkeypatch):
    sorted_bytes, array = [], suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, depth: sorted_bytes.append(len(text)) or array(text, depth))
    contexts = [b"0123456789ab", b"once only", b"abcdefghXY", b"abcdefghZ", b"shortest"]
    frame = {"anchor": [5, 6, 7, 7, 8], "context": contexts, "n": [3, 1, 1, 1, 2], "key": range(5), "key_2": range(5)}
    group = suffix_dedup.pd.DataFrame(frame)
    got = suffix_dedup._shard(8)(group)
    assert {tuple(r) for r in got[["key", "first", "last"]].to_numpy().tolist()} == {(0, 0, 4), (2, 0, 0), (3, 0, 0), (4, 0, 0)}
    assert sorted_bytes == [19]
    assert len(suffix_dedup._shard(8)(group.iloc[[0, 1]])) == 1 and len(suffix_dedup._shard(8)(group.iloc[[1]])) == 0
    assert sorted_bytes == [19]


def test_sections_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = suffix_dedup.anchors(data, np.array([0, len(data)]), 40)
    monkeypatch.setattr(suffix_dedup, "SECTION_BYTES", 700)
    parts = suffix_dedup._row_anchors(data, np.array([0, len(data)]), 40)
    starts = lambda x: {(s, int(p)) for f, l, p in zip(x[2], x[3], x[4], strict=True) for s in range(f, l + 1)}  # noqa: E731,E741
    assert starts(whole) == starts(parts) and len(starts(whole)) == len(data) - 39
