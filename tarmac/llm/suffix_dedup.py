"""Removal of repeated byte strings with suffix arrays.

A string of `length` bytes is assigned to its anchor: of its stretches of half that length, the one with the
smallest hash, the leftmost of equal ones. Equal strings have equal anchors at the same place, so only
strings around an anchor that occurs twice can repeat. Such an anchor and the strings assigned to it
are one stretch of text, a context; each string of a document is in exactly one context. Equal
contexts are counted before anything else, within each task first, so copies do not travel.

Distinct contexts are dealt to shards by their anchor. No two strings of one context are equal, so the only context
of an anchor repeats as a whole if it has copies. Each shard builds the suffix array of its other contexts
(refinement of groups by doubling, as Larsson and Sadakane do, leaving out suffixes that are already
alone) and common prefixes of neighbours (Kasai's relation between the prefixes of one position and
the next). Strings that share `length` bytes are neighbours in it. The contexts of one very common
anchor are cut over several shards; their sorted strings are then merged across these shards, and those of
one value in two shards found by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import empty_for_null
from tarmac.llm.hashing import prefix_sums, slices, stretch_hashes
from tarmac.session import stored

LENGTH = 200
#: Places within a slice take the low bits of a hash when the leftmost minimum is looked for.
PLACE_BITS = 24
#: Longer texts are looked through in overlapping sections.
SECTION_BYTES = 8_000_000
#: Bytes of contexts that one shard should hold.
SHARD_BYTES = 1_000_000
#: Distinct contexts of one anchor beyond which they are cut over several shards.
SPLIT_CONTEXTS = 10_000


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each stretch of `width` values, by doubling."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each anchor its hash and row, and the first and last string start that it is the anchor of (within
    the row), and its own place there."""
    half = length // 2
    none = tuple(np.empty(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    at = np.arange(len(data) - half + 1)
    hashes = stretch_hashes(prefix_sums(data), at, at + half)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = _sliding_least((hashes & ~low) | at.astype(np.uint64), length - half + 1)
    # String starts whose string lies within its row.
    start = np.arange(len(data) - length + 1)
    row = np.searchsorted(offsets, start, "right") - 1
    whole = start + length <= offsets[row + 1]
    start, row = start[whole], row[whole]
    if not len(start):
        return none
    place = (least[start] & low).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    begin = offsets[row[first]]
    return hashes[place[first]], row[first], start[first] - begin, start[last] - begin, place[first] - begin


def _row_anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """As `anchors`, with texts longer than a section looked through section by section."""
    if len(offsets) > 2 or len(data) <= SECTION_BYTES:
        return anchors(data, offsets, length)
    found = []
    step = SECTION_BYTES - length + 1
    for first in range(0, len(data) - length + 1, step):
        part = data[first : first + SECTION_BYTES]
        hashes, row, start, last, place = anchors(part, np.array([0, len(part)]), length)
        found.append((hashes, row, start + first, last + first, place + first))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            hashes, row, start, last, place = _row_anchors(data, offsets, length)
            ends = pa.array(np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(x))
                for x in (hashes.view(np.int64), start.astype(np.int32), last.astype(np.int32), place.astype(np.int32))
            ]
            names = ["id", "mark", "mark_2", "anchor", "start", "last", "place"]
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(3)), *lists], names=names)

    return run


def _cut_contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column(2)[k].as_buffer().to_pybytes()
                listed = batch.column(3)[k].values
                hashes, start, last, place = (listed.field(i).to_numpy() for i in range(4))
                contexts = [raw[s : e + length] for s, e in zip(start.tolist(), last.tolist(), strict=True)]
                own = [pa.array(np.full(len(start), batch.column(i)[k].as_py(), np.int64)) for i in range(2)]
                columns = [*own, pa.array(hashes), pa.array((place - start).astype(np.int32)), pa.array(start)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(contexts, pa.binary())],
                    names=["row", "copies", "anchor", "lead", "start", "context"],
                )

    return run


def _words(text: np.ndarray, beyond: int) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the text, `beyond` positions of them too."""
    padded = np.concatenate([text, np.zeros(beyond + 8, np.uint8)])
    word = np.zeros(len(text) + beyond, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k : k + len(word)]
    return word


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their next `depth` bytes at least, zeros following the text.

    The first order is by eight bytes; each round sorts the groups that are not yet single by the ranks as many
    bytes on, which doubles what the order goes by.
    """
    n = len(text)
    key = _words(text, 0)
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    several = np.flatnonzero(~new | ~np.append(new[1:], True))
    reach = 8
    while reach < depth and len(several):
        at = order[several]
        on = at + reach
        further = np.where(on < n, rank[np.minimum(on, n - 1)] + 1, 0)
        both = rank[at] << 32 | further
        sub = np.argsort(both)
        at, both = at[sub], both[sub]
        order[several] = at
        new[several[1:]] |= both[1:] != both[:-1]
        opens = new[several]
        rank[at] = np.maximum.accumulate(np.where(opens, several, 0))
        several = several[~opens | ~np.append(opens[1:], True)]
        reach *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, enough: int) -> np.ndarray:
    """For each place of the suffix array the bytes shared with the place before; exact below `enough`.

    Where two neighbours are the successors of two neighbours that share their first byte, they share one byte less
    than those. So only the other positions are compared, eight bytes a step, and the rest is counted down
    from them. Every `enough` positions one is compared anyway, as comparisons end at twice `enough`.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[:-1] >= 0) & (before[1:] == before[:-1] + 1)
    at = np.flatnonzero(follows)
    follows[at] = text[at - 1] == text[before[at] - 1]
    follows[::enough] = False
    word = _words(text, 2 * enough)
    go = np.flatnonzero(~follows & (before >= 0))
    shared = np.zeros(n, np.int64)
    done = 0
    while len(go) and done < 2 * enough:
        differing = word[go + done] ^ word[before[go] + done]
        same = differing == 0
        shared[go[same]] += 8
        # Leading zero bytes of the difference are shared bytes.
        last = differing[~same]
        high = (last >> np.uint64(11)).astype(np.float64)
        bits = np.where(high > 0, np.frexp(high)[1] + 11, np.frexp(last.astype(np.float64))[1])
        shared[go[~same]] += (64 - bits) // 8
        go, done = go[same], done + 8
    position = np.arange(n)
    head = np.maximum.accumulate(np.where(follows, 0, position))
    return np.maximum(shared[head] - (position - head), 0)[order]


def repeated_starts(contexts: list[bytes], counts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of string starts whose string starts anywhere else: context, first and last start."""
    text = np.frombuffer(b"".join(contexts), np.uint8)
    size = np.array([len(c) for c in contexts])
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    owner = np.repeat(np.arange(len(contexts)), size)
    starts = np.arange(len(text)) - begin[owner] <= size[owner] - length
    order = suffix_array(text, length)
    run = np.cumsum(common_prefixes(text, order, 2 * length) < length) - 1
    weight = np.where(starts[order], counts[owner[order]], 0)
    flag = np.zeros(len(text) + 1, bool)
    flag[order] = np.bincount(run, weight)[run] > 1
    flag[:-1] &= starts
    edges = np.diff(np.concatenate([[False], flag]).astype(np.int8))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
    return owner[first], first - begin[owner[first]], last - begin[owner[first]]


def _shard(length: int):
    """Runs of repeated starts in a shard's contexts.

    All strings of a context have the one anchor at different places, so no two of them are equal. Where an anchor has
    one distinct context, all its strings repeat if the context does, or none; there is nothing to sort.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        counts = group["n"].to_numpy()
        _, own, contexts = np.unique(group["anchor"].to_numpy(), return_inverse=True, return_counts=True)
        single = contexts[own] == 1
        copied, several = np.flatnonzero(single & (counts > 1)), np.flatnonzero(~single)
        context = group["context"].to_numpy()
        whole = np.fromiter(map(len, context[copied]), np.int64, len(copied)) - length
        at = first = last = np.empty(0, np.int64)
        if len(several):
            at, first, last = repeated_starts(context[several].tolist(), counts[several], length)
            at = several[at]
        keys = group[["key", "key_2"]].iloc[np.concatenate([copied, at])].reset_index(drop=True)
        first, last = np.concatenate([np.zeros(len(copied), np.int64), first]), np.concatenate([whole, last])
        return keys.assign(first=first.astype(np.int32), last=last.astype(np.int32))

    return run


def _string_marks(length: int):
    """Hashes of all strings of the contexts of split anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = np.frombuffer(batch.column(4)[k].as_buffer(), np.uint8)
                at = np.arange(len(raw) - length + 1)
                marks = stretch_hashes(prefix_sums(raw), at, at + length).view(np.int64)
                own = [pa.array(np.full(len(at), batch.column(i)[k].as_py(), np.int64)) for i in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(at.astype(np.int32)), pa.array(marks)],
                    names=["anchor", "parts", "key", "key_2", "at", "mark"],
                )

    return run


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """Strings of one split anchor from all its shards: sorted, and each looked up by binary search."""
    own = group["mark"].to_numpy()
    marks = np.sort(own)
    again = np.searchsorted(marks, own, "right") - np.searchsorted(marks, own, "left") > 1
    return group.loc[again, ["key", "key_2", "at"]]


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            n_bytes, n_removed, n_spans, digest, kept_bytes = [], [], [], [], []
            for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pieces, end, removed, runs = [], 0, 0, 0
                for s in sorted((s["first"], s["last"] + length) for s in spans):
                    if s[0] > end or not runs:
                        pieces.append(raw[end : s[0]])
                        runs, end, removed = runs + 1, s[1], removed + s[1] - s[0]
                    elif s[1] > end:
                        removed, end = removed + s[1] - end, s[1]
                pieces.append(raw[end:])
                kept = b"".join(pieces)
                n_bytes.append(len(raw))
                n_removed.append(removed)
                n_spans.append(runs)
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_bytes.append(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)],
                    pa.array(digest, pa.string()),
                    pa.array(kept_bytes, pa.binary()),
                ],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    split_contexts: int = SPLIT_CONTEXTS,
) -> DataFrame:
    """One row per input row: its id, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, and `kept`.

    `kept` is the text's UTF-8 bytes without those that some string of `length` bytes covers that also starts
    elsewhere in the input; it is null where nothing is removed, as the text is then kept whole. Null text
    is empty. Rows that repeat, id and text, are two texts and so remove each other; ids may be null.
    Other columns are ignored; an empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    body = empty_for_null(text_col)
    marks = [F.xxhash64(body).alias("mark"), F.xxhash64(F.lit(1), body).alias("mark_2")]
    rows = docs.select(F.col(id_col).alias("id"), *marks, body.alias("body"))
    lists = "anchor array<bigint>, start array<int>, last array<int>, place array<int>"
    found = rows.mapInArrow(_find_anchors(length), f"id {kind}, mark bigint, mark_2 bigint, {lists}")
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "anchors")

    each = found.select(F.explode("anchor").alias("anchor"), "row")
    often = stored(each.groupBy("anchor").count().filter("count > 1").select("anchor"), "repeated-anchors")
    hits = each.join(often, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("own"))
    zipped = F.arrays_zip("anchor", "start", "last", "place")
    located = found.join(hits, "row").select(
        "id", "mark", "mark_2", "row", F.filter(zipped, lambda a: F.array_contains("own", a["anchor"])).alias("anchors")
    )
    located = stored(located, "located")
    # Of equal texts one is cut into contexts, which count as often as there are copies. Rows that repeat its id
    # are cut again, which only adds to a count that is above one already.
    first = F.min(F.struct("id", "row")).alias("first")
    firsts = located.groupBy("mark", "mark_2").agg(first, F.count(F.lit(1)).alias("copies"))
    located = stored(located.join(firsts.select(F.col("first.row").alias("row"), "copies"), "row"), "candidates")
    texts = rows.withColumnsRenamed({"id": "of_id"}).join(located, ["mark", "mark_2"]).filter("id <=> of_id")
    texts = stored(texts.select("row", "copies", F.col("body").cast("binary").alias("body"), "anchors"), "candidate-texts")

    cut = texts.mapInArrow(
        _cut_contexts(length), "row bigint, copies bigint, anchor bigint, lead int, start int, context binary"
    )
    cut = cut.withColumn("key", F.xxhash64("anchor", "lead", "context"))
    cut = cut.withColumn("key_2", F.xxhash64("context", "lead", F.lit(1)))
    # Cut twice, so that the bytes of contexts that are not distinct are written nowhere.
    distinct = cut.groupBy("anchor", "lead", "context", "key", "key_2").agg(F.sum("copies").alias("n"))
    distinct = stored(distinct, "distinct-contexts")
    contexts = stored(cut.select("row", "start", "key", "key_2"), "contexts")
    total = distinct.agg(F.sum(F.length("context"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    per_anchor = distinct.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / split_contexts).alias("parts"))
    split = stored(per_anchor.filter("parts > 1"), "split-anchors")
    dealt = distinct.join(split, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn(
        "shard", F.pmod(F.xxhash64("anchor", F.pmod("key", "parts")), F.lit(shards))
    )
    spans = dealt.select("shard", "anchor", "context", "key", "key_2", "n").groupBy("shard").applyInPandas(_shard(length), "key bigint, key_2 bigint, first int, last int")
    marked = dealt.filter("parts > 1").select("anchor", "parts", "key", "key_2", "context")
    marked = marked.mapInArrow(
        _string_marks(length), "anchor bigint, parts bigint, key bigint, key_2 bigint, at int, mark bigint"
    )
    over_shards = marked.groupBy("anchor", F.pmod("mark", "parts")).applyInPandas(
        _merged, "key bigint, key_2 bigint, at int"
    )
    spans = spans.unionByName(over_shards.select("key", "key_2", F.col("at").alias("first"), F.col("at").alias("last")))
    of_context = spans.groupBy("key", "key_2").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    of_context = stored(of_context, "context-spans")
    start = F.col("start")
    moved = F.transform("spans", lambda s: F.struct((s["first"] + start).alias("first"), (s["last"] + start).alias("last")))
    of_row = contexts.join(of_context, ["key", "key_2"]).select("row", moved.alias("spans"))
    of_row = of_row.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    results = texts.select("row", "body").join(of_row, "row")
    results = results.select("row", "body", "spans").mapInArrow(
        _removed(length), "row bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )
    results = results.dropDuplicates(["row"]).drop("n_bytes").join(located.select("row", "mark", "mark_2"), "row")
    whole = rows.select(
        "id",
        "mark",
        "mark_2",
        F.octet_length("body").cast("bigint").alias("n_bytes"),
        F.sha2("body", 256).alias("whole_sha256"),
    )
    return whole.join(results, ["mark", "mark_2"], "left").select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        "kept",
    )
