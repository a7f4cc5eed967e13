"""Ranked lexical search for a set of queries by reading impact-sorted lists without random access.

Queries are taken in blocks of bounded size. One pass finds the block's terms in all documents and stores them by
document; from it come the weights. Then each shard of documents sorts what each term adds to a score, greatest first, and
answers every query from these lists alone: it reads all of the query's lists a stretch at a time and keeps for each
document met a lower bound, what was read of it, and an upper bound, that and the last values read from the
lists it wasn't met in. Documents whose upper bound falls below the k-th best lower bound are out. Reading ends when
no document unmet can come in and the bounds of all that are left are equal, so members, ties and scores are final. Spark
merges the shards' best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.common import empty_for_null
from tarmac.llm.hashing import slices
from tarmac.session import fresh_folder, stored

#: A block of queries: so many of them, or so many characters. What is broadcast of a block is bounded by these.
BLOCK_QUERIES = 1_000
BLOCK_CHARS = 2_000_000
SLICE_BYTES = 2_000_000
#: A shard: so many documents, or so many entries of its lists.
SHARD_DOCS = 8_192
SHARD_ENTRIES = 3_000_000
#: Entries that a list is read by at first; every round reads twice as many.
FIRST_READ = 64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All terms of some texts in order, and the row of each."""
    term = _TERM[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    start, end = term.copy(), term.copy()
    start[1:] &= ~term[:-1] | border[1:-1]
    end[:-1] &= ~term[1:] | border[1:-1]
    first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
    ends = np.concatenate([[0], np.cumsum(last - first)])
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_LOWER[data[term]])]
    )
    return found, np.searchsorted(offsets, first, "right") - 1


def terms_of_text(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return terms_of(data, np.array([0, len(data)]))[0].to_pylist()


def _entries(texts: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """By document: `id`, `n` (all its terms), and those of the vocabulary by place, `terms`, with `tfs`."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.large_binary())
        for batch, data, offsets in slices(batches, "body", SLICE_BYTES):
            found, row = terms_of(data, offsets)
            place = pc.index_in(found, value_set=known)
            there = place.is_valid().to_numpy(zero_copy_only=False)
            key = row[there] * len(known) + place.drop_null().to_numpy()
            key, tf = np.unique(key, return_counts=True)
            ends = np.searchsorted(key, np.arange(batch.num_rows + 1) * len(known)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % len(known), tf)]
            n = pa.array(np.bincount(row, minlength=batch.num_rows).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), n, *lists], names=["id", "n", "terms", "tfs"])

    kind = dict(texts.dtypes)["id"]
    return texts.mapInArrow(run, f"id {kind}, n bigint, terms array<int>, tfs array<int>")


class Lists:
    """The lists of one shard: for each term its documents by falling impact."""

    def __init__(self, weights: np.ndarray, documents: int, length: int, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
        damped = 75 + (25 * n * documents) // length
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * damped[doc]))
        some = impact > 0
        impact, doc, term = impact[some], doc[some], term[some]
        order = np.lexsort((-impact, term))
        self.impact, self.doc = impact[order], doc[order]
        self.begin = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.size = len(n)

    def best(self, query: list[tuple[int, int]], k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents and their scores, equal scores by `ids`; all with a score if they are fewer.

        `query` has terms by place, each once, and how often they stand in the query. k-th ties may bring more than k.
        """
        terms = np.array([t for t, _ in query], np.int64)
        times = np.array([c for _, c in query], np.int64)
        at, stop = self.begin[terms], self.begin[terms + 1]
        lower = np.zeros(self.size, np.int64)
        seen = np.zeros((self.size, len(terms)), bool)
        rest = np.zeros(len(terms), np.int64)
        left, reading, step = np.empty(0, np.int64), np.ones(len(terms), bool), FIRST_READ
        while True:
            n = np.where(reading, np.minimum(stop - at, step), 0)
            place = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            column = np.repeat(np.arange(len(terms)), n)
            doc = self.doc[place]
            np.add.at(lower, doc, self.impact[place] * times[column])
            seen[doc, column] = True
            at, step = at + n, step * 2
            more = at < stop
            rest[:] = 0
            rest[more] = self.impact[at[more]] * times[more]
            met = np.flatnonzero(lower) if not len(left) else left
            limit = np.partition(lower[met], len(met) - k)[len(met) - k] if len(met) >= k else 0
            upper = lower[met] + rest.sum() - seen[met] @ rest
            unmet_may_come = rest.sum() >= max(limit, 1)
            alive = upper >= limit
            open_lists = (~seen[met[alive]] & (rest > 0)).any(axis=0)
            if not unmet_may_come and not open_lists.any():
                met = met[alive]
                order = np.lexsort((ids[met], -lower[met]))
                return met[order], lower[met][order]
            # As soon as none can come in, only lists that a document still waits for are read on, and only
            # documents that can be members are looked at.
            reading = more if unmet_may_come else open_lists
            left = np.empty(0, np.int64) if unmet_may_come else met[alive]


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """For each row of `items` its k best documents: the item's id, `rank` from 1, the document's id and `score`.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A to Z are made lower case. Over N
    documents with a term and their L terms, a term in df documents weighs w = floor(1000 ln((2N+2)/(2df+1))). With
    m = 75 + (25 n N) div L for a document of n terms, a term tf times in it adds w ((10^9 tf) div (1000 tf + 12 m)) for
    each time it stands in the item. Documents without a score above 0 are left out; equal scores go by id, null first.

    A null or empty text has no terms, an item without terms no rows. Rows of documents with one id rank by themselves, and so
    do rows of items with one id. Other columns are ignored, whatever their names. Long texts are read whole. Empty tables give an
    empty result.
    """
    spark = docs.sparkSession
    number = F.row_number().over(Window.partitionBy("_block").orderBy("id", "body"))
    body = empty_for_null(item_text_col)
    asked = items.select(F.col(item_col).alias("id"), body.alias("body"))
    # Items of a block are numbered in one task; their number and text are bounded by the count of blocks.
    size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("body")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // BLOCK_QUERIES), -(-size[1] // BLOCK_CHARS))
    asked = asked.withColumn("_block", F.pmod(F.xxhash64("id", "body"), F.lit(blocks)))
    asked = stored(asked.withColumn("item", number), "items")
    texts = docs.select(F.col(id_col).alias("id"), empty_for_null(text_col).alias("body"))
    folder = fresh_folder(spark, "ranked")
    kinds = dict(asked.dtypes)["id"], dict(texts.dtypes)["id"]
    spark.createDataFrame([], f"_block bigint, item int, id {kinds[1]}, score bigint").write.parquet(folder)
    for block in range(blocks):
        rows = asked.filter(F.col("_block") == block).select("item", "body").collect()
        found = _block(texts, {r["item"]: Counter(terms_of_text(r["body"])) for r in rows}, k)
        if found is not None:
            found.withColumn("_block", F.lit(block).cast("bigint")).write.mode("append").parquet(folder)
    best = Window.partitionBy("_block", "item").orderBy(F.desc("score"), F.asc("id"))
    ranked = spark.read.parquet(folder).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    asked = asked.select("_block", "item", F.col("id").alias("asked_id"))
    return ranked.join(asked, ["_block", "item"]).select(
        F.col("asked_id").alias(item_col), "rank", F.col("id").alias(id_col), "score"
    )


def _block(texts: DataFrame, queries: dict[int, Counter], k: int) -> DataFrame | None:
    """The best documents of every shard for each query: `item`, `id`, `score`."""
    vocabulary = sorted(set().union(*queries.values()))
    if not vocabulary:
        return None
    spark = texts.sparkSession
    entries = stored(_entries(texts, vocabulary), "entries")
    documents, length = entries.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in entries.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = [(item, [(place[t], c) for t, c in sorted(terms.items())]) for item, terms in sorted(queries.items()) if terms]
    shared = spark.sparkContext.broadcast((weights, documents, length, asked))
    kind = dict(entries.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, documents, length, asked = shared.value
        held: list[pa.RecordBatch] = []
        entries_held = docs_held = 0

        def answered() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = rows.column(0)
            # Places in order of id, as ids need not be numbers.
            in_order = np.empty(len(ids), np.int64)
            in_order[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
            sizes = pc.list_value_length(rows.column(2)).to_numpy(zero_copy_only=False)
            flat = [rows.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3)]
            doc = np.repeat(np.arange(len(ids)), sizes)
            lists = Lists(weights, documents, length, rows.column(1).to_numpy(), doc, *flat)
            items, at, scores = [], [], []
            for item, query in asked:
                best, score = lists.best(query, k, in_order)
                items.append(np.full(len(best[:k]), item, np.int32))
                at.append(best[:k])
                scores.append(score[:k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(items)), ids.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(scores))],
                names=["item", "id", "score"],
            )

        for batch in batches:
            for first in range(0, batch.num_rows, SHARD_DOCS):
                part = batch.slice(first, SHARD_DOCS)
                if held and (docs_held + part.num_rows > SHARD_DOCS or entries_held > SHARD_ENTRIES):
                    yield from answered()
                    held, entries_held, docs_held = [], 0, 0
                held.append(part)
                docs_held += part.num_rows
                entries_held += len(part.column(2).flatten())
        if held:
            yield from answered()

    return entries.filter("n > 0").mapInArrow(run, f"item int, id {kind}, score bigint")
