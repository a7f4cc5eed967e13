"""Naive Bayes support vectors.

A document is the set of its words and word pairs, each by its 64-bit hash. A linear hinge-loss model is fitted by dual
coordinate descent on a bounded number of rows per class; only n-grams of these rows can have a weight, so they are the
model's vocabulary. Each is scaled by the log ratio of its (smoothed) shares in the two classes, counted over
all labelled rows by Spark. Further rows of the same size calibrate the margin to a probability. Every row is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import empty_for_null
from tarmac.llm.hashing import joined, mix, slices, word_hashes

#: Rows per class that the hinge-loss model is fitted on, and as many that calibrate it.
FIT_ROWS = 3000
ROUNDS = 30
COST = 1.0
#: N-grams of the vocabulary whose counts meet in one group.
BLOCK = 1 << 16


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # of n-grams, sorted
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and word pairs of each row, and their rows; repeats are kept."""
    words, row = word_hashes(data, offsets)
    pair = row[:-1] == row[1:]
    both = joined(words[:-1], words[1:])[pair]
    return np.concatenate([mix(words), both]), np.concatenate([row, row[:-1][pair]])


def places(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places in the sorted vocabulary of each row's n-grams, and their rows, in order; others are left out."""
    if not len(vocabulary):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes, row = ngrams(data, offsets)
    order = np.argsort(hashes)
    hashes, row = hashes[order], row[order]
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[at] == hashes
    distinct = np.unique(row[known].astype(np.int64) * len(vocabulary) + at[known])
    return distinct % len(vocabulary), distinct // len(vocabulary)


def _class_counts(vocabulary: np.ndarray):
    """Rows of each class that hold an n-gram, by blocks of the vocabulary, in as few bytes as the counts need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, len(vocabulary)), np.int64)
        for rows, data, offsets in slices(batches, "body"):
            label = rows.column(rows.schema.get_field_index("label")).to_numpy()
            place, row = places(data, offsets, vocabulary)
            for y in (0, 1):
                np.add.at(counts[y], place[label[row] == y], 1)
        for first in range(0, len(vocabulary), BLOCK):
            own = counts[:, first : first + BLOCK]
            if own.any():
                kind = np.min_scalar_type(own.max()).newbyteorder("<")
                columns = [pa.array([first // BLOCK]), pa.array([kind.str]), pa.array([own.astype(kind).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "kind", "counts"])

    return run


def _block_sum(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(raw, kind).astype("<i8") for raw, kind in zip(group["counts"], group["kind"], strict=True))
    return pd.DataFrame({"block": group["block"].iloc[:1], "counts": [total.tobytes()]})


def class_counts(rows: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """For each n-gram of the vocabulary the rows of class 0 and 1 that hold it."""
    counts = np.zeros((2, len(vocabulary)), np.int64)
    counted = rows.mapInArrow(_class_counts(vocabulary), "block bigint, kind string, counts binary")
    for block, raw in counted.groupBy("block").applyInPandas(_block_sum, "block bigint, counts binary").collect():
        own = np.frombuffer(raw, "<i8").reshape(2, -1)
        counts[:, block * BLOCK : block * BLOCK + own.shape[1]] = own
    return counts


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches, "body"):
        hashes, row = ngrams(data, offsets)
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
        new = np.ones(len(row), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
        hashes, row = hashes[new], row[new]
        ends = np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], names=["label", "draw", "ngrams"])


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; `cost` bounds the dual variable of each row."""
    weights, bias = np.zeros(len(scale)), 0.0
    scaled = [scale[r] for r in rows]
    norm = np.array([float(s @ s) + 1.0 for s in scaled])
    dual = np.zeros(len(rows))
    random = np.random.default_rng(1)
    for _ in range(ROUNDS):
        largest = 0.0
        for i in random.permutation(len(rows)):
            place, value, y = rows[i], scaled[i], labels[i]
            slack = y * (weights[place] @ value + bias) - 1
            moved = min(max(dual[i] - slack / norm[i], 0.0), cost[i])
            step = (moved - dual[i]) * y
            if step:
                weights[place] += step * value
                bias += step
                dual[i] = moved
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return weights, bias


def _calibrated(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, by Newton steps with a small ridge."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + np.array([1e-2, 1e-3]) * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])


def _known(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places in the vocabulary of those hashes that it holds."""
    if not len(vocabulary):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return at[vocabulary[at] == hashes]


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from rows of `draw` (a fixed hash per row), `label` (0 or 1) and `body`.

    Class counts come from all rows. The rows of each class with the smallest draws, `fit_rows` for
    the model and as many for its calibration, reach the driver as at most 4 * fit_rows lists of n-grams.
    Without rows of both classes every score is the share of label 1, or a half without any row.
    """
    rows = labelled.select(F.col("label").cast("int"), F.col("draw").cast("bigint"), "body").filter("label IN (0, 1)")
    totals = np.zeros(2)
    for label, n in rows.groupBy("label").count().collect():
        totals[label] = n
    if not totals.all():
        share = totals[1] / totals.sum() if totals.sum() else 0.5
        return Model(np.empty(0, np.uint64), np.empty(0, np.float32), 0.0, 1.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    # A draw below the class's share of 2 * fit_rows picks about that many rows, without a sort.
    limit = [int(min(1.0, 2 * fit_rows / n) * 2**32) for n in totals]
    wanted = F.when(F.col("label") == 1, F.lit(limit[1])).otherwise(F.lit(limit[0]))
    picked = rows.filter(F.pmod("draw", F.lit(2**32)) < wanted)
    picked = picked.mapInArrow(_features, "label int, draw bigint, ngrams array<bigint>").toArrow()
    draw, label = picked.column("draw").to_numpy(), picked.column("label").to_numpy()
    lists = picked.column("ngrams").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    order = np.lexsort((draw, label))
    every = [flat[ends[i] : ends[i + 1]] for i in order]
    label = label[order]
    place = np.arange(len(label)) - np.where(label == 1, (label == 0).sum(), 0)
    for_fit = place % 2 == 0
    own = {y: max(1, int((label[for_fit] == y).sum())) for y in (0, 1)}
    y = np.where(label == 1, 1.0, -1.0)
    cost = np.where(label == 1, COST * min(1.0, own[0] / own[1]), COST * min(1.0, own[1] / own[0]))
    fitted = np.flatnonzero(for_fit)
    vocabulary = np.unique(np.concatenate([flat[:0], *[every[i] for i in fitted]]))
    counts = class_counts(rows, vocabulary)
    shares = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    ratio = np.log(shares[1] / shares[0])
    every = [_known(vocabulary, own) for own in every]
    weights, bias = dual_descent([every[i] for i in fitted], y[fitted], ratio, cost[fitted])
    weights *= ratio
    margin = np.array([weights[r].sum() for r in every]) + bias
    held = np.flatnonzero(~for_fit) if (~for_fit).any() else fitted
    of_class = np.bincount(label[held], minlength=2)
    weight = (totals / np.maximum(of_class, 1))[label[held]]
    slope, shift = _calibrated(margin[held], label[held].astype(float), weight / weight.mean())
    used = np.flatnonzero(weights)
    return Model(vocabulary[used], weights[used].astype(np.float32), bias, slope, shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: its id and `score`, the probability of label 1, from the text alone.

    Null and empty texts have no places and get the score of the bias. Ids may be null or repeat; other columns
    are ignored; an empty table gives an empty result. The model has at most one
    hash and one number per n-gram of the rows it was fitted on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "body"):
            place, row = places(data, offsets, model.hashes)
            margin = np.bincount(row, model.weights[place], rows.num_rows) + model.bias
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.probability(margin))], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), empty_for_null(text_col).alias("body"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def fold(id_col: str) -> Column:
    """A number from 0 to 3 by the id's decimal text; null without an id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
