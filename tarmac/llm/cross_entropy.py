"""Cross-entropy difference of two bigram models.

The target model counts the documents marked as target, the background model all documents. Both have one
vocabulary, all words of the corpus (a caller may ask for the most frequent ones, everything else being one unknown
word), and the same smoothing: a bigram's share is interpolated with the share of its second word. A document's score
is the mean over its words of the loss under the target model less the loss under the background model; lower is closer
to the target.

Words go by their 64-bit hash. Only hot words, the few hundred most frequent ones and any with a good share of a part's
bigrams, go to every task with their counts; so do the counts of bigrams of frequent words, which may make up much of
the corpus. All other bigrams are dealt to parts by their second word, so a part counts whole words as well as bigrams
and needs no table of the vocabulary. The loss by a word's history is a term of its own, and the part of a word counts
that history too. Bigrams whose second word is hot are dealt by both words instead. Each document gets back
the sum over its bigrams of a part, in one row per part and block of documents. The number of parts is one for all but
large corpora; beyond, a document meets more parts, but never more than it has bigrams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import empty_for_null
from tarmac.llm.hashing import from_planes, group_starts, joined, mix, planes, slices, word_hashes
from tarmac.session import stored

FREQUENT = 512
#: Weight of the second word's share, in bigrams.
SMOOTHING = 16.0
#: Words of the corpus for each group that counts and answers, and the least number of groups.
PART_BIGRAMS = 4_000_000
PARTS = 64
#: Bigrams that a group counts at a time.
CHUNK_BIGRAMS = 250_000
#: Words of a block of documents, which asks each part once.
BLOCK_WORDS = 1_000_000
#: A word with more occurrences than this share of a part is hot.
HOT_SHARE = 8
#: What stands for the start of a text, and for words outside a vocabulary that the caller limits.
START, UNKNOWN = np.uint64(1), np.uint64(2)
#: Bytes of a word with its mark for the end of a text, of a history, and of a hot word's number.
WORD_BYTES, HISTORY_BYTES, HOT_BYTES = 7, 6, 3
COUNTS = ["n_target", "n_all", "ends_target", "ends_all"]


@dataclass(frozen=True)
class Hot:
    """Counts of the hot words under both models, by rising hash, and the totals."""

    hashes: np.ndarray
    counts: np.ndarray  # (2, n): as a word
    history: np.ndarray  # (2, n + 1): before another word; the last is the start
    place: np.ndarray  # (n + 1): among the frequent words, or -1; the last is the start
    total: np.ndarray  # (2, 1): occurrences of all words
    size: int  # distinct words and the unknown one
    known: np.ndarray | None  # hashes of a limited vocabulary

    @property
    def width(self) -> int:
        return int(self.place.max()) + 1

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Number of each hot word, -1 for others."""
        return _places(self.hashes, words)

    def log_share(self, single: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural logarithms (2, n) for second words and bigrams with these counts (2, n), before the history's part."""
        return np.log(counts + SMOOTHING * (single + 1) / (self.total + self.size))


def _places(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
    return np.where(hashes[at] == words, at, -1)


@dataclass(frozen=True)
class Bigrams:
    """Bigrams of a slice: hashes and hot numbers of both words, the row, whether first or last of the row."""

    first: np.ndarray
    second: np.ndarray
    first_hot: np.ndarray
    second_hot: np.ndarray
    row: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def _bigrams(data: np.ndarray, offsets: np.ndarray, hot: Hot) -> Bigrams:
    second, row = word_hashes(data, offsets)
    if hot.known is not None:
        second = np.where(_places(hot.known, second) >= 0, second, UNKNOWN)
    second_hot = hot.lookup(second)
    begins, ends = np.ones(len(row), bool), np.ones(len(row), bool)
    begins[1:] = row[1:] != row[:-1]
    ends[:-1] = begins[1:]
    first, first_hot = np.roll(second, 1), np.roll(second_hot, 1)
    first[begins], first_hot[begins] = START, len(hot.hashes)
    return Bigrams(first, second, first_hot, second_hot, row, begins, ends)


def _frequent_keys(words: Bigrams, hot: Hot) -> tuple[np.ndarray, np.ndarray]:
    """Which bigrams are of frequent words, and the places of these in the table of their counts."""
    first = np.where(words.first_hot >= 0, hot.place[words.first_hot], -1)
    second = np.where(words.second_hot >= 0, hot.place[words.second_hot], -1)
    both = (first >= 0) & (second >= 0)
    return both, first[both] * hot.width + second[both]


def _targets(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column(rows.schema.get_field_index("target")).to_numpy(zero_copy_only=False).astype(bool)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice and word: occurrences and row ends, in target rows and in all; word 0 is the number of rows."""
    for rows, data, offsets in slices(batches, "body"):
        hashes, row = word_hashes(data, offsets)
        if not len(hashes):
            continue
        target = rows.column(rows.schema.get_field_index("target")).to_numpy(zero_copy_only=False)[row]
        last = np.ones(len(row), bool)
        last[:-1] = row[1:] != row[:-1]
        word, at = np.unique(hashes, return_inverse=True)
        count = lambda which: np.bincount(at[which], minlength=len(word))
        every = np.ones(len(row), bool)
        columns = [word.view(np.int64), count(target), count(every), count(last & target), count(last)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["word", "n_target", "n_all", "ends_target", "ends_all"]
        )


def hot_words(rows: DataFrame, vocabulary: int | None, frequent: int, limit: int) -> Hot:
    """The `frequent` most frequent words and all that occur more than `limit` times."""
    counted = rows.select("body", "target").mapInArrow(
        _word_counts, "word bigint, n_target bigint, n_all bigint, ends_target bigint, ends_all bigint"
    )
    counted = stored(counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS]), "words")
    summed = counted.agg(F.count(F.lit(1)).alias("words"), *[F.sum(c).alias(c) for c in COUNTS]).first()
    totals = np.array([summed[c] or 0 for c in COUNTS], np.int64)
    ranked = counted.orderBy(F.desc("n_all"), "word")
    known, size = None, summed["words"] + 1
    if vocabulary is None:
        # At most one word per `limit` words of the corpus beyond the frequent ones.
        top = pd.concat([ranked.limit(frequent).toPandas(), counted.filter(F.col("n_all") > limit).toPandas()])
        top = top.drop_duplicates("word").astype("int64")
        place = np.arange(len(top))
        place[frequent:] = -1
    else:
        top = ranked.limit(vocabulary).toPandas().astype("int64")
        known, size = np.sort(top["word"].to_numpy().view(np.uint64)), len(top) + 1
        rest = totals - top[COUNTS].sum().to_numpy()
        top = top[(np.arange(len(top)) < frequent) | (top["n_all"] > limit)]
        place = np.arange(len(top))
        place[frequent:] = -1
        unknown = pd.DataFrame([[int(UNKNOWN), *rest.tolist()]], columns=["word", *COUNTS])
        top, place = pd.concat([top, unknown]), np.append(place, min(frequent, len(top)))
    hashes = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    columns = top[COUNTS].to_numpy(np.int64)[order].T
    n, ends = columns[:2], columns[2:]
    history = np.append(n - ends, totals[2:, None], axis=1)
    place = np.append(place[order], place.max(initial=-1) + 1)
    return Hot(hashes[order], n, history, place, totals[:2, None], size, known)


def _frequent_counts(hot: Hot):
    cells = hot.width**2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, cells), np.int64)
        for rows, data, offsets in slices(batches, "body"):
            words = _bigrams(data, offsets, hot)
            both, key = _frequent_keys(words, hot)
            counts[0] += np.bincount(key[_targets(rows)[words.row[both]]], minlength=cells)
            counts[1] += np.bincount(key, minlength=cells)
        at = np.flatnonzero(counts[1])
        columns = [at, counts[0][at], counts[1][at]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "n_target", "n_all"])

    return run


def _local_sums(words: Bigrams, n: int, hot: Hot, counts: np.ndarray, of_history: np.ndarray) -> list[np.ndarray]:
    """For each of n rows the sums over its frequent bigrams and over its hot histories, under both models."""
    both, key = _frequent_keys(words, hot)
    logs = hot.log_share(hot.counts[:, words.second_hot[both]], counts[:, key])
    after = words.first_hot >= 0
    return [
        np.bincount(words.row[both], x, n) - np.bincount(words.row[after], h[words.first_hot[after]], n)
        for x, h in zip(logs, of_history, strict=True)
    ]


def _low_bytes(x: np.ndarray, n: int) -> np.ndarray:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def _numbers(low: np.ndarray) -> np.ndarray:
    whole = np.zeros((len(low), 8), np.uint8)
    whole[:, : low.shape[1]] = low
    return whole.view("<u8").ravel()


def _requests(hot: Hot, counts: np.ndarray, parts: int):
    """By blocks of rows the other bigrams, by part and by whether the second word is hot: rows by their place in the
    block, bigrams per row, whether target, and the bigrams in a few bytes. One more row of a block has its row
    numbers, words per row and sums that need no part."""
    of_history = np.log(hot.history + SMOOTHING)
    small = np.uint16 if parts <= 1 << 16 else np.int64

    def dealt(block: int, is_hot: bool, targets: np.ndarray, by: np.ndarray, row: np.ndarray, packed: np.ndarray) -> list[tuple]:
        if not len(row):
            return []
        part = ((mix(by) >> np.uint64(32)) % np.uint64(parts)).astype(small)
        # Rows rise already.
        order = np.argsort(part, kind="stable")
        row, part, packed = row[order], part[order].astype(np.int64), packed[order]
        run_starts = group_starts(part * len(targets) + row)
        size = np.diff(np.append(run_starts, len(row))).astype("<u4")
        rows = row[run_starts].astype("<u4")
        target = targets[rows].astype(np.uint8)
        part_starts = group_starts(part)
        ends = np.append(part_starts[1:], len(row))
        of_run = np.append(np.searchsorted(run_starts, part_starts), len(run_starts))
        return [
            (int(part[s]), block, is_hot, None, planes(rows[a:b]), planes(size[a:b]), target[a:b].tobytes(), packed[s:e].tobytes())
            for s, e, a, b in zip(part_starts, ends, of_run[:-1], of_run[1:], strict=True)
        ]

    def asked(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        ids, n, t, b, targets, *other = [np.concatenate(x) for x in zip(*held, strict=True)]
        block = int(ids[0])
        own = np.stack([ids, n, t.view(np.int64), b.view(np.int64)]).tobytes()
        part = int(mix(ids[:1].astype(np.uint64))[0] % np.uint64(parts))
        out = [(part, block, False, own, None, None, None, None)]
        out += dealt(block, False, targets, *other[:3])
        out += dealt(block, True, targets, *other[3:])
        kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 5]
        columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "block", "hot", "own", "rows", "sizes", "targets", "bigrams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n_rows = n_words = 0
        for rows, data, offsets in slices(batches, "body"):
            words = _bigrams(data, offsets, hot)
            both, _ = _frequent_keys(words, hot)
            row = words.row + n_rows
            history = _low_bytes(words.first, HISTORY_BYTES)
            # The words' highest bits, and one for the end of a text.
            marked = (words.second >> np.uint64(9) << np.uint64(1)) | words.ends.astype(np.uint64)
            cold = words.second_hot < 0
            other = ~cold & ~both
            number = words.second_hot[other].astype(np.uint64)
            held.append(
                [
                    rows.column(0).to_numpy(),
                    np.bincount(words.row, minlength=rows.num_rows).astype(np.int64),
                    *_local_sums(words, rows.num_rows, hot, counts, of_history),
                    _targets(rows),
                    words.second[cold],
                    row[cold],
                    np.concatenate([_low_bytes(marked[cold], WORD_BYTES), history[cold]], axis=1),
                    joined(words.first[other], number),
                    row[other],
                    np.concatenate([_low_bytes(number, HOT_BYTES), history[other]], axis=1),
                ]
            )
            n_rows, n_words = n_rows + rows.num_rows, n_words + len(row)
            if n_words >= BLOCK_WORDS:
                yield asked(held)
                held, n_rows, n_words = [], 0, 0
        if held:
            yield asked(held)

    return run


def _answers(hot: Hot):
    """Counts of a part's words and bigrams over the corpus, and for each block the sums of its rows over their bigrams
    of this part."""

    def logs(packed: np.ndarray, target: np.ndarray, is_hot: bool) -> list[np.ndarray]:
        """The bigrams' terms under both models; all bigrams with the same second word must be there, or, if hot, all
        equal ones."""
        width = HOT_BYTES if is_hot else WORD_BYTES
        word, history = _numbers(packed[:, :width]), _numbers(packed[:, width:])
        count = lambda at, n, which: np.stack([np.bincount(at[which & target], minlength=n), np.bincount(at[which], minlength=n)])
        every = np.ones(len(word), bool)
        if is_hot:
            at, single = word.astype(np.int64), hot.counts
        else:
            ends = (word & np.uint64(1)).astype(bool)
            word = word >> np.uint64(1)
            distinct, at = np.unique(word, return_inverse=True)
            single = count(at, len(distinct), every)
            after = np.log(count(at, len(distinct), ~ends) + SMOOTHING)
        bigram, one, of_bigram = np.unique(joined(history, word), return_index=True, return_inverse=True)
        terms = [x[of_bigram] for x in hot.log_share(single[:, at[one]], count(of_bigram, len(bigram), every))]
        if not is_hot:
            for x, h in zip(terms, after, strict=True):
                x -= np.where(ends, 0.0, h[at])
        return terms

    def sums(some: pd.DataFrame, is_hot: bool) -> tuple[np.ndarray, np.ndarray]:
        """For each request and row in it the two sums, and the row's place in its block."""
        width = (HOT_BYTES if is_hot else WORD_BYTES) + HISTORY_BYTES
        packed = np.frombuffer(b"".join(some["bigrams"]), np.uint8).reshape(-1, width)
        size = np.concatenate([from_planes(x, "<u4") for x in some["sizes"]])
        run = np.repeat(np.arange(len(size), dtype=np.int32), size)
        target = np.frombuffer(b"".join(some["targets"]), bool)
        # Chunks by a byte of the second word, or of the history if the second word is hot.
        chunks = min(256, -(-len(packed) // CHUNK_BIGRAMS))
        chunk = packed[:, HOT_BYTES + 2 if is_hot else 2] % np.uint16(chunks)
        out = np.zeros((2, len(size)))
        for k in range(chunks):
            at = np.flatnonzero(chunk == k)
            if len(at):
                of = run[at]
                for x, terms in zip(out, logs(packed[at], target[of], is_hot), strict=True):
                    x += np.bincount(of, terms, len(size))
        return out, np.concatenate([from_planes(x, "<u4") for x in some["rows"]])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        part = group["part"].iloc[0]
        group = group.sort_values("block")
        is_own = group["own"].notna()
        out = [(block, part, own, None, None) for block, own in zip(group["block"][is_own], group["own"][is_own], strict=True)]
        asked = group[~is_own]
        if len(asked):
            found, keys = [], []
            blocks, number = np.unique(asked["block"], return_inverse=True)
            for is_hot in (False, True):
                which = (asked["hot"] == is_hot).to_numpy()
                if which.any():
                    own, row = sums(asked[which], is_hot)
                    n = [len(x) for x in asked["targets"][which]]
                    found.append(own)
                    keys.append((np.repeat(number[which], n) << 32) + row)
            # A row may ask for bigrams with hot and with other second words.
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            both = [np.bincount(at, x, len(key)) for x in np.concatenate(found, axis=1)]
            starts = group_starts(key >> 32)
            for a, b in zip(starts, np.append(starts[1:], len(key)), strict=True):
                rows = (key[a:b] & 0xFFFFFFFF).astype("<u4")
                packed = planes(np.concatenate([x[a:b] for x in both]))
                out.append((blocks[key[a] >> 32], part, None, planes(rows), packed))
        return pd.DataFrame(out, columns=["block", "part", "own", "rows", "sums"])

    return run


def _gathered(group: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block with all their sums, added in the order of the parts."""
    is_own = group["own"].notna()
    own = np.frombuffer(group["own"][is_own].iloc[0], np.int64).reshape(4, -1)
    found = [x.copy() for x in own[2:].view(np.float64)]
    answers = group[~is_own].sort_values("part")
    if len(answers):
        at = np.concatenate([from_planes(x, "<u4") for x in answers["rows"]])
        values = np.concatenate([from_planes(x, "<f8").reshape(2, -1) for x in answers["sums"]], axis=1)
        for x, own_values in zip(found, values, strict=True):
            x += np.bincount(at, own_values, len(x))
    return pd.DataFrame({"row": own[0], "n_words": own[1], "t": found[0], "b": found[1]})


def answered(texts: DataFrame, hot: Hot, counts: np.ndarray, part_bigrams: int) -> DataFrame:
    """One row per block of documents and part, and one per block."""
    parts = max(PARTS, -(-int(hot.total[1, 0]) // part_bigrams))
    asked = texts.mapInArrow(
        _requests(hot, counts, parts),
        "part bigint, block bigint, hot boolean, own binary, rows binary, sizes binary, targets binary, bigrams binary",
    )
    kind = "block bigint, part bigint, own binary, rows binary, sums binary"
    return asked.groupBy("part").applyInPandas(_answers(hot), kind)


def cross_entropy_difference(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "target",
    vocabulary: int | None = None,
    frequent: int = FREQUENT,
    part_bigrams: int = PART_BIGRAMS,
) -> DataFrame:
    """One row per input row: its id, `n_words`, `target_loss`, `background_loss`, `score` (their difference).

    Losses are means per word in nats. Words are runs without ASCII white space. Null, empty and blank texts have no
    words, no losses and no score. All words are known; with a `vocabulary` only so many of the most frequent. Null in the target column is false; without target rows the target model is the
    smoothing alone. Rows that repeat count each time; ids may be null; other columns are ignored; an empty
    table gives an empty result.
    """
    target = F.coalesce(F.col(target_col).cast("boolean"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), empty_for_null(text_col).alias("body"), target.alias("target"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "marked").select("row", "id", "body", "target")
    hot = hot_words(rows, vocabulary, frequent, part_bigrams // HOT_SHARE)
    texts = rows.select("row", "body", "target")
    # At most (frequent + 2) squared rows.
    counted = texts.mapInArrow(_frequent_counts(hot), "key bigint, n_target bigint, n_all bigint")
    counted = counted.groupBy("key").agg(F.sum("n_target").alias("n_target"), F.sum("n_all").alias("n_all")).toPandas()
    counts = np.zeros((2, hot.width**2), np.int64)
    counts[:, counted["key"]] = counted["n_target"], counted["n_all"]

    sums = answered(texts, hot, counts, part_bigrams).groupBy("block")
    sums = sums.applyInPandas(_gathered, "row bigint, n_words bigint, t double, b double")
    loss = lambda c: F.when(F.col("n_words") > 0, F.round(-F.col(c) / F.col("n_words"), 9))
    out = rows.select("row", "id").join(sums, "row").withColumns({"t": loss("t"), "b": loss("b")})
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.col("t").alias("target_loss"),
        F.col("b").alias("background_loss"),
        F.round(F.col("t") - F.col("b"), 9).alias("score"),
    )
