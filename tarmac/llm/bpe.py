"""Byte-level BPE in numpy matrices.

Texts are cut by the vocabulary's pattern. Pieces not met before are laid out as rows of byte ids, padded, one
matrix per length bucket. Each round looks up the ranks of all adjacent pairs in a hash table, merges
the leftmost pair of least rank of every row and closes the gap; rows without a pair leave the matrix.
A piece that is a token as a whole is taken as such. Very long pieces, for which a round per merge would take the
square of their length, go through a heap with the same order of merges. Results per piece are kept in a table
of bounded size.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import empty_for_null

NONE = np.int32(2**31 - 1)
SHIFT = 17
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Pieces longer than this go through a heap.
LONGEST_ROW = 128
MATRIX_CELLS = 1_000_000
KEPT_PIECES = 500_000
OUT_TOKENS = 1_000_000
#: Characters of text whose new pieces are merged together; a longer text is a group by itself.
GROUP_CHARS = 2_000_000
#: The pattern's classes of white space are those of Unicode's White_Space property (a fixed value).
WHITE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


class PairTable:
    """Rank of the merge of two tokens, by open addressing."""

    def __init__(self, tokens: dict[bytes, int]):
        keys, values = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << SHIFT | right)
                    values.append(rank)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            _, first = np.unique(slot, return_index=True)
            put = np.zeros(len(keys), bool)
            put[first] = True
            put &= free
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MULTIPLIER) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank per pair; NONE for what doesn't merge. Negative ids are padding."""
        out = np.full(left.shape, NONE, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[at].astype(np.int64) << SHIFT | right.ravel()[at]
        slot, flat = self._slot(keys), out.ravel()
        while len(at):
            there = self.keys[slot]
            hit = there == keys
            flat[at[hit]] = self.values[slot[hit]]
            go = ~hit & (there != -1)
            at, keys, slot = at[go], keys[go], (slot[go] + 1) & self.mask
        return flat.reshape(left.shape)


class MatrixBpe:
    def __init__(self, vocabulary_path: str, pattern: str):
        lines = Path(vocabulary_path).read_bytes().splitlines()
        self.tokens = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
        by_id = [b""] * (max(self.tokens.values()) + 1)
        for token, rank in self.tokens.items():
            by_id[rank] = token
        self.by_id = pa.array(by_id, pa.large_binary())
        self.byte_ids = np.array([self.tokens[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.tokens)
        # Outside and inside of classes alike, so that \s means the same as where the vocabulary was made.
        own = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{WHITE}\p{{L}}\p{{N}}]").replace(r"\S", rf"[^{WHITE}]")
        self.cut = regex.compile(own.replace(r"\s", f"[{WHITE}]")).findall
        self._forget()

    def _forget(self) -> None:
        """An empty table of pieces: their numbers, all tokens in order of number, and where each piece's end."""
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _rows(self, ids: np.ndarray) -> np.ndarray:
        """All rows of a padded matrix merged to the end, in place."""
        done, number = ids, np.arange(len(ids))
        ids = ids.copy()
        while len(ids):
            if ids.shape[1] > 1:
                ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(ids)), at]
            else:
                at = np.zeros(len(ids), np.int64)
                best = np.full(len(ids), NONE)
            go = best != NONE
            done[number[~go], : ids.shape[1]] = ids[~go]
            done[number[~go], ids.shape[1] :] = -1
            ids, number, at, best = ids[go], number[go], at[go], best[go]
            if not len(ids):
                break
            ids[np.arange(len(ids)), at] = best
            column = np.arange(ids.shape[1] - 1)[None, :]
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
        return done

    def _long(self, piece: bytes) -> list[int]:
        """The same merges in the same order by a heap of (rank, place) and links between neighbours."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        texts = [piece[i : i + 1] for i in range(len(ids))]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = lambda i: self.tokens.get(texts[i] + texts[after[i]])
        heap = [(r, i) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if ids[i] < 0 or after[i] >= n or pair(i) != rank:
                continue
            j = after[i]
            ids[i], ids[j], texts[i], after[i] = rank, -1, texts[i] + texts[j], after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := pair(k)) is not None:
                    heapq.heappush(heap, (r, k))
        return [x for x in ids if x >= 0]

    def merge(self, pieces: Iterable[str]) -> None:
        """Tokens of pieces not met before."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        ids, lengths = [self.ids], []
        for piece in pieces:
            raw = piece.encode()
            whole = self.tokens.get(raw)
            if whole is not None or len(raw) > LONGEST_ROW:
                own = [whole] if whole is not None else self._long(raw)
                self.number[piece] = len(self.number)
                ids.append(np.array(own, np.int32))
                lengths.append(np.array([len(own)]))
            else:
                buckets.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append((piece, raw))
        for width, group in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for first in range(0, len(group), step):
                part = group[first : first + step]
                raw = np.frombuffer(b"".join(r.ljust(width, b"\0") for _, r in part), np.uint8).reshape(-1, width)
                length = np.array([len(r) for _, r in part])
                rows = np.where(np.arange(width)[None, :] < length[:, None], self.byte_ids[raw], -1).astype(np.int32)
                rows = self._rows(rows)
                for piece, _ in part:
                    self.number[piece] = len(self.number)
                ids.append(rows[rows >= 0])
                lengths.append((rows >= 0).sum(axis=1))
        self.ids = np.concatenate(ids)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(lengths))])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Tokens of each text. New pieces of about `GROUP_CHARS` characters of text share their matrices."""
        first = 0
        while first < len(texts):
            last, chars = first, 0
            while last < len(texts) and (last == first or chars + len(texts[last]) <= GROUP_CHARS):
                chars += len(texts[last])
                last += 1
            cut = [self.cut(text) for text in texts[first:last]]
            new = {p for pieces in cut for p in pieces if p not in self.number}
            if new and len(self.number) + len(new) > KEPT_PIECES:
                self._forget()
                new = {p for pieces in cut for p in pieces}
            if new:
                self.merge(new)
            for pieces in cut:
                numbers = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
                start = self.ends[numbers]
                n = self.ends[numbers + 1] - start
                before = np.cumsum(n) - n
                yield self.ids[np.repeat(start - before, n) + np.arange(n.sum())]
            first = last

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of each list of tokens; a null list has none."""
        ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)))
        taken = self.by_id.take(lists.flatten())
        offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
        buffers = [None, pa.py_buffer(offsets[ends]), taken.buffers()[2]]
        return pa.Array.from_buffers(pa.large_binary(), len(lists), buffers).cast(pa.binary())


_models: dict[tuple[str, str], MatrixBpe] = {}


def model(vocabulary_path: str, pattern: str) -> MatrixBpe:
    """One model per Python process and vocabulary; the file must be on every executor."""
    key = (vocabulary_path, pattern)
    if key not in _models:
        _models[key] = MatrixBpe(*key)
    return _models[key]


def encode_documents(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: its id and `ids`, the tokens of the whole text, without special tokens.

    Null and empty texts have no tokens. Ids may be null or repeat. Other columns are ignored; an empty
    table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary_path, pattern)
        for batch in batches:
            first, lists, total = 0, [], 0
            for i, ids in enumerate(bpe.encode(batch.column(1).to_pylist()), 1):
                lists.append(ids)
                total += len(ids)
                if total >= OUT_TOKENS or i == batch.num_rows:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                    column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i - first), column], names=["id", "ids"])
                    first, lists, total = i, [], 0

    rows = docs.select(F.col(id_col).alias("id"), empty_for_null(text_col).alias("body"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """Rows of id and `ids` with `decoded`, the bytes of the tokens; null ids are no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(vocabulary_path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                columns = [part.column(0), part.column(1), bpe.decode(part.column(1))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).alias("id"), "ids")
    kind = dict(rows.dtypes)["id"]
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary")
    return out.withColumnRenamed("id", id_col)
