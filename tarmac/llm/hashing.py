"""Hashes of words and of byte windows for whole Arrow batches at once, in numpy.

A batch of texts is one byte array; sums of bytes times powers of an odd number give the hash of any
stretch of it as one difference. Work goes by slices that fit the processor's cache, so memory is bounded by the
slice or, where one text is longer, by that text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1
SLICE_BYTES = 400_000

_IS_WORD = np.ones(256, bool)
_IS_WORD[[32, 9, 10, 11, 12, 13]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base & MASK, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end); equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows in slices of about `limit` bytes of text: the rows, their bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            part = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[part[0] : part[-1]], part - part[0]
            first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row number of every word, in order."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if lower:
        data = _LOWER[data]
    word = _IS_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    end[:-1] &= ~word[1:] | first[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    hashes = stretch_hashes(prefix_sums(data), s, e)
    return hashes, np.searchsorted(offsets, s, "right") - 1


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two words one after the other."""
    return mix(first * np.uint64(0xC2B2AE3D27D4EB4F) + (second ^ np.uint64(0x165667B19E3779F9)))


def group_starts(keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in an array whose equal values are together."""
    if not len(keys):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones: like bytes together take less room when compressed."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def from_planes(packed: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(packed, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()
