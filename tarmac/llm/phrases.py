"""Phrases of words that stand together more often than their parts would by chance, per language.

A phrase can only be frequent if the shorter phrases in it are. Level by level, hashes of the phrases whose shorter
phrases may be frequent are counted by shard and summed by Spark; those with enough occurrences set bits in a bitmap
of fixed size. Hashes and bits that fall together only let more through, so what the bitmaps let through holds every
frequent phrase. In one more pass over the texts these phrases travel as text, each once with its count for some MB of
text, to the part that their hash gives. Every part puts the different phrases that it gets, in order, into double-array
tries of bounded size; numpy moves the trie states of all of them one byte at a time, and the counts of those that come
to an accepting state add up to the exact counts that everything after rests on. The number of passes over the
texts is that of the levels and one, however many phrases are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.llm.common import empty_for_null
from tarmac.llm.hashing import from_planes, group_starts, joined, planes, prefix_sums, slices, stretch_hashes
from tarmac.session import stored

SPACE, PIECE_END = 32, 10
#: Bits of a level's bitmap, as a power of two: 8 MB, whatever the corpus.
BITMAP_POWER = 26
#: Bits of a phrase's hash. Phrases that share one only add candidates; fewer bits take less room in shuffles.
HASH_POWER = 44
#: Phrases and bytes of one trie. More phrases in a part mean more tries, not larger ones.
TRIE_PHRASES = 500_000
TRIE_BYTES = 12_000_000
#: Phrases that go through a trie together.
WALKED = 500_000
SLICE_BYTES = 1_000_000
#: Hashes, phrases, and languages of phrases that a task counts together before it hands them on.
BUFFERED = 1_500_000
BUFFERED_PHRASES = 1_000_000
BUFFERED_LANGS = 20_000
#: Bytes of text for each group that sums hashes or the counts of phrases of a level, and the least number of groups.
SUM_BYTES = 10_000_000
SUM_PARTS = 32
#: Parts of a language that are ranked by themselves first.
RANK_PARTS = 64
UNKNOWN_LANG = "und"

_LOWER = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
#: 0 for bytes of words, 1 between the words of a piece, 2 between pieces.
_KINDS = bytes(2 if x in b".,;:!?\x0A\x0B\x0C\x0D" else 1 if x in b" \t" else 0 for x in range(256))


class Words:
    """The words of some texts, one after the other, each followed by a space or, at the end of its piece, a line end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        # A line end after each text, so that words and pieces end there.
        data = np.insert(data, offsets[1:], PIECE_END).tobytes()
        kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
        data = np.frombuffer(data.translate(_LOWER), np.uint8)
        word = kinds == 0
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if len(data) and word[0]:
            edge = np.append(0, edge)
        first, last = edge[0::2], edge[1::2]
        self.length = last - first
        self.row = np.searchsorted(offsets + np.arange(len(offsets)), first, "right") - 1
        # A piece does not go on after the word before its end.
        self.goes_on = np.ones(len(first) + 1, bool)
        self.goes_on[np.searchsorted(last, np.flatnonzero(kinds == 2), "right") - 1] = False
        self.goes_on = self.goes_on[:-1]
        self.start = np.cumsum(self.length + 1) - (self.length + 1)
        word[last] = True
        self.bytes = data[word]
        self.bytes[self.start + self.length] = np.where(self.goes_on, SPACE, PIECE_END)

    def __len__(self) -> int:
        return len(self.start)

    def ends(self, words: int) -> np.ndarray:
        """Where the phrase of so many words that starts at each word ends; its piece must be long enough."""
        last = np.minimum(np.arange(len(self)) + words - 1, len(self) - 1)
        return self.start[last] + self.length[last]

    def hashes(self, langs: np.ndarray, words: int, at: np.ndarray) -> np.ndarray:
        sums = self.sums if hasattr(self, "sums") else prefix_sums(self.bytes)
        self.sums = sums
        found = joined(langs[self.row[at]], stretch_hashes(sums, self.start[at], self.ends(words)[at]))
        return found >> np.uint64(64 - HASH_POWER)


def _lang_hashes(column: pa.Array) -> np.ndarray:
    coded = column.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(x.encode()) for x in coded.dictionary.to_pylist()], np.uint64)
    return known[coded.indices.to_numpy(zero_copy_only=False)]


def _is_set(bitmap: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _levels(words: Words, langs: np.ndarray, longest: int, bitmaps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For phrases of 1, 2, ... words: the words at which one starts whose shorter phrases all may be frequent, and its hash.

    With a bitmap for the level itself, only phrases that its bits let through.
    """
    starts = np.ones(len(words), bool)
    for size in range(1, longest + 1):
        if size > 1:
            # Phrases of `size` words start where ones a word shorter start here and at the next word.
            starts[:-1] &= starts[1:] & words.goes_on[:-1]
            starts[-1:] = False
        at = np.flatnonzero(starts)
        hashes = words.hashes(langs, size, at)
        if size <= len(bitmaps):
            there = _is_set(bitmaps[size - 1], hashes >> np.uint64(HASH_POWER - BITMAP_POWER))
            there[there] = _is_set(bitmaps[size - 1], hashes[there] & np.uint64((1 << BITMAP_POWER) - 1))
            starts = np.zeros(len(words), bool)
            starts[at[there]] = True
            at, hashes = at[there], hashes[there]
        yield at, hashes


def _sums(texts: DataFrame, level: int, bitmaps: list, min_count: int, parts: int) -> DataFrame:
    """Hashes of phrases of `level` words that occur often enough, as far as the shorter ones allow. Hashes with their
    counts travel many to a row, by ranges of hashes."""
    borders = np.array([-(-(k << HASH_POWER) // parts) for k in range(parts + 1)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shorter = [b.value for b in bitmaps]
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            at = np.searchsorted(values, borders)
            part = np.flatnonzero(at[1:] > at[:-1])
            own = [(planes(values[a:b]), planes(n[a:b].astype("<u4"))) for a, b in zip(at[part], at[part + 1], strict=True)]
            columns = [pa.array(part), *[pa.array([o[k] for o in own], pa.binary()) for k in (0, 1)]]
            return pa.RecordBatch.from_arrays(columns, names=["part", "hashes", "counts"])

        for batch, data, offsets in slices(batches, "body", SLICE_BYTES):
            *_, (_, hashes) = _levels(Words(data, offsets), _lang_hashes(batch.column(0)), level, shorter)
            held.append(hashes)
            size += len(hashes)
            if size >= BUFFERED:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    def often(group: pd.DataFrame) -> pd.DataFrame:
        values = np.concatenate([from_planes(x, "<i8") for x in group["hashes"]])
        n = np.concatenate([from_planes(x, "<u4") for x in group["counts"]]).astype(np.int64)
        order = np.argsort(values)
        values = values[order]
        starts = group_starts(values)
        return pd.DataFrame({"hash": values[starts[np.add.reduceat(n[order], starts) >= min_count]]})

    counted = texts.mapInArrow(run, "part bigint, hashes binary, counts binary")
    return counted.groupBy("part").applyInPandas(often, "hash bigint")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of hashes, a bit by their highest and one by their lowest digits, put together in Spark. It has one
    size for any number of them."""
    high = F.shiftrightunsigned("hash", HASH_POWER - BITMAP_POWER)
    low = F.col("hash").bitwiseAND(F.lit((1 << BITMAP_POWER) - 1))
    parts = (
        hashes.select(F.explode(F.array(high + 1, low + 1)).alias("bit"))
        .select(F.bitmap_bucket_number("bit").alias("part"), F.bitmap_bit_position("bit").alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (BITMAP_POWER - 3), np.uint8)
    for part, bits in zip(parts["part"].to_pylist(), parts["bits"], strict=True):
        own = np.frombuffer(bits.as_buffer(), np.uint8)
        out[(part - 1) * 4096 : (part - 1) * 4096 + len(own)] = own
    return out


def _order(keys: np.ndarray, bits: int) -> np.ndarray:
    """The order of numbers of so many bits, by as many of their bits as their places leave room for: numbers are sorted
    much faster than places by numbers."""
    room = len(keys).bit_length()
    packed = (keys << np.uint64(64 - bits)) >> np.uint64(room) << np.uint64(room)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << room) - 1)
    return packed.view(np.int64)


def _tally(
    hashes: np.ndarray, own: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray, times: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each of the different stretches of `data`, and the sum of its `times`. Stretches of different
    `own` are different ones.

    Equal stretches have equal hashes; where hashes are equal the bytes decide, eight at a time. `data` has seven bytes more
    than the stretches need. Of stretches that share a hash but differ, one may be given more than once, with a part of its sum.
    """
    order = _order(hashes, HASH_POWER)
    eight = np.ndarray(max(0, len(data) - 7), "<u8", data, 0, (1,))
    # The bytes after a stretch, the higher ones of its last eight, are shifted out.
    word = lambda at, n: eight[at] << (8 * np.maximum(8 - n, 0)).astype(np.uint64)
    like = np.zeros(len(order), bool)
    like[1:] = True
    for x in (hashes, size, own, word(begin, size)):
        x = x[order]
        like[1:] &= x[1:] == x[:-1]
    at = np.flatnonzero(like)
    at = at[size[order[at]] > 8]
    left, right, rest = begin[order[at]] + 8, begin[order[at - 1]] + 8, size[order[at]] - 8
    while len(at):
        same = word(left, rest) == word(right, rest)
        like[at[~same]] = False
        go = same & (rest > 8)
        at, left, right, rest = at[go], left[go] + 8, right[go] + 8, rest[go] - 8
    starts = np.flatnonzero(~like)
    return order[starts], np.add.reduceat(times[order], starts) if len(starts) else times[:0]


def _joined_binary(values: pa.LargeBinaryArray, edges: np.ndarray) -> pa.Array:
    """The bytes of the values from each edge to the next, as one value."""
    offsets = np.frombuffer(values.buffers()[1], np.int64)[edges]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(offsets), values.buffers()[2]]).cast(
        pa.binary()
    )


def _met(texts: DataFrame, longest: int, bitmaps: list, parts: int) -> DataFrame:
    """The phrases that the bitmaps let through and how often they were met, many of a part and language to a row: each
    phrase is followed by a line end, its count has four bytes. A level has so many parts, which are ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value for b in bitmaps]
        codes: dict[str, int] = {}
        held: list[list[np.ndarray]] = [[], [], [], [], []]
        size = 0

        def counted() -> pa.RecordBatch:
            hashes, own, n, times, text = (np.concatenate(x) for x in held)
            for x in held:
                x.clear()
            ends = np.cumsum(np.append(0, n))
            first, times = _tally(hashes, own, text, ends[:-1], n, times)
            # In order of parts, and of languages and levels in a part.
            rank = (hashes[first] * np.uint64(parts)) >> np.uint64(HASH_POWER)
            kinds = longest * len(codes)
            kind = rank * np.uint64(kinds) + own[first]
            order = _order(kind, (parts * kinds).bit_length())
            kind = kind[order]
            at = group_starts(kind)
            edges, kind = np.append(at, len(kind)), kind[at].astype(np.int64)
            phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(text)])
            phrases = _joined_binary(phrases.take(pa.array(first[order])), edges)
            counts = pa.py_buffer(times[order].astype("<u4"))
            counts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(4 * edges), counts])
            part = kind % longest * parts + kind // kinds
            lang = pa.array(list(codes), pa.string()).take(pa.array(kind % kinds // longest))
            return pa.RecordBatch.from_arrays(
                [pa.array(part), lang, phrases, counts.cast(pa.binary())], names=["part", "lang", "phrases", "counts"]
            )

        for batch, data, offsets in slices(batches, "body", SLICE_BYTES):
            words, langs = Words(data, offsets), _lang_hashes(batch.column(0))
            coded = batch.column(0).dictionary_encode()
            known = np.array([codes.setdefault(x, len(codes)) for x in coded.dictionary.to_pylist()], np.uint32)
            code = known[coded.indices.to_numpy(zero_copy_only=False)] * np.uint32(longest)
            padded = np.append(words.bytes, np.zeros(7, np.uint8))
            for level, (at, hashes) in enumerate(_levels(words, langs, longest, bits)):
                own, begin = code[words.row[at]] + np.uint32(level), words.start[at]
                n = words.ends(level + 1)[at] - begin
                first, times = _tally(hashes, own, padded, begin, n, np.ones(len(at), np.uint32))
                begin, n = begin[first], n[first] + 1
                ends = np.cumsum(n)
                text = padded[np.repeat(begin - ends + n, n) + np.arange(n.sum())]
                text[ends - 1] = PIECE_END
                for x, new in zip(held, (hashes[first], own[first], n.astype(np.int32), times, text), strict=True):
                    x.append(new)
                size += len(first)
            if size >= BUFFERED_PHRASES or len(codes) >= BUFFERED_LANGS:
                held[-1].append(np.zeros(7, np.uint8))
                yield counted()
                codes, size = {}, 0
        if size:
            held[-1].append(np.zeros(7, np.uint8))
            yield counted()

    return texts.mapInArrow(run, "part bigint, lang string, phrases binary, counts binary")


class Trie:
    """A double array: state s goes by byte c to base[s] + c, if that place's check is s.

    The children of a state lie in a stretch of its own from its least to its greatest byte, so places are given out
    level by level for all states at once. The state after a phrase's final space accepts: its bit is set in `accept`, and
    its phrase is at the place in `numbers` that bits before it give.
    """

    def __init__(self, keys: pa.Array):
        """Keys are sorted by bytes; none occurs twice."""
        keys = keys.cast(pa.large_binary())
        offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
        data = np.frombuffer(keys.buffers()[2], np.uint8)
        begin, size = offsets[:-1], np.diff(offsets)
        # Bytes go from 0 to 255, so bases stay positive when places are given out from 256 on.
        base, check, taken = np.zeros(512, np.int32), np.full(512, -1, np.int32), 256
        state = np.zeros(len(keys), np.int32)
        final = np.zeros(len(keys), np.int32)
        act, depth = np.arange(len(keys)), 0
        while len(act):
            byte, parent = data[begin[act] + depth].astype(np.int32), state[act]
            child = np.ones(len(act), bool)
            child[1:] = (parent[1:] != parent[:-1]) | (byte[1:] != byte[:-1])
            at = np.flatnonzero(child)
            of, by = parent[at], byte[at]
            family = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            least, most = by[family], by[np.append(family[1:], len(of)) - 1]
            width = most - least + 1
            room = taken + np.cumsum(width) - width
            used = int(taken + width.sum())
            if used + 512 > len(base):
                more = max(len(base), used + 512 - len(base))
                base, check = np.append(base, np.zeros(more, np.int32)), np.append(check, np.full(more, -1, np.int32))
            base[of[family]] = room - least
            place = base[of] + by
            check[place] = of
            state[act] = np.repeat(place, np.diff(np.append(at, len(act))))
            taken, depth = used, depth + 1
            ended = size[act] == depth
            final[act[ended]] = state[act[ended]]
            act = act[~ended]
        self.base, self.check = base[: taken + 256].copy(), check[: taken + 256].copy()
        bits = np.zeros(-(-(taken + 256) // 64) * 64, bool)
        bits[final] = True
        self.accept = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.cumsum(np.bitwise_count(self.accept), dtype=np.int32) - np.bitwise_count(self.accept)
        self.numbers = np.argsort(final).astype(np.int32)

    def ends(self, state: np.ndarray) -> np.ndarray:
        """Which of these states accept."""
        return (self.accept[state >> 6] >> (state & 63).astype(np.uint64)) & np.uint64(1) > 0

    def number(self, state: np.ndarray) -> np.ndarray:
        """Numbers of the phrases that end at those of these states that accept."""
        state = state[self.ends(state)]
        word, bit = self.accept[state >> 6], (state & 63).astype(np.uint64)
        lower = word & ((np.uint64(1) << bit) - np.uint64(1))
        return self.numbers[self.before[state >> 6] + np.bitwise_count(lower)]

    def after(self, text: bytes) -> int:
        """The state after a text from the root; -1 if there is none."""
        state = 0
        for byte in text:
            place = int(self.base[state]) + byte
            if self.check[place] != state:
                return -1
            state = place
        return state

    def _walk(self, data: np.ndarray, at: np.ndarray, state: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Goes on from a state at each of these places of `data`. Gives the accepting states that are come to, and from
        which of the places."""
        own = np.flatnonzero(state >= 0)
        state, at = state[own], at[own]
        while len(state):
            byte = data[at].astype(np.int32)
            over = byte == PIECE_END
            byte[over] = SPACE
            place = self.base[state] + byte
            go = self.check[place] == state
            place, at, over, byte, own = place[go], at[go], over[go], byte[go], own[go]
            space = np.flatnonzero(byte == SPACE)
            space = space[self.ends(place[space])]
            yield place[space], own[space]
            # At the end of a piece a phrase may end, but none goes on.
            go = ~over
            state, at, own = place[go], at[go] + 1, own[go]

    def accepted(self, words: Words, roots: np.ndarray) -> np.ndarray:
        """Numbers of all phrases met, once for each occurrence. `roots` has a state for each text."""
        met = [self.number(state) for state, _ in self._walk(words.bytes, words.start, roots[words.row])]
        return np.concatenate(met) if met else np.empty(0, np.int32)

    def counts(self, data: np.ndarray, start: np.ndarray, roots: np.ndarray, times: np.ndarray) -> np.ndarray:
        """For each phrase the sum of `times` where it is met from `start` on. `roots` has a state for each start."""
        out = np.zeros(len(self.numbers), np.int64)
        for first in range(0, len(start), WALKED):
            some = slice(first, first + WALKED)
            met = [(self.number(state), times[some][own]) for state, own in self._walk(data, start[some], roots[some])]
            if met:
                numbers, n = map(np.concatenate, zip(*met, strict=True))
                # Sums below 2**53 are exact.
                out += np.bincount(numbers, n, len(out)).astype(np.int64)
        return out


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all rows of a binary column without nulls, one row after the other."""
    own = [np.empty(0, np.uint8)]
    for x in column.cast(pa.large_binary()).chunks:
        offsets = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1]
        own.append(np.frombuffer(x.buffers()[2], np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate(own)


def _counted(met: DataFrame, parts: int, min_count: int) -> DataFrame:
    """Phrases met often enough: `key` (language, line end, phrase, space), its number of words `size`, and `f`."""
    bounds = TRIE_PHRASES, TRIE_BYTES

    def run(group: pa.Table) -> pa.Table:
        # All phrases of a part have the same number of words, so that none is another's beginning.
        size = group["part"][0].as_py() // parts + 1
        coded = group["lang"].combine_chunks().dictionary_encode()
        data, times = _bytes(group["phrases"]), _bytes(group["counts"]).view("<u4")
        each = pc.binary_length(group["counts"]).to_numpy() // 4
        lang = np.repeat(coded.indices.to_numpy(zero_copy_only=False), each)
        begin = np.concatenate([[0], np.flatnonzero(data == PIECE_END) + 1])
        spaced = pa.py_buffer(np.where(data == PIECE_END, np.uint8(SPACE), data))
        phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(times), [None, pa.py_buffer(begin), spaced])
        known = [x.encode() + b"\n" for x in coded.dictionary.to_pylist()]
        keys = pc.binary_join_element_wise(pa.array(known, pa.large_binary()).take(pa.array(lang)), phrases, pa.scalar(b"", pa.large_binary())).unique()
        keys = keys.take(pc.sort_indices(keys))
        often = []
        for stretches in _tries([(0, len(keys), pc.sum(pc.binary_length(keys)).as_py())], bounds):
            first, last = stretches[0][1], stretches[-1][2]
            own = keys.slice(first - 1, last - first + 1)
            trie = Trie(own)
            roots = np.array([trie.after(x) for x in known], np.int32)[lang]
            f = pa.array(trie.counts(data, begin[:-1], roots, times))
            often.append(pa.table({"key": own, "f": f}).filter(pc.field("f") >= min_count))
        out = pa.concat_tables(often)
        key = out["key"].cast(pa.binary())
        return pa.table({"key": key, "f": out["f"], "size": pa.array(np.full(len(out), size, np.int32))})

    return met.groupBy("part").applyInArrow(run, "key binary, f bigint, size int")


def _tries(sizes: list, bounds: tuple[int, int] | None = None) -> list[list[tuple[int, int, int]]]:
    """For each trie the stretches (part, first number, last number) that it holds, from parts' numbers and bytes of
    phrases. Small parts share a trie; a large one is cut."""
    most, most_bytes = bounds or (TRIE_PHRASES, TRIE_BYTES)
    out: list[list[tuple[int, int, int]]] = []
    phrases = size = 0
    for part, n, n_bytes in sizes:
        cuts = max(1, -(-n // most), -(-n_bytes // most_bytes))
        step = -(-n // cuts)
        for first in range(1, n + 1, step):
            last = min(n, first + step - 1)
            own = -(-n_bytes * (last - first + 1) // n)
            if not out or phrases + last - first + 1 > most or size + own > most_bytes:
                out.append([])
                phrases = size = 0
            out[-1].append((part, first, last))
            phrases, size = phrases + last - first + 1, size + own
    return out


def phrase_counts(
    docs: DataFrame, longest: int = 3, min_count: int = 10, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """`lang`, `phrase`, its number of words `size`, and `f`, its occurrences, for all phrases of at most `longest` words
    that occur `min_count` times or more in a language. Overlapping occurrences all count."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG))
    texts = docs.select(lang.alias("lang"), empty_for_null(text_col).alias("body"))
    bitmaps: list = []
    size = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(SUM_PARTS, -(-size // SUM_BYTES))
    for level in range(1, longest + 1):
        found = stored(_sums(texts, level, bitmaps, min_count, parts), "hashes")
        bitmaps.append(spark.sparkContext.broadcast(_bitmap(found)))
    counts = _counted(_met(texts, longest, bitmaps, parts), parts, min_count)
    # The phrase is what follows the last line end, without the final space.
    text = F.col("key").cast("string")
    phrase = F.substring_index(text, "\n", -1)
    lang = F.substring(text, F.lit(1), F.length(text) - F.length(phrase) - 1)
    return stored(counts.select(lang.alias("lang"), F.rtrim(phrase).alias("phrase"), "f", "size"), "phrases")


def _floor_share(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (l r)). Counts have up to 15 digits, so products have 37 at most and stay exact."""
    exact = lambda c: c.cast("decimal(15,0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * exact(a) * exact(a)
    return F.call_function("div", top, exact(left) * exact(right))


def mine_phrases(
    docs: DataFrame,
    longest: int = 3,
    min_count: int = 10,
    shadow_pct: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The `top` collocations of each language: lang, rank, phrase, a, l, r, n and score.

    Texts are cut at punctuation and line ends, and these pieces at spaces and tabs; only A to Z are made lower case. A
    phrase of 2 to `longest` words with a >= `min_count` occurrences scores floor(1,000,000 a a / (l r)) at its
    weakest cut, l and r being the occurrences of the two sides; of equal cuts the first counts. Phrases lying in a
    longer one that has at least `shadow_pct` percent of their occurrences are left out. n is the number of
    words of the language. Order: score, a (both descending), phrase by bytes.

    A null text is empty and a null language is `und`. Repeated rows count as often as they stand there. Other columns are
    ignored, whatever their names. Long texts are read whole. An empty table gives an empty result.
    """
    f = phrase_counts(docs, longest, min_count, lang_col, text_col)
    words = F.split("phrase", " ")
    joined_words = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size") - 1),
        lambda k: F.struct(
            k.alias("cut"),
            joined_words(F.lit(1), k).alias("left"),
            joined_words(k + 1, F.col("size") - k).alias("right"),
        ),
    )
    several = f.filter("size > 1")
    cut = several.select("lang", "phrase", F.col("f").alias("a"), F.inline(cuts))
    side = lambda name, count: f.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    cut = cut.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    scored = (
        cut.withColumn("score", _floor_share(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("weakest"))
        .select("lang", "phrase", "a", "weakest.*")
    )
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.greatest(F.col("size") - 1, F.lit(2))),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda start: joined_words(start, n)),
        )
    )
    covered = (
        f.filter("size > 2")
        .select("lang", F.explode(inner).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    free = scored.join(covered, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < shadow_pct * F.col("a"))
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = free.withColumn("_part", part).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*best))
    )
    ranked = first.filter(F.col("_place") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")
    )
    return (
        ranked.filter(F.col("rank") <= top)
        .join(word_totals(docs, lang_col, text_col), "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def word_totals(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Words of each language."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG))
    texts = docs.select(lang.alias("lang"), empty_for_null(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in slices(batches, "body", SLICE_BYTES):
            data = np.insert(data, offsets[1:], PIECE_END).tobytes()
            word = np.frombuffer(data.translate(_KINDS), np.uint8) == 0
            word[1:] &= ~word[:-1]
            n = np.add.reduceat(word, offsets[:-1] + np.arange(len(offsets) - 1), dtype=np.int64)
            coded = batch.column(0).dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(zero_copy_only=False), n, len(coded.dictionary)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n)], names=["lang", "n"])

    return texts.mapInArrow(run, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))
