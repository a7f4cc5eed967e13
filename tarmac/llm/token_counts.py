"""Exact token counts of every prefix of a text, for byte-pair vocabularies with word ends.

The encoding of a prefix is the encoding of a shorter prefix and one more token: the only token that ends there and
stands unmerged after the shorter one's last token. So a pass over a word that keeps the last token and the number of
tokens of each prefix gives all counts, without merging anything. Whether two tokens stay apart is read off the
vocabulary: no merge of a right part of the first with a left part of the second may come before the merges
that hide these parts. Words met before are kept in a table of bounded size. The new words of many texts are
worked out together, byte by byte: first bytes of all words, then second ones, and so on.

The counts of a document answer how many tokens a prefix has (`tokens_of_prefix`), whether a text keeps a limit
(`is_within`) and where to cut it (`longest_prefix_within`) as plain column expressions, without encoding again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from tarmac.llm.common import empty_for_null

WORD_END = "</w>"
NEVER = 2**31
#: No token yet: the start of a piece, and places not reached.
FRESH = -1
#: Between pieces; no text in UTF-8 has this byte.
BORDER = 0xFF
#: White space as the vocabulary's pattern has it: Unicode's White_Space (a fixed value).
WHITE = r"\t-\r\x20\x85\xA0  -     　"
#: The vocabulary's split in both cases of letters (a fixed value), and white space as pieces without tokens; a single
#: space before a word goes with it.
PIECES = (
    r"'[sStTmMdD]|'(?:[rR][eE]|[vV][eE]|[lL][lL])| ?\p{L}+|\p{N}"
    rf"|[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+"
)
BLANKS = frozenset(regex.findall(f"[{WHITE}]", "".join(map(chr, range(0x3001)))))
#: The same for texts of ASCII characters only.
ASCII_PIECES = r"'[sStTmMdD]|'(?:[rR][eE]|[vV][eE]|[lL][lL])| ?[A-Za-z]+|[0-9]|[^\t-\r A-Za-z0-9]+|[\t-\r ]+"
SHORT_FORM = regex.compile(r"'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])")
#: The one letter that lower case makes two of.
WIDENED = "İ"
KEPT_PIECES = 400_000
KEPT_PAIRS = 2_000_000
#: Places (a power of two) in the table where many pairs are looked up at once; a place keeps the last pair put there.
PAIR_BITS = 22
#: Bytes beyond which a word is worked out alone.
LONG_WORD = 100
#: Pieces and characters whose counts are worked out and handed on together; a longer text goes alone.
STEP_PIECES = 200_000
OUT_CHARS = 1_000_000


def byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, others moved."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class PrefixCounts:
    def __init__(self, vocabulary_path: str):
        model = json.loads(Path(vocabulary_path).read_text(encoding="utf-8"))
        letters = byte_of_letter()
        ids = model["model"]["vocab"]
        inside: dict[bytes, int] = {}
        ending: dict[bytes, int] = {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in enumerate(merges)}
        self.made = {ids[a + b]: (ids[a], ids[b], r) for r, (a, b) in enumerate(merges)}
        self.left_parts: dict[int, list[tuple[int, int]]] = {}
        self.right_parts: dict[int, list[tuple[int, int]]] = {}
        self.apart: dict[int, bool] = {}
        stands = dict.fromkeys((i for i in ids.values() if i not in self.made), True)
        for token, (a, b, _) in self.made.items():
            stands[token] = stands[a] and stands[b] and not self._crossed(a, b, (a, b))
        for text, token in ids.items():
            if stands[token]:
                last = text.endswith(WORD_END) and len(text) > len(WORD_END)
                raw = bytes(letters[c] for c in (text[: -len(WORD_END)] if last else text))
                (ending if last else inside)[raw] = token
        self._trie(inside, ending)
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)
        library = Tokenizer.from_file(vocabulary_path)
        self.normal = library.normalizer.normalize_str
        self.composed = normalizers.NFC().normalize_str
        specials = [t["content"] for t in model["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.cut_any, self.cut_ascii = regex.compile(PIECES).findall, re.compile(ASCII_PIECES).findall
        self.joins: set[str] | None = None
        self._forget()

    def _trie(self, inside: dict[bytes, int], ending: dict[bytes, int]) -> None:
        """The tokens as a tree of bytes: nodes with children come first, so `steps` has rows for them only, and one of zeros."""
        nodes: dict[bytes, int] = {b"": 0}
        tokens = inside.keys() | ending.keys()
        for raw in tokens:
            for n in range(len(raw), 0, -1):
                if raw[:n] in nodes:
                    break
                nodes[raw[:n]] = 0
        parents = {raw[:-1] for raw in nodes if raw}
        ordered = sorted(nodes, key=lambda raw: (raw not in parents, raw))
        for i, raw in enumerate(ordered):
            nodes[raw] = i
        self.parents = len(parents)
        self.steps = np.zeros((self.parents + 1) << 8, np.int32)
        for raw, i in nodes.items():
            if raw and raw[-1] != BORDER:
                self.steps[nodes[raw[:-1]] << 8 | raw[-1]] = i
        self.inside = np.array([inside.get(raw, -1) for raw in ordered], np.int32)
        self.ending = np.array([ending.get(raw, -1) for raw in ordered], np.int32)

    def _forget(self) -> None:
        """A table of pieces with nothing but the empty one: numbers, counts of prefixes in order of number, and their ends.

        The empty piece stands for the empty prefix; it has the count 0. No other piece has an entry for it.
        """
        self.number = _Numbers()
        self.number[""]
        self.number.new.clear()
        self.flat, self.ends = np.zeros(1, np.int32), np.array([0, 1])

    def _parts(self, token: int, side: int, kept: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The parts at one end of a token, each with the rank of the merge that hides it."""
        found = kept.get(token)
        if found is None:
            found, hidden, part = [], NEVER, token
            while True:
                found.append((part, hidden))
                made = self.made.get(part)
                if made is None:
                    break
                part, hidden = made[side], made[2]
            kept[token] = found
        return found

    def _crossed(self, a: int, b: int, but: tuple[int, int] | None = None) -> bool:
        """Whether a merge would reach over the border of the tokens. Of equal ranks the left one comes first."""
        for x, x_hidden in self._parts(a, 1, self.right_parts):
            for y, y_hidden in self._parts(b, 0, self.left_parts):
                merge = self.rank.get((x, y), NEVER)
                if merge < x_hidden and merge <= y_hidden and (x, y) != but:
                    return True
        return False

    def _stay_apart(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= KEPT_PAIRS:
                self.apart.clear()
            known = self.apart[key] = not self._crossed(a, b)
        return known

    def _all_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`_stay_apart` of many pairs, most of which were met before."""
        keys = a.astype(np.int64) << 20 | b
        places = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        kept = self.pairs[places]
        unknown = np.flatnonzero(kept >> 1 != keys)
        if len(unknown):
            new, at = np.unique(keys[unknown], return_inverse=True)
            stays = np.array([self._stay_apart(k >> 20, k & 0xFFFFF) for k in new.tolist()])[at]
            kept[unknown] = keys[unknown] << 1 | stays
            self.pairs[places[unknown]] = kept[unknown]
        return (kept & 1).astype(bool)

    def _found(self, line: np.ndarray) -> tuple[np.ndarray, ...]:
        """Tokens in the line, shorter ones first: first byte, byte after the last, node of the tree."""
        starts, ends, nodes = [], [], []
        at = np.arange(len(line))
        node = np.zeros(len(line), np.int32)
        size = 0
        while len(at):
            node = self.steps[np.minimum(node, self.parents) << 8 | line[at + size]]
            alive = np.flatnonzero(node)
            at, node, size = at[alive], node[alive], size + 1
            is_token = np.flatnonzero((self.inside[node] >= 0) | (self.ending[node] >= 0))
            starts.append(at[is_token])
            ends.append(at[is_token] + size)
            nodes.append(node[is_token])
            going = np.flatnonzero(node < self.parents)
            at, node = at[going], node[going]
        return tuple(map(np.concatenate, (starts, ends, nodes)))

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each piece and each of its prefixes that ends after a character, the tokens the prefix has as a word.

        All pieces go through the vocabulary's tree in one line, and then byte by byte through the tokens found: of those
        that end at a byte, the longest that stands apart from the token before it counts. Counts come in one array, with
        their number for each piece.
        """
        raw = [(t.lower() if t.isascii() else self.normal(t)).encode() for t in texts]
        line = np.frombuffer(bytes([BORDER]).join(raw) + bytes([BORDER]), np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        begin = np.cumsum(size + 1) - size - 1
        count, last = np.zeros(len(line), np.int32), np.full(len(line), FRESH, np.int32)
        ended = np.zeros(len(line), np.int32)
        starts, ends, nodes = self._found(line)
        inside, ending = self.inside[nodes], self.ending[nodes]
        depth = ends - np.repeat(begin, size + 1)[starts]
        long = np.repeat(size > LONG_WORD, size + 1)[starts]
        if long.any():
            self._long(starts[long], ends[long], inside[long], last, count)
        going = np.flatnonzero(~long & (inside >= 0))
        going = going[np.argsort(depth[going].astype(np.uint8), kind="stable")]
        borders = np.cumsum(np.bincount(depth[going], minlength=1)).tolist()
        for first, end in zip(borders, borders[1:], strict=False):
            j, i, token = starts[going[first:end]], ends[going[first:end]], inside[going[first:end]]
            stays = self._stand(last[j], token)
            j, i = j[stays], i[stays]
            # Of several tokens the last written counts, which is the longest.
            last[i], count[i] = token[stays], count[j] + 1
        over = np.flatnonzero(ending >= 0)
        over = over[self._stand(last[starts[over]], ending[over])]
        ended[ends[over]] = count[starts[over]] + 1
        # The count of a prefix lies at the byte after it, which is none within a character.
        whole = line & 0xC0 != 0x80
        whole[begin] = False
        own = np.add.reduceat(whole, begin, dtype=np.int64) if len(raw) else size
        # A piece's last byte is followed by a border, whose place has the count of the whole piece.
        return ended[whole], own

    def _stand(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether tokens stand after the ones before them, or first."""
        stays = before == FRESH
        later = np.flatnonzero(~stays)
        stays[later] = self._all_apart(before[later], token[later])
        return stays

    def _long(self, starts: np.ndarray, ends: np.ndarray, tokens: np.ndarray, last: np.ndarray, count: np.ndarray) -> None:
        """Fills in last tokens and their numbers for long words, token by token."""
        order = np.lexsort((starts, ends))
        own_last, own_count = {}, {}
        for j, i, token in zip(*(x[order].tolist() for x in (starts, ends, tokens)), strict=True):
            if token >= 0 and i not in own_last:
                before = own_last.get(j, FRESH)
                if before == FRESH or self._stay_apart(before, token):
                    own_last[i], own_count[i] = token, own_count.get(j, 0) + 1
        at = np.fromiter(own_last, np.int64, len(own_last))
        last[at] = np.fromiter(own_last.values(), np.int32, len(at))
        count[at] = np.fromiter(own_count.values(), np.int32, len(at))

    def cut(self, text: str) -> list[str]:
        return self.cut_ascii(text) if text.isascii() else self.cut_any(text)

    def _learn(self, new: list[str]) -> None:
        """Counts of prefixes of new pieces of all kinds, in order of their numbers."""
        blank = [p[-1] in BLANKS for p in new]
        # White space, alone or before a word, has no tokens.
        spaces = np.array([len(p) if b else p[0] == " " for p, b in zip(new, blank, strict=True)], np.int64)
        counts, own = self.words(["" if b else p[p[0] == " " :] for p, b in zip(new, blank, strict=True)])
        ends = np.cumsum(spaces + own)
        flat = np.zeros(int(ends[-1]), np.int32)
        before = np.cumsum(own) - own
        flat[np.arange(len(counts)) + np.repeat(ends - own - before, own)] = counts
        for k, piece in enumerate(new):
            if len(piece) == 3 and piece[0] == "'" and SHORT_FORM.fullmatch(piece):
                # Cut after two characters it is no short form but a quote and a letter.
                quote, letter = self.words(["'", piece[1]])[0].tolist()
                flat[ends[k] - 3 : ends[k] - 1] = quote, quote + letter
        n = len(self.number)
        first = int(self.ends[n - len(new)])
        self.ends = _with_room(self.ends, n + 1)
        self.ends[n - len(new) + 1 : n + 1] = first + ends
        self.flat = _with_room(self.flat, first + len(flat))
        self.flat[first : first + len(flat)] = flat

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces in the table, which learns the new ones."""
        if len(self.number) > KEPT_PIECES:
            self._forget()
        numbers = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        if self.number.new:
            self._learn(self.number.new)
            self.number.new.clear()
        return numbers

    def _counts(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of prefixes of the numbered pieces as one text, and the tokens before each piece and after the last."""
        start, end = self.ends[numbers], self.ends[numbers + 1]
        n = end - start
        before = np.append(0, np.cumsum(self.flat[end - 1], dtype=np.int64))
        places = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.flat[places] + np.repeat(before[:-1].astype(np.int32), n), before

    def _plain(self, text: str) -> np.ndarray:
        """Counts of prefixes 1, 2, ... of a text in which every character has a lower-case form of its own."""
        pieces = self.cut(text)
        out, at, before = np.empty(len(text), np.int32), 0, 0
        for first in range(0, len(pieces), STEP_PIECES):
            counts, own = self._counts(self._numbers(pieces[first : first + STEP_PIECES]))
            out[at : at + len(counts)] = counts + np.int32(before)
            at, before = at + len(counts), before + int(own[-1])
        return out

    def _units(self, text: str) -> list[tuple[str, str]]:
        """Stretches that normalisation doesn't join, with their composed forms."""
        if self.joins is None:
            pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
            seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and p[0][0] != "<"}
            self.joins = seconds | set(map(chr, (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))))
        starts = [i for i, c in enumerate(text) if not (i and (unicodedata.combining(c) or c in self.joins))]
        out: list[tuple[str, str]] = []
        for a, b in zip(starts, [*starts[1:], len(text)], strict=True):
            own = text[a:b]
            made = self.composed(own) if b - a > 1 or not own.isascii() else own
            out.extend(zip(own, own, strict=True) if own == made else [(own, made)])
        return out if "".join(m for _, m in out) == self.composed(text) else [(text, self.composed(text))]

    def _is_plain(self, text: str) -> bool:
        """Whether normalisation leaves every character a character of its own."""
        if text.isascii():
            return True
        composed = unicodedata.is_normalized("NFC", text) and (max(text) < "\U00010000" or self.composed(text) == text)
        return composed and WIDENED not in text

    def _segment(self, text: str) -> np.ndarray:
        """Counts of prefixes of a text without special tokens; -1 inside what normalisation joins."""
        if self._is_plain(text):
            return self._plain(text)
        units = [(own, made.replace(WIDENED, "i̇")) for own, made in self._units(text)]
        counts = np.append(0, self._plain("".join(made for _, made in units)))
        out, at, end = np.full(len(text), -1, np.int32), 0, 0
        for own, made in units:
            at, end = at + len(own), end + len(made)
            out[at - 1] = counts[end]
        return out

    def text(self, text: str) -> np.ndarray:
        """Tokens of the first 0, 1, ... characters; -1 where a prefix ends inside what normalisation joins."""
        parts = self.special.split(text) if self.special else [text]
        out, before = [np.zeros(1, np.int32)], 0
        for i, part in enumerate(parts):
            if i % 2:
                # Not yet whole, a special token is ordinary text that goes on from the piece before it.
                tail = (self.cut(parts[i - 1]) or [""])[-1]
                base = int(self._segment(tail)[-1]) if tail else 0
                counts = self._segment(tail + part[:-1])[len(tail) :] - base + before
                counts = np.append(counts, before + 1)
            else:
                counts = self._segment(part)
                counts = np.where(counts < 0, counts, counts + before)
            if len(counts):
                out.append(counts.astype(np.int32))
                before = int(counts[-1])
        return np.concatenate(out)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """`text` of each. Their new pieces are learned together; plain texts also get their counts together."""
        plain, others, firsts, pieces, more = [], [], [], [], []
        for i, text in enumerate(texts):
            special = self.special is not None and self.special.search(text) is not None
            if len(text) < OUT_CHARS and not special and self._is_plain(text):
                plain.append(i)
                firsts.append(len(pieces))
                pieces.append("")
                pieces += self.cut(text)
            else:
                others.append(i)
                if len(text) < OUT_CHARS:
                    more += self.cut(self.composed(text))
        numbers = self._numbers(pieces + more)[: len(pieces)]
        out = dict.fromkeys(range(len(texts)), np.empty(0, np.int32))
        if plain:
            counts, before = self._counts(numbers)
            at = 0
            for i, base in zip(plain, before[firsts].tolist(), strict=True):
                out[i] = counts[at : at + len(texts[i]) + 1] - np.int32(base)
                at += len(out[i])
        out.update((i, self.text(texts[i])) for i in others)
        return list(out.values())


def _with_room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, moved to twice the room where the size asks for more."""
    if size <= len(array):
        return array
    out = np.zeros(2 * size, array.dtype)
    out[: len(array)] = array
    return out


class _Numbers(dict):
    """Pieces by number, in the order in which they were first asked for; `new` lists those not yet learned."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number


_models: dict[str, PrefixCounts] = {}


def model(vocabulary_path: str) -> PrefixCounts:
    """One model per Python process and vocabulary; the file must be on every executor."""
    if vocabulary_path not in _models:
        _models[vocabulary_path] = PrefixCounts(vocabulary_path)
    return _models[vocabulary_path]


def prefix_token_counts(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: its id, `n_bytes` of the text in UTF-8, and `counts`.

    `counts[p]` is the number of tokens of the first p characters as a text of their own, as the library would encode them,
    without added tokens; p goes from 0 to the number of characters. It is null where the first p characters end inside
    a sequence that normalisation joins into one character (a letter and its accent); the last entry never is.
    The strings of special tokens count one each where they are complete.

    Null and empty texts have the one count 0. Ids may be null or repeat; equal rows give equal rows. Other columns are
    ignored, whatever their names. An empty table gives an empty result. A text of any length is worked out in pieces;
    its counts take four bytes a character in one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = model(vocabulary_path)
        for batch in batches:
            first, texts, chars = 0, [], 0
            for i, text in enumerate(batch.column(2).to_pylist(), 1):
                texts.append(text)
                chars += len(text)
                if chars >= OUT_CHARS or i == batch.num_rows:
                    lists = counter.texts(texts)
                    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                    flat = np.concatenate(lists)
                    column = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, mask=flat < 0))
                    own = batch.slice(first, i - first)
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), column], names=["id", "n_bytes", "counts"])
                    first, texts, chars = i, [], 0

    body = empty_for_null(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(body).cast("bigint").alias("n_bytes"), body.alias("body"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, n_bytes bigint, counts array<int>").withColumnRenamed("id", id_col)


def tokens_of_prefix(counts: Column, chars: Column | int) -> Column:
    """Tokens of the first `chars` characters; null inside what normalisation joins and beyond the text."""
    return F.get(counts, chars if isinstance(chars, Column) else F.lit(chars))


def token_count(counts: Column) -> Column:
    return F.element_at(counts, -1)


def is_within(counts: Column, limit: Column | int) -> Column:
    return token_count(counts) <= limit


def longest_prefix_within(counts: Column, limit: int) -> Column:
    """Characters of the longest prefix of at most `limit` tokens. Longer prefixes may have fewer tokens than shorter
    ones, so all are looked at; the empty prefix always fits."""
    fits = F.transform(F.reverse(counts), lambda n: F.coalesce(n <= limit, F.lit(False)))
    return F.size(counts) - F.array_position(fits, True)
