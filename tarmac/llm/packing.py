"""Packing documents into windows by lexical retrieval.

Documents are tokenised once and written. Those that share their least hashed tokens lie near each other after a
range shuffle, whose last sort key is a hash of the row, so a large group of like documents spreads over tasks. A
task goes through its documents in shards of a few hundred. Each shard has an inverted index with
BM25 weights; token frequencies and lengths are those of all documents. A seed document fills its window,
then the unused documents of its shard in order of their score, until the window is full. The
document that doesn't fit is cut and its rest seeds the next window, so only the last window of a task has padding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import empty_for_null
from tarmac.llm.hashing import mix
from tarmac.session import stored

WINDOW = 1024
SHARD_DOCS = 256
SHARD_TOKENS = 2_000_000
K1, B = 1.2, 0.75
END = 0
#: Weights are laid out as a table of tokens and documents where it has at most so many fields for each one that is filled.
TABLE_SHARE = 16
KEPT_PIECES = 300_000
#: Characters beyond which a text is encoded piece by piece.
LONG_TEXT = 300_000
OUT_TOKENS = 500_000
SORT_TOKENS = 4
#: Ends of patterns that leave the last of several white-space characters to the word after them, and what is the same
#: for texts in which no two of them meet; the library is faster without looking ahead.
LOOKING_AHEAD, PLAIN = r"|\s+(?!\S)|\s+", r"|\s+"
#: Python counts all white space of the library's patterns as such, and a few characters more.
SPACES = re.compile(r"\s\s")
#: A special token that is never allowed, so its string in a text is text like any other.
UNUSED_SPECIAL = "<|unused|>"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others moved up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """Token ids as the library's tokenizer gives them, worked out once per distinct piece of the pattern.

    Pieces are encoded one by one, which the byte-level pre-tokenizer does itself; texts that hold the string
    of a special token go to the tokenizer as a whole. Where the tokenizer's ids are the ranks of its merges, a
    rank encoder made from its own vocabulary encodes them, which takes a tenth of the time; it takes texts as a
    whole, but for very long ones, for which its own search for pieces needs too much memory. A second one, whose pattern
    looks nowhere ahead, takes texts without neighbouring white space.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(pattern).findall
        self.kept: dict[str, list[int]] = {}
        described = json.loads(Path(path).read_text())["model"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in described["merges"]]
        merged = [described["vocab"]["".join(pair)] for pair in pairs]
        if all(a < b for a, b in zip(merged, merged[1:], strict=False)):
            byte_of = _byte_of()
            vocab = {t: i for t, i in described["vocab"].items() if t not in self.special}
            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
            # Without any special token the library looks for the empty string, which it finds before every character.
            none = {UNUSED_SPECIAL: max(ranks.values()) + 1}
            own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=none)
            self.one, self.whole = own.encode_ordinary, lambda text: own.encode_to_numpy(text, disallowed_special=())
            self.plain = self.whole
            if pattern.endswith(LOOKING_AHEAD):
                plain = pattern.removesuffix(LOOKING_AHEAD) + PLAIN
                plain = tiktoken.Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens=none)
                self.plain = lambda text: plain.encode_to_numpy(text, disallowed_special=())
        else:
            self.one, self.whole = lambda piece: self.tokenizer.encode(piece, add_special_tokens=False).ids, None

    def encode(self, text: str) -> list[int] | np.ndarray:
        if any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if self.whole is not None and len(text) <= LONG_TEXT:
            return self.whole(text) if SPACES.search(text) else self.plain(text)
        kept = self.kept
        if len(kept) > KEPT_PIECES:
            kept.clear()
        ids: list[int] = []
        for p in self.cut(text):
            own = kept.get(p)
            if own is None:
                own = kept[p] = self.one(p)
            ids += own
        return ids


_tokenizers: dict[tuple[str, str], Pieces] = {}


def _distinct(ranks: np.ndarray, stamp: np.ndarray) -> np.ndarray:
    """The distinct ranks in any order, without sorting: each at the last place that writes its stamp."""
    places = np.arange(len(ranks))
    stamp[ranks] = places
    return ranks[stamp[ranks] == places]


def _tokens(path: str, pattern: str, kind: str, size: int):
    """Ids and place of every row. A task's last row has instead its documents per token, its documents and all its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _tokenizers:
            _tokenizers[path, pattern] = Pieces(path, pattern)
        encode = _tokenizers[path, pattern].encode
        # Hashes of all ids, and each id's rank among them.
        hashes = mix(np.arange(size, dtype=np.uint64) + np.uint64(1))
        by_hash = np.argsort(hashes)
        rank = np.empty(size, kind)
        rank[by_hash] = np.arange(size)
        ordered = hashes[by_hash].astype(">u8")
        seen = np.zeros(size, np.int64)
        stamp = np.zeros(size, np.int64)
        docs = tokens = 0
        names = ["id", "ids", "place", "seen"]
        id_kind = pa.null()
        for batch in batches:
            id_kind = batch.column(0).type
            first, ids, keys, total = 0, [], [], 0
            for i, text in enumerate(batch.column(1).to_pylist(), 1):
                found = encode(text)
                own = np.full(len(found) + 1, END, kind)
                own[:-1] = found
                distinct = _distinct(rank[own], stamp)
                seen[distinct] += 1
                least = distinct if len(distinct) <= SORT_TOKENS else np.partition(distinct, SORT_TOKENS - 1)[:SORT_TOKENS]
                keys.append(ordered[np.sort(least)].tobytes())
                ids.append(own.tobytes())
                total += len(own)
                if total >= OUT_TOKENS or i == batch.num_rows:
                    columns = [pa.array(ids, pa.binary()), pa.array(keys, pa.binary()), pa.nulls(len(ids), pa.binary())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i - first), *columns], names=names)
                    docs, tokens = docs + len(ids), tokens + total
                    first, ids, keys, total = i, [], [], 0
        if docs:
            counted = np.append(seen[rank], [docs, tokens]).tobytes()
            columns = [pa.nulls(1, id_kind), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), pa.array([counted], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per token, and as tokens -1 and -2 all documents and tokens, of the tokenising tasks that a task reads."""
    for batch in batches:
        counts = sum(np.frombuffer(raw.as_buffer(), np.int64) for raw in batch.column(0))
        if batch.num_rows:
            token = np.append(np.arange(len(counts) - 2), [-1, -2])
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(token[at]), pa.array(counts[at])], names=["token", "n"])


class Shard:
    """Inverted index of a few hundred documents: postings by token with their BM25 weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        length = np.array([len(ids) for ids in docs])
        both = np.repeat(np.arange(len(docs)), length) << 32
        both |= np.concatenate(docs)
        # Sorted by document and token; equal pairs are counted.
        both.sort()
        at = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        count = np.diff(np.append(at, len(both)))
        row, token = both[at] >> 32, both[at] & 0xFFFFFFFF
        self.terms = np.split(token, np.flatnonzero(row[1:] != row[:-1]) + 1)
        norm = K1 * (1 - B + B * length[row] / mean_length)
        weight = idf[token] * count * (K1 + 1) / (count + norm)
        order = np.argsort(token, kind="stable")
        self.row, self.weight = row[order], weight[order]
        self.token, self.first = np.unique(token[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        self.n = len(docs)
        # Where documents share most of their tokens, rows of weights are added faster than postings.
        self.table = None
        if len(self.token) * self.n <= TABLE_SHARE * len(order):
            self.table = np.zeros((len(self.token), self.n))
            self.table[np.repeat(np.arange(len(self.token)), self.last - self.first), self.row] = self.weight

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """BM25 score of every document for the distinct tokens of a seed, added in the order of the tokens."""
        at = np.searchsorted(self.token, terms)
        at = at[(at < len(self.token)) & (self.token[np.minimum(at, len(self.token) - 1)] == terms)]
        if not len(at):
            return np.zeros(self.n)
        if self.table is not None:
            return self.table[at].sum(axis=0)
        first, n = self.first[at], self.last[at] - self.first[at]
        postings = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.row[postings], self.weight[postings], self.n)


class Packer:
    """Fills windows from shards; the open window and its seed go on to the next shard."""

    def __init__(self, idf: np.ndarray, mean_length: float, window: int, task: int):
        self.idf, self.mean_length, self.window = idf, mean_length, window
        self.sequence, self.used = task << 40, 0
        self.seed: np.ndarray | None = None

    def _put(self, name, ids: np.ndarray, out: list) -> bool:
        """Adds a document; True when it was cut, so that its rest opened a new window."""
        start, cut = 0, False
        while start < len(ids):
            n = min(len(ids) - start, self.window - self.used)
            out.append((name, start, ids[start : start + n], len(ids), self.sequence, self.used))
            start, self.used = start + n, self.used + n
            if self.used == self.window:
                self.sequence, self.used = self.sequence + 1, 0
                cut = True
        return cut

    def shard(self, names: list, docs: list[np.ndarray]) -> Iterator[list]:
        index = Shard(docs, self.idf, self.mean_length)
        unused = np.ones(len(docs), bool)
        following = 0
        while True:
            out: list = []
            if self.used == 0 or self.seed is None:
                while following < len(docs) and not unused[following]:
                    following += 1
                if following == len(docs):
                    return
                unused[following] = False
                self._put(names[following], docs[following], out)
                self.seed = index.terms[following]
            if self.used:
                scores = index.scores(self.seed)
                free = np.flatnonzero(unused)
                for k in free[np.argsort(-scores[free], kind="stable")]:
                    unused[k] = False
                    if self._put(names[k], docs[k], out):
                        self.seed = index.terms[k]
                        break
            yield out
            if not unused.any():
                return


def _packed(idf: np.ndarray, mean_length: float, window: int, shard_docs: int, stored_as: str):
    def batch_of(pieces: list, kind: pa.DataType) -> pa.RecordBatch:
        column = lambda k, t: pa.array([p[k] for p in pieces], t)
        return pa.RecordBatch.from_arrays(
            [
                column(0, kind),
                column(1, pa.int64()),
                pa.array([len(p[2]) for p in pieces], pa.int64()),
                pa.array([p[2].astype("<u4").tobytes() for p in pieces], pa.binary()),
                column(3, pa.int64()),
                column(4, pa.int64()),
                column(5, pa.int64()),
            ],
            names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(idf, mean_length, window, TaskContext.get().partitionId())
        names, docs, tokens, kind = [], [], 0, pa.null()

        def flush() -> Iterator[pa.RecordBatch]:
            pieces: list = []
            for out in packer.shard(names, docs):
                pieces += out
                if len(pieces) >= 2000:
                    yield batch_of(pieces, kind)
                    pieces = []
            if pieces:
                yield batch_of(pieces, kind)

        for batch in batches:
            kind = batch.column(0).type
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names.append(name)
                docs.append(np.frombuffer(raw.as_buffer(), stored_as))
                tokens += len(docs[-1])
                if len(docs) == shard_docs or tokens >= SHARD_TOKENS:
                    yield from flush()
                    names, docs, tokens = [], [], 0
        if docs:
            yield from flush()

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """One row per piece: id, `start`, `length`, `ids`, `doc_tokens`, `sequence_id`, `offset`.

    `ids` holds the piece's token ids as little-endian 32-bit numbers. A document is its tokens and the end token;
    null and empty texts are the end token alone. Each row of the input is packed once, also where ids
    repeat or are null; other columns are ignored. An empty table gives an empty result.
    """
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)
    stored_as = "<u2" if size <= 1 << 16 else "<u4"
    rows = docs.select(F.col(id_col).alias("id"), empty_for_null(text_col).alias("body"))
    kind = dict(rows.dtypes)["id"]
    written = rows.mapInArrow(
        _tokens(tokenizer_path, pattern, stored_as, size), f"id {kind}, ids binary, place binary, seen binary"
    )
    written = stored(written, "tokens")
    tokens = written.filter("ids is not null").select("id", "ids", "place")
    # At most one row per token of the vocabulary.
    counted = written.filter("seen is not null").select("seen").mapInArrow(_frequencies, "token bigint, n bigint")
    seen = {r["token"]: r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_tokens = seen.pop(-1, 0), seen.pop(-2, 0)
    per_token = np.zeros(size)
    per_token[list(seen)] = list(seen.values())
    idf = np.log1p((n_docs - per_token + 0.5) / (per_token + 0.5))
    spread = tokens.withColumn("spread", F.xxhash64("id", "ids"))
    near = spread.repartitionByRange("place", "spread").sortWithinPartitions("place", "spread", "id")
    out = near.select("id", "ids").mapInArrow(
        _packed(idf, max(1.0, n_tokens / max(1, n_docs)), window, shard_docs, stored_as),
        f"id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
    return out.withColumnRenamed("id", id_col)
