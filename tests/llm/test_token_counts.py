"""Prefix token counts against the library, on every prefix."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import queries, token_counts
from tarmac.llm.token_counts import longest_prefix_within, prefix_token_counts, tokens_of_prefix

PATH = queries.COUNTING_TOKENIZER
PARTS = [
    "a", "b", "'", "s", "re", "LL", "VE", " ", "\n", "!", "<|endoftext|>", "<|startoftext|>", "<|end", "|>", "é",
    "é", "İ", "Σ", "ς", "漢字", "1", "２", "½", "́", "가", "가",
    "\U0001f600", "th", "ing", "\x85", "​", "　", "\x1c", "ſ", "K", "__", "...", "̀ͅ",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return token_counts.model(PATH)


def test_every_prefix(counter, library):
    draw = random.Random(5)
    for _ in range(1500):
        text = "".join(draw.choices(PARTS, k=draw.randint(0, 12)))
        counts = counter.text(text)
        assert len(counts) == len(text) + 1
        assert counts[-1] >= 0
        for p, n in enumerate(counts):
            assert n in (-1, library(text[:p])), (text, p)


def test_every_character(counter, library):
    kinds = (chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000)
    for c in kinds:
        text = f"a{c}b {c}!{c}1{c}"
        if ord(c) % 97 == 0 or (ord(c) < 0x3000 and not c.isalpha()):
            assert counter.text(text)[-1] == library(text), hex(ord(c))


def test_counts_survive_forgetting(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 5)
    monkeypatch.setattr(token_counts, "KEPT_PAIRS", 3)
    monkeypatch.setattr(token_counts, "STEP_PIECES", 4)
    own = token_counts.PrefixCounts(PATH)
    for text in ("one two three four five six seven", "six seven EIGHT nine ten eleven one two", "one"):
        assert own.text(text)[-1] == library(text)


def test_texts_are_worked_out_together(library):
    """New words of many texts, a long one too, go through the vocabulary in one step instead of one for each text."""
    own, asked = token_counts.PrefixCounts(PATH), []
    words = own.words
    own.words = lambda pieces: asked.append(len(pieces)) or words(pieces)
    draw = random.Random(7)
    texts = ["".join(draw.choices("abcdeé '\n1", k=60)) for _ in range(200)]
    texts += ["", " ", " word", "word", "two  spaces", "x" * 50 + "unbelievable" * 20, "a\u0301 joined", "İ", "a <|endoftext|> b"]
    got = own.texts(texts)
    assert sum(n > 2 for n in asked) <= 5
    for text, counts in zip(texts, got, strict=True):
        assert len(counts) == len(text) + 1
        assert all(n in (-1, library(text[:p])) for p, n in enumerate(counts)), text
        assert counts[-1] >= 0


def test_odd_rows(spark, library):
    long = "A very long text, isn't it? " * 20_000 + "x" * 50_000
    texts = [(1, None, "u"), (2, "", "v"), (2, "", "v"), (None, "Hello wörld", None), (3, long, "w")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, counts string")
    got = prefix_token_counts(docs, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.counts[-1], len(r.counts)) for r in got) == sorted(
        (d or 0, len((t or "").encode()), library(t or ""), len(t or "") + 1) for d, t, _ in texts
    )
    assert prefix_token_counts(docs.limit(0), PATH).collect() == []


def test_budgets(spark, library):
    text = "unbelievable tokenization of hellos, isn't it"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")
    counted = prefix_token_counts(docs, PATH)
    for limit in (0, 1, 3, 5, 100):
        got = dict(counted.select("doc_id", longest_prefix_within(F.col("counts"), limit)).collect())
        assert got == {1: max(p for p in range(len(text) + 1) if library(text[:p]) <= limit), 2: 0}
    assert counted.filter("doc_id = 1").select(tokens_of_prefix(F.col("counts"), 9)).first()[0] == library(text[:9])
    assert counted.filter("doc_id = 2").select(tokens_of_prefix(F.col("counts"), 9)).first()[0] is None


def test_query(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {(d, len((t or "").encode()), n := library(t or ""), n > 2048) for d, t in docs}
    got = queries.op11_prefix_token_counts(spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert {tuple(r) for r in got.collect()} == want
    assert public_tokenizers.path("word_bpe_49k.json") == PATH
