"""The matrix encoder against the library, and an exact round trip."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from tarmac.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "",
    None,
    " ",
    "Plain words, 12345 numbers and  spaces\n\n\tat the end  ",
    "a" * 1000 + " " + "xyz" * 500,
    "　   \x1c\x85 дом 漢字 \U0001f600\U0001f600 é",
    "it's they'LL <|endoftext|>",
    "Plain words, 12345 numbers and  spaces\n\n\tat the end  ",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(PATH), special_tokens={}
    )


@pytest.mark.parametrize("group,kept", [(2_000_000, 500_000), (50, 20), (1, 1)])
def test_tokens_are_those_of_the_library(library, monkeypatch, group, kept):
    monkeypatch.setattr(bpe, "GROUP_CHARS", group)
    monkeypatch.setattr(bpe, "KEPT_PIECES", kept)
    random = np.random.default_rng(5)
    letters = list("aeinrst AB01\n.,'éж漢 ")
    texts = [t or "" for t in TEXTS] + ["".join(random.choice(letters, n)) for n in random.integers(1, 400, 60)]
    model = bpe.MatrixBpe(PATH, public_tokenizers.PATTERN)
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert model.decode(pa.array([None, ids.tolist(), []], pa.list_(pa.int32()))).to_pylist() == [b"", text.encode(), b""]


def test_documents_with_nulls_repeats_and_clashing_columns(spark, library):
    rows = [(i if i else None, t, "x", "y") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, decoded string")
    encoded = bpe.encode_documents(docs.repartition(2), PATH, public_tokenizers.PATTERN)
    found = {r["doc_id"]: r for r in bpe.decode_documents(encoded, PATH, public_tokenizers.PATTERN).collect()}
    for i, text, *_ in rows:
        assert found[i]["ids"] == library.encode_ordinary(text or "")
        assert bytes(found[i]["decoded"]) == (text or "").encode()
    assert bpe.encode_documents(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
