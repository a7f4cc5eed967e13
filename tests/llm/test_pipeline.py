"""Each stage of the pipeline on what the stage before kept, against SQL or plain Python."""

from collections import defaultdict

import brute
import corpus_pipeline
import duckdb
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm.oracle import ORACLE_SQL

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_sql(folder, query, columns):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}')")
    return db.execute(f"SELECT {columns} FROM ({ORACLE_SQL[query]})").fetchall()


def masked(text, spans):
    """The text with the union of spans (kind:start:end) replaced; touching ones are one."""
    runs = []
    for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(end, runs[-1][1])
        else:
            runs.append([start, end])
    for start, end in reversed(runs):
        text = text[:start] + "<secret>" + text[end:]
    return text


def tokens_of(pieces):
    found = defaultdict(dict)
    for p in pieces:
        found[p.doc_id][p.start] = np.frombuffer(p.ids, "<u4").tolist()
    return {d: [i for _, ids in sorted(parts.items()) for i in ids] for d, parts in found.items()}


def test_stages_and_run(spark, tmp_path):
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in raw.collect()}

    def kept(name, docs):
        out = stage[name](spark, docs, SMALL)
        assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        again = spark.read.parquet(f"{tmp_path}/{name}")
        return again, {r.doc_id: r.text for r in again.collect()}

    docs, good = kept("quality_rules", raw)
    want = by_sql(f"{SMALL}/documents.parquet", "op7_adaptive_quality", "doc_id, kept")
    assert good == {d: texts[d] for d, keep in want if keep} and 0 < len(good) < len(texts)

    docs, single = kept("exact_dedup", docs)
    want = by_sql(f"{tmp_path}/quality_rules/*.parquet", "op4_block_naming_dedup", "doc_id, kept")
    assert single == {d: good[d] for d, keep in want if keep}

    docs, distinct = kept("near_dedup", docs)
    want = brute.near_components(list(single.items()), 5)
    assert distinct == {d: t for d, t in single.items() if want[d][1] == d}

    docs, clean = kept("secret_scan", docs)
    want = by_sql(f"{tmp_path}/near_dedup/*.parquet", "op6_markov_secrets", "doc_id, spans")
    assert clean == {d: masked(distinct[d], spans or "") for d, spans in want}

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: library.encode(t, add_special_tokens=False).ids + [0] for d, t in clean.items()}
    assert tokens_of(stage["packing"](spark, docs, SMALL).collect()) == want
    assert tokens_of(corpus_pipeline.run(spark, SMALL).collect()) == want


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_nulls_repeats_and_clashing_columns(spark, empty):
    prose = " ".join(f"w{i}" for i in range(60))
    rows = [
        (None, prose, None, None, None), (1, prose, "en", "a", 3), (1, prose, "en", "a", 3), (2, None, "en", "a", None),
        (3, "", "en", None, 0), (4, prose.replace("w7 ", "x "), None, "a", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumns({c: F.lit("x") for c in ("doc", "body", "id", "kept", "row", "spans", "component_id")})
    docs = docs.limit(0) if empty else docs
    got = {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        got[name] = sorted((r.doc_id or 0) for r in out.collect())
    if empty:
        assert not any(got.values())
    else:
        assert got["quality_rules"] == [0, 1, 1, 4]
        assert got["exact_dedup"] == [1, 2, 4]
        # Rows without an id are linked with nothing; rows that repeat an id are one document here.
        assert got["near_dedup"] == [0, 1, 1, 2, 3]
        assert got["secret_scan"] == got["packing"] == [0, 1, 1, 2, 3, 4]
