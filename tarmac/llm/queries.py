"""The operators as queries over the given tables, with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, chat, nbsvm, secrets, token_counts
from tarmac.llm.common import read
from tarmac.llm.cross_entropy import cross_entropy_difference
from tarmac.llm.exact_dedup import exact_dedup
from tarmac.llm.minhash import near_duplicates
from tarmac.llm.packing import pack_documents
from tarmac.llm.phrases import mine_phrases
from tarmac.llm.quality_rules import quality_rules
from tarmac.llm.search import rank_documents
from tarmac.llm.suffix_dedup import remove_repeats
from tarmac.session import stored

#: Vocabulary files; every executor has them under the same path.
PACKING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
COUNTING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PREDICTED_FROM = 0.7
TOKEN_LIMIT = 2048


def op1_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=2)


def op2_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    pieces = pack_documents(docs, PACKING_TOKENIZER, public_tokenizers.PATTERN)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents labelled as good are the target; all documents are the background."""
    good = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = docs.join(good.withColumn("target", F.lit(True)).hint("merge"), "doc_id", "left")
    return cross_entropy_difference(marked)


def op4_block_naming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op6_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind, _ in secrets.PATTERNS],
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op7_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_rules(docs).select(F.col("doc.doc_id").alias("doc_id"), *counts, "base_failed", "kept")


def op8_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    fold = nbsvm.fold("doc_id")
    labels = labels.filter((fold != 2) & F.col("label").isNotNull())
    # Labels grow with the documents, so the plan is the one for large tables at every size.
    train = docs.filter(fold != 2).join(labels.hint("merge"), "doc_id")
    draw = F.xxhash64("doc_id", F.lit("draw"))
    train = stored(train.select("label", draw.alias("draw"), F.coalesce("text", F.lit("")).alias("body")), "labelled")
    scored = nbsvm.score(docs, nbsvm.fit(train))
    return scored.select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    out = chat.format_conversations(turns.unionByName(own))
    read_back = chat.read_turns(F.col("formatted"))
    out = out.withColumn("turns", read_back).withColumn("learned", chat.learned_text(F.col("segments")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "n_blocks",
    )


def op10_bpe_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(read(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, BPE_RANKS, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.prefix_token_counts(read(spark, sf_dir, "documents"), COUNTING_TOKENIZER)
    counts = F.col("counts")
    return counted.select(
        "doc_id",
        "n_bytes",
        token_counts.token_count(counts).cast("bigint").alias("n_tokens"),
        (~token_counts.is_within(counts, TOKEN_LIMIT)).alias("over_limit"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(read(spark, sf_dir, "documents"))


def op13_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_hyperminhash_dedup,
        op2_bm25_packing,
        op3_cross_entropy_difference,
        op4_block_naming_dedup,
        op5_suffix_array_dedup,
        op6_markov_secrets,
        op7_adaptive_quality,
        op8_nbsvm_quality,
        op9_chat_format,
        op10_bpe_matrix,
        op11_prefix_token_counts,
        op12_phrase_collocations,
        op13_nra_search,
    )
}
