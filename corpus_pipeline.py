"""A corpus pipeline: quality rules, exact and near duplicates, secrets, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import secrets
from tarmac.llm.common import read
from tarmac.llm.exact_dedup import exact_dedup
from tarmac.llm.minhash import near_duplicates
from tarmac.llm.packing import pack_documents
from tarmac.llm.quality_rules import quality_rules
from tarmac.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the limits of their language and source let pass.

    Null, empty and blank texts have too few words and go. A null language or source is a group of its own. Rows that
    repeat are judged, and count, one by one. The row travels as one struct, so no column name can clash with a count's.
    An empty table stays empty.
    """
    return quality_rules(docs).filter("kept").select("doc.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text the one with the smallest id.

    Null and empty texts are equal. Rows without an id come last; of rows that repeat an id and a text, one stays.
    The row travels as one struct. An empty table stays empty.
    """
    return exact_dedup(docs, carry=True).filter("kept").select("doc.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the one with the smallest id.

    Texts without words are linked with nothing and stay, as do rows without an id. Rows that repeat an id stay or go
    together. Other columns take no part. An empty table stays empty.
    """
    kept = near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked.

    A null text stays null; every row comes back once, also where ids or whole rows repeat. The row travels as one
    struct. An empty table stays empty.
    """
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training windows.

    Null and empty texts are the end token alone. Every row is packed once, also where ids repeat or are null; other
    columns are ignored. An empty table gives no pieces.
    """
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("secret_scan", redacted),
    ("packing", packed),
]

#: Tokenisation and retrieval order have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
