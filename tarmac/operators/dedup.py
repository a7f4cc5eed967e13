"""Duplicate rows and duplicate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_by_key(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the first in the given order, or in the order of all columns.

    Keeping only rank 1 lets each task drop all but its own first row of a key before the
    shuffle, so a key with many copies stays small.
    """
    first = Window.partitionBy(key).orderBy(*(order_by or [c for c in df.columns if c != key]))
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def valid(df: DataFrame, needed: list[str]) -> DataFrame:
    """Rows with the needed values."""
    return df.na.drop(subset=needed)


def valid_then_first(
    df: DataFrame, key: str, needed: list[str], order_by: list[str] | None = None
) -> DataFrame:
    """Rows with the needed values only, then the first of each key."""
    return first_by_key(valid(df, needed), key, order_by)


def valid_distinct(df: DataFrame, needed: list[str]) -> DataFrame:
    """Distinct rows that have the needed values; the filter comes first as it is cheaper there
    and copies of a row pass or fail it together."""
    return valid(df, needed).dropDuplicates()


def count_duplicate_rows(df: DataFrame) -> DataFrame:
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
