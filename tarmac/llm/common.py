"""What the operators of this folder share: words, white space, running totals, document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters, as regular expressions and as plain characters.
SPACE_RUN = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def empty_for_null(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space, in order."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def with_value(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The table with one more column, computed once per row.

    A plain column may be put into the expressions that use it, and a filter on one of these be pushed below it;
    inside a lambda it would then be computed for every element. The only row of a generator is neither.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def indexes(n: Column) -> Column:
    """0 to n - 1; nothing when n is 0 or less."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


#: Running totals go by chunks of this many numbers, so their work is not the square of a long array.
CHUNK = 256


def chunk_totals(lengths: Column) -> Column:
    """For an array of whole numbers the sum of each chunk."""
    chunks = indexes(F.ceil(F.size(lengths) / CHUNK))
    return F.transform(chunks, lambda c: _total(F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK))))


def before_chunks(totals: Column) -> Column:
    """For each chunk the sum of those before it."""
    return F.transform(indexes(F.size(totals)), lambda c: _total(F.slice(totals, F.lit(1), c)))


def total_before(lengths: Column, before: Column, i: Column) -> Column:
    """The sum of the numbers before place i. Both arrays must be plain columns: a lambda computes them anew each time."""
    chunk = F.floor(i / CHUNK).cast("int")
    return F.get(before, chunk) + _total(F.slice(lengths, chunk * CHUNK + 1, i % CHUNK))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
