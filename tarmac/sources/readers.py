"""Reading tables and checking what was read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Column with the position of a row in its files, see `with_file_order`.
FILE_ORDER = "_file_order"


class MissingTableError(ValueError):
    """A required table is not there."""


class ColumnCountError(ValueError):
    """A table does not have the number of columns it is to be renamed to."""


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line; types are declared, never guessed by an extra pass."""
    return read(spark, path, "csv", schema)


def first_available(
    spark: SparkSession, candidates: Iterable[str], fmt: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """The first of several paths that exists."""
    tried = list(candidates)
    for path in tried:
        try:
            return read(spark, path, fmt, schema)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these inputs exists: {tried}")


def read_tables(
    spark: SparkSession,
    base: str,
    names: Iterable[str],
    fmt: str = "parquet",
    suffix: str = "",
    schemas: Mapping[str, StructType] | None = None,
    keep_order: bool = True,
) -> dict[str, DataFrame]:
    """Those of the named tables that exist below one folder.

    Rows carry their place in the files (`with_file_order`) unless `keep_order` is false: cleaning then takes the first row
    of a key in file order if it is told no other, and drops the place in the end.
    """
    found = {}
    for name in names:
        try:
            table = read(spark, f"{base}/{name}{suffix}", fmt, (schemas or {}).get(name))
            found[name] = with_file_order(table) if keep_order else table
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def require_tables(tables: Mapping[str, DataFrame], required: Iterable[str]) -> Mapping[str, DataFrame]:
    missing = [name for name in required if name not in tables]
    if missing:
        raise MissingTableError(f"missing tables: {missing}")
    return tables


def drop_junk_columns(df: DataFrame, also: tuple[str, ...] = ("duration",)) -> DataFrame:
    """Without the nameless columns of spreadsheet exports, the listed ones and the place in the files."""
    return df.select(*[f"`{c}`" for c in df.columns if not c.startswith("Unnamed") and c not in (*also, FILE_ORDER)])


def missing_columns(df: DataFrame, expected: StructType | Iterable[str]) -> list[str]:
    names = expected.fieldNames() if isinstance(expected, StructType) else list(expected)
    return sorted(set(names) - set(df.columns))


def column_report(tables: Mapping[str, DataFrame], expected: Mapping[str, StructType]) -> DataFrame:
    """Rows and missing columns of every table."""
    reports = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(",".join(missing_columns(df, expected[name]))).alias("missing_columns"),
            "row_count",
        )
        for name, df in tables.items()
    ]
    return _union(reports)


def empty_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table is empty; one row of a table is enough to know."""
    reports = [
        df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty")).select(F.lit(name).alias("table_name"), "is_empty")
        for name, df in tables.items()
    ]
    return _union(reports)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    if len(df.columns) != len(names):
        raise ColumnCountError(f"expected {len(names)} columns, found {df.columns}")
    return df.toDF(*names)


def file_order(df: DataFrame) -> list[str] | None:
    """The column of a table that says where its rows stood in their files, if it has one."""
    return [FILE_ORDER] if FILE_ORDER in df.columns else None


def with_file_order(df: DataFrame, name: str = FILE_ORDER) -> DataFrame:
    """Position of each row in its input files, for 'first' in file order.

    Must be applied directly to a file scan. Blocks are ordered by file and offset; inside a
    block the generated id grows with the row, so the order does not depend on how blocks are
    spread over tasks.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(name, place)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
