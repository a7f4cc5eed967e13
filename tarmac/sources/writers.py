"""Writing results and checking what was written."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.session import CODEC
from tarmac.sources.readers import _union, read

# --- fixed values: storage types of the report export ---
DOUBLE_COLUMNS = ["duration_mins", "amount"]
WHOLE_COLUMNS = ["is_overnight", "is_delayed", "departure_hour", "age", "birth_year"]
# --- fixed values: types of the report model ---
MODEL_TYPES = {
    "departure_time": "timestamp_ntz",
    "arrival_time": "timestamp_ntz",
    "departure_date": "date",
    "booking_date": "date",
    "duration_mins": "double",
    "amount": "double",
    "is_delayed": "bigint",
    "is_overnight": "bigint",
    "age": "bigint",
    "birth_year": "bigint",
    "gender": "string",
    "age_group": "string",
}


def write_tables(tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Each table in its own folder; returns the folders. Adaptive execution sizes the files."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base}/{name}"
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        if fmt == "parquet":
            writer = writer.option("compression", CODEC)
        writer.save(paths[name])
    return paths


def typed_for_export(df: DataFrame) -> DataFrame:
    """Storage types of the report file: numbers where listed, text everywhere else."""

    def kind(name: str) -> str:
        if name in DOUBLE_COLUMNS:
            return "double"
        return "bigint" if name in WHOLE_COLUMNS else "string"

    return df.select(*[F.col(c).cast(kind(c)).alias(c) for c in df.columns])


def typed_for_model(df: DataFrame) -> DataFrame:
    """Types of the report model for the columns it names; others keep theirs."""
    return df.select(*[F.col(c).cast(MODEL_TYPES[c]).alias(c) if c in MODEL_TYPES else F.col(c) for c in df.columns])


def check_outputs(
    spark: SparkSession, base: str, expected: Mapping[str, StructType | list[str]], fmt: str = "parquet"
) -> DataFrame:
    """Per expected table: is it readable, with the expected columns (and types, where a schema is
    given) and at least one row."""
    reports = []
    for name, wanted in expected.items():
        names = wanted.fieldNames() if isinstance(wanted, StructType) else list(wanted)
        try:
            df = read(spark, f"{base}/{name}", fmt)
        except AnalysisException:
            df, same = spark.range(0).select(), False
        else:
            same = df.columns == names
            if isinstance(wanted, StructType):
                same = same and [f.dataType for f in df.schema] == [f.dataType for f in wanted]
        reports.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                (F.lit(same) & (F.col("row_count") > 0)).alias("ok"),
                "row_count",
            )
        )
    return _union(reports)
