"""Projections, filters and null handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.text import strip


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def project_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[c for c in wanted if c in df.columns])


def drop_null_critical(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.drop(subset=columns)


def valid_interval(df: DataFrame, start: str = "departure_time", end: str = "arrival_time") -> DataFrame:
    return df.filter(F.col(end) > F.col(start))


def duration_in_range(df: DataFrame, column: str = "duration_mins", top: float = C.MAX_JOURNEY_MINUTES) -> DataFrame:
    return df.filter((F.col(column) > 0) & (F.col(column) <= top))


def not_in(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(values))


def not_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) != F.lit(value))


def slice_by(df: DataFrame, chosen: dict[str, object]) -> DataFrame:
    """Report slicers: a value, a list of values, or a (from, to) pair, per column."""
    for column, choice in chosen.items():
        if isinstance(choice, tuple):
            low, high = choice
            df = df.filter(F.col(column).between(F.lit(low), F.lit(high)))
        elif isinstance(choice, list):
            df = df.filter(F.col(column).isin(choice))
        else:
            df = df.filter(F.col(column) == F.lit(choice))
    return df


def delayed_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_delayed") == 1)


def fill_constants(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    return df.na.fill(constants)


def fill_strings(df: DataFrame, filler: str = C.UNKNOWN_LABEL) -> DataFrame:
    """Every text column without missing values and without outer white space."""
    return df.select(
        *[
            strip(F.coalesce(F.col(name), F.lit(filler))).alias(name) if kind == "string" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def head(df: DataFrame, order_by: list[str], n: int) -> DataFrame:
    return df.orderBy(*order_by).limit(n)
