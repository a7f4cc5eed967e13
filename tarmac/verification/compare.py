"""Row-for-row comparison of a query with its SQL."""

from __future__ import annotations

import datetime
import math

import duckdb
from pyspark.sql import SparkSession

from tarmac.catalog import QUERIES
from tarmac.verification.oracle import ORACLE_SQL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _in_order(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_plain(row[i]) for i in order) for row in rows]


def _rows(columns: list[str], rows) -> list[tuple]:
    return sorted(_in_order(columns, rows), key=lambda row: tuple((v is None, str(v)) for v in row))


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> list[str]:
    """What differs between the two results; empty when they are the same."""
    df = QUERIES[name](spark, folder)
    found = _rows(df.columns, df.collect())
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    wanted = _rows(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(columns)}"]
    if len(found) != len(wanted):
        return [f"{len(found)} rows instead of {len(wanted)}"]
    return [f"{a} instead of {b}" for a, b in zip(found, wanted) if a != b][:5]


def first_out_of_order(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str, sql: str | None = None):
    """The first place at which the rows of two results differ, in the order they come; None when there is none.

    `sql` takes the place of the query's SQL where that one states no order.
    """
    df = QUERIES[name](spark, folder)
    found = _in_order(df.columns, df.collect())
    result = con.execute(sql or ORACLE_SQL[name])
    wanted = _in_order([d[0] for d in result.description], result.fetchall())
    if len(found) != len(wanted):
        return min(len(found), len(wanted))
    return next((i for i, (a, b) in enumerate(zip(found, wanted)) if a != b), None)
