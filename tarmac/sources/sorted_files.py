"""Tables stored in order, with the borders of their files, and a check that they are.

A sorted table lies in files by ranges of the sort key: the files' numbers follow the order, and so do the rows of a file.
Beside the table lies one row per file with its first and last key. Rows that are equal in all sort columns share a file, so
a column that tells rows apart should come last. Ascending columns have missing values first, descending ones last.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.sources.readers import read

#: Sort columns, each with whether it descends.
Order = list[tuple[str, bool]]
#: Rows that one group of the order check compares; blocks of a file overlap by one row.
BLOCK_ROWS = 1_000_000
#: File numbers are numbers of tasks times this, plus the turn of the task's file.
TURNS = 1_000_000


def sort_columns(order: Order) -> list[Column]:
    return [F.desc(c) if descending else F.asc(c) for c, descending in order]


def borders_path(path: str) -> str:
    return f"{path}-borders"


def write_sorted(df: DataFrame, path: str, order: Order) -> None:
    """Write a table in order, and beside it the borders of its files, which are read back from what was written."""
    df.orderBy(*sort_columns(order)).write.parquet(path)
    borders(placed(df.sparkSession, path), order).write.parquet(borders_path(path))


def placed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table with the number of their file, `_file`, and their place in it from 0, `_place`.

    A task writes several files, numbered in turn, where a limit for the rows of a file is set.
    """
    task, turn = [F.regexp_extract("_metadata.file_name", p, 1).cast("bigint") for p in (r"^part-(\d+)", r"c(\d+)\.")]
    number = task * TURNS + F.coalesce(turn, F.lit(0))
    table = read(spark, path)
    return table.select("*", number.alias("_file"), F.col("_metadata.row_index").alias("_place"))


def borders(rows: DataFrame, order: Order) -> DataFrame:
    """For each file its rows and its first and last sort key. Files without rows have no borders."""
    key = F.struct(*[c for c, _ in order])
    return rows.groupBy("_file").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min_by(key, F.col("_place")).alias("_first"),
        F.max_by(key, F.col("_place")).alias("_last"),
    )


def read_borders(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, borders_path(path))


def positions(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The table with the place of each row in the whole order, from 1. Places come from the stored borders: no row is
    sorted, and a window only goes over one row per file."""
    files = read_borders(spark, path).select("_file", "_rows")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    table = placed(spark, path)
    own = [c for c in table.columns if c not in ("_file", "_place")]
    return table.join(starts, "_file", "left").select(*own, (F.col("_start") + F.col("_place") + 1).alias(name))


def sorts_before(a: str, b: str, order: Order) -> Column:
    """Whether key struct `a` comes strictly before `b` in the order."""
    steps = []
    for i, (column, descending) in enumerate(order):
        x, y = F.col(f"{a}.{column}"), F.col(f"{b}.{column}")
        less = (x > y) | (x.isNotNull() & y.isNull()) if descending else (x < y) | (x.isNull() & y.isNotNull())
        same = [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c, _ in order[:i]]
        steps.append(reduce(and_, same, F.coalesce(less, F.lit(False))))
    return reduce(or_, steps)


def order_report(spark: SparkSession, path: str, order: Order, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row: number of rows, rows that come before the row ahead of them in their file, files that begin before the file
    ahead of them ends, and files whose borders are not the stored ones (missing and superfluous ones included).

    An empty table has zeros. Files of every size are compared in blocks.
    """
    rows = placed(spark, path)
    key = F.struct(*[c for c, _ in order]).alias("_key")
    block = F.floor(F.col("_place") / block_rows)
    # The last row of a block is compared with the first one of the next block as well.
    last = F.col("_place") % block_rows == block_rows - 1
    blocks = F.when(last, F.array(block, block + 1)).otherwise(F.array(block))
    ahead = Window.partitionBy("_file", "_block").orderBy("_place")
    pairs = rows.select("_file", "_place", key, F.explode(blocks).alias("_block")).withColumn(
        "_ahead", F.lag("_key").over(ahead)
    )
    wrong_rows = pairs.filter(F.col("_ahead").isNotNull() & sorts_before("_key", "_ahead", order))
    kept = read_borders(spark, path)
    files = Window.orderBy("_file")
    wrong_files = kept.withColumn("_ahead", F.lag("_last").over(files)).filter(
        F.col("_ahead").isNotNull() & sorts_before("_first", "_ahead", order)
    )
    now = borders(rows, order)
    changed = now.exceptAll(kept).unionAll(kept.exceptAll(now)).select("_file").distinct()

    def number(df: DataFrame, name: str) -> Column:
        return df.agg(F.count(F.lit(1))).scalar().alias(name)

    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        number(wrong_rows, "rows_out_of_order"),
        number(wrong_files, "files_out_of_order"),
        number(changed, "changed_files"),
    )
