"""Keys that hold too many rows for one task.

A key is hot when it has more than `rows_per_task` rows, as far as the sketch of frequent keys knows (see `heavy`). Tables of
every size take the same plan; the list of hot keys may be empty, and Spark decides by its size how to join it.

Pass tables that were stored with sketches where that is possible (`heavy.stored_with_sketches`). Others are sketched by
one pass over their key column: pass tables that are read from files, not ones that would be computed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.temporal import minute_number
from tarmac.operators.heavy import frequent
from tarmac.session import stored


def hot_keys(df: DataFrame, key: str, rows_per_task: int = C.ROWS_PER_TASK) -> DataFrame:
    """Hot keys and the number of parts to split each of them into."""
    known = frequent(df, key).filter(F.col(key).isNotNull() & (F.col("_rows") > rows_per_task))
    return known.select(key, F.ceil(F.col("_rows") / rows_per_task).cast("int").alias("_parts"))


def left_join_many(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    rows_per_task: int = C.ROWS_PER_TASK,
    beside: DataFrame | None = None,
) -> DataFrame:
    """Left join whose right side may hold a large share of its rows under one key.

    Adaptive execution splits only the kept side of an outer join, so here the right rows of a hot
    key are spread over parts by a hash of `spread_by`, and the left rows of that key are
    repeated once per part. A part without right rows would add a row of nulls; the key has
    right rows in other parts, so such rows are removed. Null keys match nothing on either side.
    A sketch only names keys that it has met, so each key that is split has right rows.

    `beside` is a further table with one row per key and no name but the key's in common. It is joined to the left one part by
    part, so that neither is shuffled again for the join with the right one.
    """
    hot = hot_keys(right, key, rows_per_task)
    part = F.pmod(F.xxhash64(spread_by), F.col("_parts")).cast("int")
    spread = (
        right.join(hot, key, "left")
        .withColumn("_part", F.coalesce(part, F.lit(0)))
        .withColumn("_matched", F.lit(True))
        .drop("_parts")
    )
    all_parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    repeated = left.join(hot, key, "left").withColumn("_part", F.explode(all_parts))
    columns = left.columns
    if beside is not None:
        own_parts = beside.join(hot, key, "left").withColumn("_part", F.explode(all_parts)).drop("_parts")
        repeated = repeated.join(own_parts, [key, "_part"], "left")
        columns = columns + [c for c in beside.columns if c != key]
    return (
        repeated.join(spread, [key, "_part"], "left")
        .filter(F.col("_parts").isNull() | F.col("_matched"))
        .select(key, *[c for c in columns + right.columns if c != key])
    )


def join_many_to_many(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    left_sizes: DataFrame,
    how: str = "left",
    rows_per_task: int = C.ROWS_PER_TASK,
    left_spread_by: list[str] | None = None,
) -> DataFrame:
    """Join (left or inner) of tables that may both hold many rows under one key.

    The pairs of a frequent key form a grid: left rows are put into one of its rows by a hash of all their columns (or of
    `left_spread_by`, so that the others need not travel) and repeated in every column, right rows into one of its columns by a hash of `spread_by` and repeated in every row. So each
    pair meets in one cell. A cell reads at most about `rows_per_task` rows of either side and gives at most about
    as many; among such grids this one repeats least. Keys that no sketch names have a grid of one cell.

    `left_sizes` is a stored table with the key and no fewer rows per key than the left one. Left rows that are equal in
    all columns share a row of the grid. Null keys match nothing; left rows with one are kept by a left join.
    """
    grid = _grid(frequent(left_sizes, key), frequent(right, key), key, rows_per_task)
    row, column = F.coalesce("_rows", F.lit(1)), F.coalesce("_columns", F.lit(1))
    left_hash = F.xxhash64(*(left_spread_by or left.columns))
    unmatched = F.pmod(left_hash, F.lit(1024)).cast("int")
    own_row = F.pmod(left_hash, row).cast("int")
    own_column = F.pmod(F.xxhash64(spread_by), column).cast("int")
    lefts = (
        left.join(grid, key, "left")
        .withColumn("_row", F.when(F.col(key).isNull(), unmatched).otherwise(own_row))
        .withColumn("_column", F.explode(F.sequence(F.lit(0), column - 1)))
        .withColumn("_cut", column > 1)
        .drop("_rows", "_columns")
    )
    rights = (
        right.join(grid, key, "left")
        .withColumn("_column", own_column)
        .withColumn("_row", F.explode(F.sequence(F.lit(0), row - 1)))
        .withColumn("_matched", F.lit(True))
        .drop("_rows", "_columns")
    )
    joined = lefts.join(rights, [key, "_row", "_column"], how)
    # A key has several columns only where the right side's sketch met it, so its left rows match in another cell.
    return joined.filter(~F.col("_cut") | F.col("_matched")).select(*_joined_columns(left, right, key))


def _grid(left: DataFrame, right: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """Rows and columns of the grid of each key that needs more than one cell."""
    both = (
        left.filter(F.col(key).isNotNull())
        .withColumnRenamed("_rows", "_l")
        .join(right.filter(F.col(key).isNotNull()).withColumnRenamed("_rows", "_r"), key, "full")
        .select(key, F.coalesce("_l", F.lit(1)).cast("double").alias("_l"), F.coalesce("_r", F.lit(1)).cast("double").alias("_r"))
    )
    cells = F.ceil(F.col("_l") * F.col("_r") / rows_per_task)
    evenly = F.ceil(F.sqrt(cells * F.col("_l") / F.col("_r")))
    rows = F.greatest(F.ceil(F.col("_l") / rows_per_task), F.least(cells, F.col("_l").cast("bigint"), evenly))
    sized = both.withColumn("_rows", rows.cast("int"))
    columns = F.greatest(F.ceil(F.col("_r") / rows_per_task), F.ceil(cells / F.col("_rows")))
    sized = sized.withColumn("_columns", columns.cast("int"))
    return sized.filter((F.col("_rows") > 1) | (F.col("_columns") > 1)).select(key, "_rows", "_columns")


def join_one(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    sizes: DataFrame | None = None,
    how: str = "left",
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """Join (left or inner) of many rows to a table with few rows per key.

    Adaptive execution cannot split a join whose other side is already partitioned by the key,
    as deduplicated tables are. So the left rows of a hot key are spread over parts and the
    right rows of that key repeated once per part. `sizes` is a stored table with the key and
    no fewer rows per key than the left one, where that one would have to be computed first or has lost its sketch.
    """
    hot = hot_keys(left if sizes is None else sizes, key, rows_per_task)
    columns = _joined_columns(left, right, key)
    # Rows without the column that spreads them are spread by all they have.
    spread_hash = F.xxhash64(*([spread_by] if spread_by in left.columns else left.columns))
    by_hash = F.pmod(spread_hash, F.coalesce("_parts", F.lit(1))).cast("int")
    unmatched = F.pmod(spread_hash, F.lit(1024)).cast("int")
    spread = left.join(hot, key, "left").withColumn(
        "_part", F.when(F.col(key).isNull(), unmatched).otherwise(by_hash)
    )
    all_parts = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    repeated = right.join(hot, key, "left").withColumn("_part", F.explode(all_parts))
    return spread.drop("_parts").join(repeated.drop("_parts"), [key, "_part"], how).select(*columns)


def _joined_columns(left: DataFrame, right: DataFrame, key: str) -> list[str]:
    return [key, *[c for c in left.columns + right.columns if c != key]]


def next_row(
    df: DataFrame,
    key: str,
    order_by: list[str],
    values: dict[str, str],
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """Values of the following row of the same key; `values` maps new names to columns.

    `order_by` starts with a zone-less timestamp and identifies a row. Rows of a hot key are cut
    at calendar minutes; the last row of a minute gets the first row of the key's next minute.
    """
    following = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    hot = hot_keys(df, key, rows_per_task)
    minute = minute_number(F.col(order_by[0]))
    tagged = df.join(hot, key, "left").withColumn("_cell", F.when(F.col("_parts").isNotNull(), minute))
    in_cell = Window.partitionBy(key, "_cell").orderBy(*order_by)
    first = F.min(F.struct(*order_by, following.alias("_row")))
    firsts = tagged.filter("_cell IS NOT NULL").groupBy(key, "_cell").agg(first.alias("_first"))
    by_cell = Window.partitionBy(key).orderBy("_cell")
    bridges = firsts.select(key, "_cell", F.lead("_first._row").over(by_cell).alias("_bridge"))
    rows = (
        tagged.withColumn("_next", F.lead(following).over(in_cell))
        .join(bridges, [key, "_cell"], "left")
        .withColumn("_next", F.coalesce("_next", "_bridge"))
    )
    return rows.select(*df.columns, *[F.col(f"_next.{n}").alias(n) for n in values])


def group_mean(df: DataFrame, key: str, mean: Column, name: str) -> DataFrame:
    """Mean per key on every row, by aggregation and join, so a hot key never fills one task.

    The means are stored first. Their true size is then known, so Spark broadcasts them when
    they are below its limit and otherwise joins by shuffle, splitting hot keys of the kept side.
    """
    means = df.filter(F.col(key).isNotNull()).groupBy(key).agg(mean.alias(name))
    return df.join(stored(means, "means"), key, "left").select(*df.columns, name)
