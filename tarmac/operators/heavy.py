"""The keys that hold many rows of a table, from a sketch of fixed size.

The sketch (frequent items, mergeable) is taken by the tasks that write a table and kept beside the table's files; a
table that was written without one is sketched in a pass over its key column, in which only sketches are
shuffled. No row travels by its key and no number of different keys matters.

A sketch tracks at most `TRACKED` keys of a column. It finds every key that holds more than about 1/1000 of the
rows, and may find more; with up to 3/4 of `TRACKED` different keys its counts are exact. A key that is missed is not
split: that costs time in joins, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarmac.session import CODEC, fresh_folder, stored

TRACKED = 4096
#: Sketches of tasks are merged in so many groups before the last one merges these.
MERGE_GROUPS = 64


def _top(key: str) -> str:
    return f"approx_top_k(`{key}`, {TRACKED}, {TRACKED})"


def write_with_sketches(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write a table, and beside it one table per key with its frequent values and their rows."""
    seen = Observation()
    _observed(df, seen, keys).write.parquet(path, compression=CODEC)
    _write_sketches(df, seen, path, keys)


def _observed(df: DataFrame, seen: Observation, keys: list[str]) -> DataFrame:
    return df.observe(seen, *[F.expr(_top(k)).alias(k) for k in keys])


def _write_sketches(df: DataFrame, seen: Observation, path: str, keys: list[str]) -> None:
    kinds = dict(df.dtypes)
    for key in keys:
        found = [(row["item"], row["count"]) for row in seen.get[key]]
        beside = df.sparkSession.createDataFrame(found, f"`{key}` {kinds[key]}, _rows bigint")
        beside.coalesce(1).write.parquet(sketch_path(path, key))


def sketch_path(path: str, key: str) -> str:
    return f"{path}-heavy-{key}"


def stored_with_sketches(df: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """`session.stored` that keeps the sketches of key columns. Only the table returned knows them, not what is made of it."""
    path = fresh_folder(df.sparkSession, purpose)
    write_with_sketches(df, path, keys)
    return read_with_sketches(df.sparkSession.read.parquet(path), path, keys)


def sketched(df: DataFrame, made_from: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """The table as it is, not stored, knowing sketches of its key columns: for tables that are used once.

    The sketches are taken in one pass over the keys of `made_from`, in which nothing is shuffled. That table must have each
    value of a key at least as often as `df`, and none that `df` lacks, as rows have before copies are dropped.
    """
    path, seen = fresh_folder(df.sparkSession, purpose), Observation()
    rows = made_from.select(*keys)
    _observed(rows, seen, keys).write.format("noop").mode("overwrite").save()
    _write_sketches(rows, seen, path, keys)
    # A table of its own: others that hold `df` must not take it for a stored one.
    return read_with_sketches(df.select(*df.columns), path, keys)


def read_with_sketches(table: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """The table read from `path`, knowing the sketches beside it."""
    table.heavy_keys_at = {key: sketch_path(path, key) for key in keys}
    return table


def narrowed(table: DataFrame, *columns: str) -> DataFrame:
    """Some columns of a stored table, by name; rows stay what they are, so it still knows their sketches."""
    out = table.select(*columns)
    out.heavy_keys_at = {k: v for k, v in getattr(table, "heavy_keys_at", {}).items() if k in columns}
    return out


def frequent(df: DataFrame, key: str) -> DataFrame:
    """Frequent values of a key with their number of rows, `_rows`; null is none of them. At most `TRACKED` rows, in files,
    so Spark knows how small it is."""
    kept = getattr(df, "heavy_keys_at", {}).get(key)
    if kept is not None:
        return df.sparkSession.read.parquet(kept)
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    values = df.filter(F.col(key).isNotNull()).select(key, group.alias("_group"))
    sketch = F.expr(f"approx_top_k_accumulate(`{key}`, {TRACKED})").alias("sketch")
    # The sketch of no rows is there for empty tables.
    sketches = values.groupBy("_group").agg(sketch).select("sketch").union(values.filter(F.lit(False)).agg(sketch))
    merged = sketches.agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    items = merged.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {TRACKED})")))
    return stored(items.select(F.col("item").alias(key), F.col("count").cast("bigint").alias("_rows")), "heavy")
