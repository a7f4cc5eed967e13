"""Distinct counts that add up: exact bitmaps of flights and customers, stored once for every report column.

`count(DISTINCT ...)` shuffles ids anew for each report, and two of them in one report double every row. Here ids get dense
numbers once, and for each value of each report column a set of bitmaps says which numbers occur under it (32,768 numbers a
bitmap). Counts of one value, of several values together or of everything merge bitmaps and read no line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.numeric import divide_or_zero
from tarmac.operators.skew import join_one
from tarmac.plans import report
from tarmac.session import stored

#: Groups of ids that are numbered side by side. A group is sorted in one task; the window over group sizes has so many rows.
ID_GROUPS = 4096
#: Distinct counts by name and the ids that they count.
COUNTED = {"total_flights": "flight_id", "unique_passengers": "passenger_id"}
#: The row of all lines together.
EVERYTHING = "everything"


def numbered(df: DataFrame, key: str, groups: int = ID_GROUPS) -> DataFrame:
    """The different values of a key, numbered from 1 without gaps, stored. Null has no number. The same values always get the same numbers."""
    ids = df.filter(F.col(key).isNotNull()).select(key).distinct()
    ids = stored(ids.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups))), "ids")
    sizes = ids.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_group", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_group").orderBy(key))
    placed = ids.withColumn("_place", place).join(stored(starts, "starts"), "_group")
    return stored(placed.select(key, (F.col("_start") + F.col("_place")).alias("_number")), "numbers")


def member_sets(
    bookings: DataFrame,
    flights: DataFrame,
    payments: DataFrame,
    passengers: DataFrame,
    by: list[str],
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """Bitmaps by report column, its value in report spelling, and what is counted; stored. `bookings` are stored facts.

    Lines without an id are in no bitmap; a value that has only such lines has none.
    """
    lines = report.report_lines(bookings, flights, payments, passengers, set(by), rows_per_task)
    lines = lines.select(*COUNTED.values(), *[report._label(c).alias(f"_{c}") for c in by])
    for key in COUNTED.values():
        numbers = numbered(bookings, key).withColumnRenamed("_number", f"_number_{key}")
        lines = join_one(lines, numbers, key, "", bookings, rows_per_task=rows_per_task)
    lines = stored(lines.select(*[f"_number_{k}" for k in COUNTED.values()], *[f"_{c}" for c in by]), "numbered-lines")
    return stored(reduce(DataFrame.unionAll, [_sets(lines, c, name) for c in by for name in COUNTED]), "member-sets")


def _sets(lines: DataFrame, column: str, name: str) -> DataFrame:
    number = F.col(f"_number_{COUNTED[name]}")
    known = lines.filter(number.isNotNull())
    return (
        known.groupBy(F.col(f"_{column}").alias("value"), F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("members"))
        .select(F.lit(column).alias("by"), "value", F.lit(name).alias("counted"), "bucket", "members")
    )


def distinct_counts(sets: DataFrame, by: str | None = None, values: list[str] | None = None) -> DataFrame:
    """Distinct counts for each value of a report column, or without one for everything in one row; of some values
    only, where they are named. Everything is read from the first column's bitmaps, as each line is in one of its values."""
    if by is None:
        source = sets.select(F.min("by")).scalar()
        chosen, keys = sets.filter(F.col("by") == source), []
    else:
        chosen, keys = sets.filter(F.col("by") == by), ["value"]
    if values is not None:
        chosen = chosen.filter(F.col("value").isin(values))
    merged = chosen.groupBy(*keys, "counted", "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    counts = merged.select(*keys, "counted", F.bitmap_count("members").alias("n"))
    return counts.groupBy(*keys).agg(*[_total(name).alias(name) for name in COUNTED])


def _total(name: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("counted") == name, F.col("n"))), F.lit(0))


def measures(
    sets: DataFrame,
    bookings: DataFrame,
    flights: DataFrame,
    payments: DataFrame,
    passengers: DataFrame,
    names: list[str],
    by: str,
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """`report.measures` per value of a column, with its distinct counts from the stored bitmaps."""
    spend = "spend_per_passenger"
    added = [n for n in names if n not in COUNTED and n != spend]
    if spend in names and "total_revenue" not in added:
        added.append("total_revenue")
    # Lines are counted in any case, for values without a flight or customer.
    asked = list(dict.fromkeys([*added, "total_bookings"]))
    sums = report.measures(bookings, flights, payments, passengers, asked, by, rows_per_task)
    both = sums.join(distinct_counts(sets, by).withColumnRenamed("value", by), by, "left").fillna(0, list(COUNTED))
    if spend in names:
        both = both.withColumn(spend, divide_or_zero(F.col("total_revenue"), F.col("unique_passengers")))
    return both.select(by, *names).orderBy(by)
