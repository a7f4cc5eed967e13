"""Counting, sharing, pivoting and profiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.numeric import percent, round2
from tarmac.session import stored


def value_counts(df: DataFrame, column: str, name: str = "count", weight: Column | None = None) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(n.alias(name))
        .orderBy(F.desc(name), column)
    )


def shares_of_total(counts: DataFrame, shares: dict[str, str]) -> DataFrame:
    """Percentages of the column totals; `shares` maps new names to columns.

    The grouped rows are stored, as the totals need them before the percentages do.
    """
    kinds = dict(counts.dtypes)
    kept = stored(counts, "counts")
    out = kept
    for name, column in shares.items():
        part = F.col(column)
        summed = part.cast("decimal(38,2)") if kinds[column] == "double" else part
        out = out.withColumn(name, round2(percent(part, kept.agg(F.sum(summed)).scalar())))
    return out


def share_of_total(counts: DataFrame, column: str, name: str) -> DataFrame:
    """Each count as a percentage of all."""
    return shares_of_total(counts, {name: column})


def value_counts_json(df: DataFrame, column: str, categories: list[str], other: str = "other") -> DataFrame:
    """Counts of the named values as one JSON object with sorted keys; all other values, if there are any, are
    counted under `other`. For values that are not known beforehand, `value_counts` gives rows."""
    value = F.col(column)
    key = F.when(value.isNull() | value.isin(categories), value).otherwise(F.lit(other)).alias(column)
    counts = value_counts(df.select(key), column, "n")
    entries = F.sort_array(F.collect_list(F.struct(F.col(column).alias("k"), F.col("n").alias("v"))))
    return counts.agg(F.to_json(F.map_from_entries(entries)).alias("counts"))


def counts_in_order(df: DataFrame, column: str, categories: list[str], zero_fill: bool = True) -> DataFrame:
    """Counts for a fixed list of categories, in that order; other values are left out."""
    spark = df.sparkSession
    listed = spark.createDataFrame(
        [(i, c) for i, c in enumerate(categories)], f"position int, {column} string"
    )
    counts = (
        df.filter(F.col(column).isin(categories))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    count = F.coalesce("count", F.lit(0)) if zero_fill else F.col("count")
    return (
        listed.join(counts, column, "left")
        .select("position", column, count.alias("count"))
        .orderBy("position")
    )


def median_and_mean(df: DataFrame, column: str) -> DataFrame:
    """Exact median and mean, for any number of different values. NaN counts as missing.

    The mean adds decimals with the digits that the values are written with, so it doesn't depend on the order of rows;
    where one needs more than eight decimals or 24 digits in all, doubles are added, value by value in order.
    Equal values are counted first. The counts are written in ranges of values; the totals of the ranges tell
    which one or two of them hold the middle ranks, and only these are gone through.
    """
    value = F.col(column)
    present = df.filter(value.isNotNull() & ~F.isnan(value.cast("double")))
    distinct = present.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranged = distinct.repartitionByRange(column).withColumn("range", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    digits = value.cast("string").try_cast("decimal(24,8)")
    exact = digits.cast("double") == value.cast("double")
    written = F.sum(digits * F.col("n").cast("decimal(13,0)")).cast("double")
    added = F.sum(value.cast("double") * F.col("n"))
    total = F.when(F.bool_and(F.coalesce(exact, F.lit(False))), written).otherwise(added)
    mean = ranged.agg(F.try_divide(total, F.sum("n").cast("double")).alias("mean"))
    # One row per partition of the shuffle.
    sizes = ranged.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect()
    rows = sum(r["n"] for r in sizes)
    ranks, before, middle = sorted({(rows - 1) // 2, rows // 2}), 0, []
    for r in sizes:
        own = [rank - before for rank in ranks if before <= rank < before + r["n"]]
        before += r["n"]
        if own:
            upto = F.sum("n").over(Window.partitionBy("range").orderBy(column))
            held = ranged.filter(F.col("range") == r["range"]).select(F.col(column), "n", upto.alias("upto"))
            for rank in own:
                is_it = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
                middle.append(held.filter(is_it).select(F.col(column).cast("double").alias("v")))
    if not middle:
        return mean.select(F.lit(None).cast("double").alias("median"), "mean")
    low, high = middle[0], middle[-1]
    median = low.select(F.col("v").alias("low")).crossJoin(high.select(F.col("v").alias("high")))
    half = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(0.5 * F.col("low") + 0.5 * F.col("high"))
    return median.select(half.alias("median")).crossJoin(mean)


def histogram(df: DataFrame, column: str, bins: int = C.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from the least to the greatest value; the last bin is closed."""
    spark = df.sparkSession
    distinct = stored(
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")), "values"
    )
    edges = distinct.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    low, high, x = edges.getField("low"), edges.getField("high"), F.col(column)
    # Equal values lie in the middle of bins that span one.
    low, high = F.when(high > low, low).otherwise(low - 0.5), F.when(high > low, high).otherwise(high + 0.5)
    placed = distinct.select(
        F.least(F.floor((x - low) / ((high - low) / bins)).cast("int") + 1, F.lit(bins)).alias("bin"), "n"
    )
    filled = placed.groupBy("bin").agg(F.sum("n").alias("n"))
    return (
        spark.range(1, bins + 1)
        .select(F.col("id").cast("int").alias("bin"))
        .join(filled, "bin", "left")
        .select("bin", F.coalesce("n", F.lit(0)).alias("count"))
        .orderBy("bin")
    )


def pivot_counts(df: DataFrame, rows: str, columns: str, values: list[str], other: str | None = None) -> DataFrame:
    """Counts of row value by named column value; absent pairs are zero.

    Other values are counted in the column `other`; without its name they are left out.
    """
    known = df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    if other is not None:
        if other in values:
            raise ValueError(f"{other} is one of the values")
        named = F.when(F.col(columns).isin(values), F.col(columns)).otherwise(F.lit(other))
        known, values = known.withColumn(columns, named), [*values, other]
    return known.groupBy(rows).pivot(columns, values).count().na.fill(0)


def pair_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """The same counts as rows, for any number of values."""
    known = df.filter(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    return known.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("count"))


def profile(df: DataFrame, order_by: str, approximate: bool = False) -> DataFrame:
    """Per column: type, missing values, different values and the first value that is present.

    Missing values and the sample come from one row of aggregates, so tasks send one text per column. For the number of
    different values, tasks send each one's number or a 128-bit hash of its text, never the text. Numbers up to
    eight bytes are told apart exactly (0.0 and -0.0 are one value). NaN is missing. Of rows that are equal in `order_by`
    the smallest text is the sample. `approximate` estimates the number of different values from one sketch per column.
    """
    columns = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    if not columns:
        raise ValueError("a table without columns has no profile")
    present = {
        name: F.when(~F.isnan(_quoted(name)), _quoted(name)) if kind in ("double", "float") else _quoted(name)
        for _, name, kind in columns
    }
    per_column = []
    for i, name, _ in columns:
        value, order = present[name], _quoted(order_by)
        first = F.min(F.when(value.isNotNull() & order.isNotNull(), F.struct(order.alias("at"), value.cast("string").alias("text"))))
        per_column += [F.count(value).alias(f"n{i}"), first.alias(f"first{i}")]
        if approximate:
            per_column.append(F.approx_count_distinct(value.cast("string")).alias(f"different{i}"))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *per_column)
    facts = [
        F.struct(
            F.lit(i).alias("_column"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("dtype"),
            (F.col("rows") - F.col(f"n{i}")).alias("null_count"),
            F.col("rows"),
            F.col(f"first{i}.text").alias("sample"),
            (F.col(f"different{i}") if approximate else F.lit(None).cast("bigint")).alias("_different"),
        )
        for i, name, kind in columns
    ]
    tall = wide.select(F.inline(F.array(*facts)))
    if not approximate:
        tall = tall.drop("_different").join(_different_values(df, columns, present), "_column", "left")
    return tall.select(
        "column_name",
        "dtype",
        "null_count",
        round2(percent(F.col("null_count"), F.col("rows"))).alias("null_pct"),
        F.coalesce("_different", F.lit(0)).alias("unique_count"),
        F.coalesce("sample", F.lit("N/A")).alias("sample"),
    )


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _different_values(df: DataFrame, columns: list[tuple[int, str, str]], present: dict[str, Column]) -> DataFrame:
    """Number of different values by column number."""
    whole = ("bigint", "int", "smallint", "tinyint")
    keys = []
    for i, name, kind in columns:
        value = present[name]
        if kind in whole:
            a, b = value.cast("bigint"), F.lit(0)
        elif kind in ("double", "float", "date", "timestamp", "timestamp_ntz", "boolean"):
            # A hash of up to eight bytes is a different one for each value.
            a, b = F.xxhash64(value), F.lit(0)
        else:
            a, b = F.xxhash64(value.cast("string")), F.xxhash64(F.lit(i), value.cast("string"))
        keys.append(F.struct(F.lit(i).alias("_column"), F.when(value.isNotNull(), a).alias("_a"), b.cast("bigint").alias("_b")))
    values = df.select(F.inline(F.array(*keys))).filter(F.col("_a").isNotNull())
    return values.distinct().groupBy("_column").agg(F.count(F.lit(1)).alias("_different"))
