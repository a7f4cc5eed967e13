"""Operators on small tables, against brute force where that is possible."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tables import rows
from tarmac.functions.numeric import exact_mean
from tarmac.operators import aggregates, dedup, filters, joins, skew
from tarmac.roles import Roles


@pytest.fixture(scope="module")
def events(spark, folder):
    return Roles(spark, folder).table("events").select("event_id", "user_id", "ts", "event_type")


@pytest.mark.parametrize("limit", [1, 20, 60, 10**9])
def test_next_row_of_hot_keys(events, limit):
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    wanted = events.withColumns({"n_type": F.lead("event_type").over(order), "n_ts": F.lead("ts").over(order)})
    got = skew.next_row(events, "user_id", ["ts", "event_id"], {"n_type": "event_type", "n_ts": "ts"}, limit)
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


def test_next_row_with_everything_in_one_minute(spark):
    data = [(1, i % 3, "2024-01-01 00:00:0%d" % (i % 10), f"e{i}") for i in range(60)]
    df = spark.createDataFrame(
        [(i, u, t, e) for i, (_, u, t, e) in enumerate(data)], "event_id int, user_id int, t string, e string"
    ).withColumn("ts", F.col("t").cast("timestamp_ntz"))
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    wanted = df.withColumn("n", F.lead("e").over(order))
    assert rows(skew.next_row(df, "user_id", ["ts", "event_id"], {"n": "e"}, 5)) == rows(wanted)


@pytest.mark.parametrize("limit", [1, 3, 10**9])
def test_left_join_with_hot_keys(spark, limit):
    random.seed(3)
    left = [(k, f"l{i}") for i, k in enumerate(["hot", "a", "b", None, "none", "hot"])]
    right = [("hot", i) for i in range(40)] + [("a", 100), ("a", 101), ("b", 200), (None, 300), ("extra", 400)]
    random.shuffle(right)
    a = spark.createDataFrame(left, "k string, l string")
    b = spark.createDataFrame(right, "k string, id int").repartition(4)
    wanted = a.join(b, "k", "left")
    got = skew.left_join_many(a, b, "k", "id", limit)
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


def test_hot_rows_are_spread(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id"))
    assert rows(skew.hot_keys(df, "k", 100)) == [("hot", 10)]
    assert rows(skew.hot_keys(df, "k", 1000)) == []


def test_group_mean_is_joined_not_windowed(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), (None, 9.0)], "k string, v double")
    got = skew.group_mean(df, "k", exact_mean(F.col("v")), "m")
    assert rows(got) == [("a", 1.0, 1.5), ("a", 2.0, 1.5), ("b", 5.0, 5.0), (None, 9.0, None)]


@pytest.mark.parametrize("partitions", [1, 8])
def test_first_by_key_does_not_depend_on_partitions(spark, partitions):
    data = [(f"k{i % 7}", i * 37 % 100, i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(partitions)
    wanted = {k: min((o, v) for kk, o, v in data if kk == k) for k, _, _ in data}
    assert rows(dedup.first_by_key(df, "k", ["o", "v"])) == sorted((k, *ov) for k, ov in wanted.items())
    assert rows(dedup.first_by_key(df, "k")) == sorted((k, *ov) for k, ov in wanted.items())


def test_null_amount_goes_before_the_first_row(spark):
    df = spark.createDataFrame([("p", 1, None), ("p", 2, 5.0), ("q", 1, 7.0)], "id string, o int, amount double")
    assert rows(dedup.valid_then_first(df, "id", ["amount"], ["o"])) == [("p", 2, 5.0), ("q", 1, 7.0)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, None)], "a int, b int")
    assert rows(dedup.count_duplicate_rows(df)) == [(2,)]
    assert rows(dedup.count_duplicate_rows(df.limit(0))) == [(0,)]
    assert rows(dedup.distinct_rows(df)) == [(1, 2), (1, None)]
    assert rows(dedup.valid_distinct(df, ["b"])) == [(1, 2)]


def test_filters(spark):
    df = spark.createDataFrame(
        [("A", 5, " x "), ("B", 6, None), (None, 7, "")], "c string, n int, t string"
    )
    assert rows(filters.not_in(df, "c", ["A"])) == [("B", 6, None)]
    assert rows(filters.slice_by(df, {"n": (6, 7)}).select("n")) == [(6,), (7,)]
    assert rows(filters.slice_by(df, {"c": ["A", "B"], "n": 6}).select("n")) == [(6,)]
    assert rows(filters.fill_strings(df)) == [("A", 5, "x"), ("B", 6, "Unknown"), ("Unknown", 7, "")]
    assert filters.project_present(df, ["t", "zz", "c"]).columns == ["t", "c"]
    assert rows(filters.fill_constants(df, {"c": "-", "t": "?"}).select("c", "t")) == [("-", ""), ("A", " x "), ("B", "?")]
    assert rows(filters.head(df, ["n"], 1).select("n")) == [(5,)]


def test_passenger_columns_that_clash_get_a_suffix(spark):
    lines = spark.createDataFrame([("p", 1)], "passenger_id string, age int")
    people = spark.createDataFrame([("p", 2, "F", "secret")], "passenger_id string, age int, gender string, email string")
    got = joins.with_passenger(lines, people)
    assert got.columns == ["passenger_id", "age", "age_pax", "gender"]
    assert rows(got) == [("p", 1, 2, "F")]


def test_value_counts_and_shares(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    counts = aggregates.value_counts(df, "c", "n")
    assert [tuple(r) for r in counts.collect()] == [("a", 2), ("b", 1)]
    assert rows(aggregates.share_of_total(counts, "n", "pct")) == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert aggregates.value_counts_json(df, "c", ["a", "b"]).first()[0] == '{"a":2,"b":1}'
    assert aggregates.value_counts_json(df, "c", ["a"]).first()[0] == '{"a":2,"other":1}'


def test_fixed_categories(spark):
    df = spark.createDataFrame([("a",), ("z",), ("a",)], "c string")
    ordered = aggregates.counts_in_order(df, "c", ["b", "a"])
    assert [tuple(r) for r in ordered.collect()] == [(0, "b", 0), (1, "a", 2)]
    with_null = aggregates.counts_in_order(df, "c", ["b", "a"], zero_fill=False)
    assert [tuple(r) for r in with_null.collect()] == [(0, "b", None), (1, "a", 2)]


def test_histogram_matches_numpy(spark):
    import numpy as np

    random.seed(1)
    values = [round(random.uniform(0, 1440), 2) for _ in range(500)] + [0.0, 1440.0, 36.0, 72.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = np.histogram(values, bins=40)[0].tolist()
    assert [r["count"] for r in aggregates.histogram(df, "v").collect()] == wanted


def test_median_and_mean(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (10.0,), (None,)], "v double")
    assert rows(aggregates.median_and_mean(df, "v")) == [(2.5, 4.0)]


@pytest.mark.parametrize("n", [0, 1, 2, 501, 1000])
def test_median_meets_in_no_single_task(spark, n):
    from statistics import median

    random.seed(n)
    values = [random.choice([round(random.uniform(-50, 50), 2), 7.25]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(3)
    out = aggregates.median_and_mean(df, "v")
    assert "percentile" not in out._jdf.queryExecution().toString()
    got = out.collect()
    assert len(got) == 1
    assert got[0]["median"] == (pytest.approx(median(values)) if n else None)
    assert got[0]["mean"] == (pytest.approx(sum(values) / n) if n else None)


def test_mean_keeps_all_decimals_and_nan_is_missing(spark):
    df = spark.createDataFrame([(0.001,), (0.002,), (0.006,), (float("nan"),)], "v double")
    assert aggregates.median_and_mean(df, "v").first() == pytest.approx((0.002, 0.003))
    one = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert rows(aggregates.median_and_mean(one, "v")) == [(1.0, 1.0)]
    wild = spark.createDataFrame([(1e-12,), (3e-12,), (1e30,)], "v double")
    assert rows(aggregates.median_and_mean(wild, "v")) == [(3e-12, pytest.approx(1e30 / 3))]
    whole = spark.createDataFrame([(2,), (3,)], "v bigint")
    assert rows(aggregates.median_and_mean(whole, "v")) == [(2.5, 2.5)]


def test_pivot(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "x")], "r string, c string")
    assert rows(aggregates.pivot_counts(df, "r", "c", ["x", "y"])) == [("a", 2, 0), ("b", 0, 1)]
    assert rows(aggregates.pair_counts(df, "r", "c")) == [("a", "x", 2), ("b", "y", 1)]


def test_pivot_keeps_row_sums(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "z"), ("a", "w"), ("b", "y"), ("c", "z"), ("c", None)], "r string, c string")
    got = aggregates.pivot_counts(df, "r", "c", ["x", "y"], other="other")
    assert got.columns == ["r", "x", "y", "other"]
    assert rows(got) == [("a", 1, 0, 2), ("b", 0, 1, 0), ("c", 0, 0, 1)]


def test_histogram_of_equal_values(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    got = [tuple(r) for r in aggregates.histogram(df, "v", 4).collect()]
    assert got == [(1, 0), (2, 0), (3, 2), (4, 0)]


@pytest.mark.parametrize("approximate", [False, True])
def test_profile(spark, approximate):
    df = spark.createDataFrame(
        [(1, None, 1.0), (2, "b", float("nan")), (3, "a", 1.0), (4, "a", None)], "id int, t string, d double"
    )
    assert rows(aggregates.profile(df, "id", approximate)) == [
        ("d", "double", 2, 50.0, 1, "1.0"),
        ("id", "int", 0, 0.0, 4, "1"),
        ("t", "string", 1, 25.0, 2, "b"),
    ]


def shuffled_bytes(df):
    """Bytes that the exchanges of a plan without adaptive execution have written."""
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        metric = node.metrics().get("shuffleBytesWritten")
        total += metric.get().value() if metric.isDefined() else 0
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_profile_shuffles_no_text(spark, folder):
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    text = df.select("l_orderkey", F.concat(F.lit("long text " * 20), F.sha2(F.col("l_partkey").cast("string"), 256)).alias("t"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        profiled = aggregates.profile(text, "l_orderkey")
        found = rows(profiled)
        # What travels when each column's values are counted as text.
        as_text = text.selectExpr("l_orderkey", "cast(l_orderkey AS string) AS l_orderkey_text", "t").unpivot(
            "l_orderkey", ["l_orderkey_text", "t"], "column_name", "value"
        )
        counted = as_text.groupBy("column_name", "value").agg(F.count(F.lit(1)), F.min("l_orderkey"))
        counted.collect()
        assert 0 < shuffled_bytes(profiled) < shuffled_bytes(counted) / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r[4] for r in found] == [df.select("l_orderkey").distinct().count(), df.select("l_partkey").distinct().count()]


def test_profile_of_odd_columns(spark):
    schema = "id int, `a.b` string, `c ``d` double, n decimal(30,3), t timestamp_ntz, l array<int>, b boolean"
    df = spark.createDataFrame(
        [(2, "x", -0.0, None, None, [1], True), (1, None, 0.0, None, None, [1, 2], None), (1, "y" * 100_000, float("nan"), None, None, [1], False)],
        schema,
    )
    found = {r["column_name"]: (r["null_count"], r["unique_count"], r["sample"]) for r in aggregates.profile(df, "id").collect()}
    assert found["id"] == (0, 2, "1") and found["a.b"] == (1, 2, "y" * 100_000)
    assert found["c `d"] == (1, 1, "0.0") and found["n"] == found["t"] == (3, 0, "N/A")
    assert found["l"][:2] == (0, 2) and found["b"] == (1, 2, "false")
    empty = aggregates.profile(df.limit(0), "id").collect()
    assert [r["column_name"] for r in empty] == df.columns
    assert {(r["null_count"], r["null_pct"], r["unique_count"], r["sample"]) for r in empty} == {(0, None, 0, "N/A")}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [1, 5, 10**9])
def test_join_one_with_hot_keys(spark, how, limit):
    left = [("hot", i) for i in range(40)] + [("a", 100), (None, 200), (None, 201), ("none", 300), ("none", 301)]
    right = [("hot", "H"), ("a", "A"), ("b", "B"), (None, "N")]
    a = spark.createDataFrame(left, "k string, id int").repartition(4)
    b = spark.createDataFrame(right, "k string, r string")
    got = skew.join_one(a, b, "k", "id", how=how, rows_per_task=limit)
    wanted = a.join(b, "k", how)
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


def test_reports_with_every_key_split(spark, folder):
    from tarmac.plans import kpis, report

    r = Roles(spark, folder)
    tables = r.booking_keys, r.flights, r.payments, r.passengers
    names = list(report.MEASURES)
    split = report.measures(*tables, names, "airline", rows_per_task=2)
    assert rows(split) == rows(report.measures(*tables, names, "airline"))
    split = kpis.airline_passenger_demographics(*tables, rows_per_task=2)
    assert rows(split) == rows(kpis.airline_passenger_demographics(*tables))
