"""Sketches of frequent keys, and the facts that take the place of payments."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac.operators import heavy, joins, skew
from tarmac.plans import facts, kpis, refresh, report
from tarmac.roles import Roles


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(2)
    keys = ["hot"] * 3000 + ["warm"] * 900 + [f"k{i}" for i in range(2000)] + [None] * 50
    random.shuffle(keys)
    return spark.createDataFrame(list(enumerate(keys)), "id int, k string").repartition(7)


def test_sketch_of_a_pass_and_of_a_write_agree(spark, skewed):
    wanted = [("hot", 3), ("warm", 1)]
    assert rows(skew.hot_keys(skewed, "k", 1000)) == wanted[:1]
    kept = heavy.stored_with_sketches(skewed, "skewed", ["k", "id"])
    assert rows(kept) == rows(skewed)
    assert rows(skew.hot_keys(kept, "k", 800)) == [("hot", 4), ("warm", 2)]
    assert heavy.frequent(kept, "id").count() <= heavy.TRACKED


def test_few_keys_are_counted_exactly(spark):
    values = [random.randint(1, 200) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "k bigint").repartition(5)
    assert dict(heavy.frequent(df, "k").collect()) == Counter(values)


def test_more_keys_than_tracked_still_find_the_heavy_one(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    kept = heavy.stored_with_sketches(df, "many", ["k"])
    for table in (df, kept):
        found = dict(heavy.frequent(table, "k").collect())
        assert found[-1] == pytest.approx(20_000, rel=0.05)
        assert len(found) <= heavy.TRACKED


def test_empty_tables_have_no_heavy_keys(spark, skewed):
    none = skewed.limit(0)
    assert rows(heavy.frequent(none, "k")) == []
    assert rows(heavy.frequent(heavy.stored_with_sketches(none, "none", ["k"]), "k")) == []


def test_some_columns_keep_the_sketch(spark, skewed):
    kept = heavy.stored_with_sketches(skewed, "skewed", ["k", "id"])
    some = heavy.narrowed(kept, "k")
    assert set(some.heavy_keys_at) == {"k"}
    assert heavy.narrowed(skewed, "k").heavy_keys_at == {}


def test_joins_count_no_keys(spark, folder):
    """No join of bookings groups the rows of a table by their key to find frequent ones."""
    r = Roles(spark, folder)
    wide = joins.master(r.stored_bookings, r.flights, r.stored_payments, r.passengers_masked)
    assert "_rows" not in plan(wide).split("Relation")[0]
    for node in plan(wide).splitlines():
        assert not ("Aggregate" in node and "count" in node), node


@pytest.mark.parametrize("how", ["left", "inner"])
def test_names_without_cause_lose_no_rows(spark, how, tmp_path):
    """A sketch may name keys that the joined rows don't have."""
    left = spark.createDataFrame([("a", 1), ("b", 2), ("zz", 3)], "k string, id int")
    right = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, r string")
    sizes = spark.createDataFrame([("a",)] * 50 + [("b",)] * 40 + [("zz",)] * 60 + [("none",)] * 90, "k string")
    got = skew.join_one(left, right, "k", "id", sizes, how, rows_per_task=3)
    assert rows(got) == rows(left.join(right, "k", how))


def paid_twice(spark, repeated):
    random.seed(6)
    bookings = [(f"b{i}", f"p{i % 9}", f"f{i % 4}", "CONFIRMED") for i in range(30)]
    if repeated:
        bookings += [("b1", f"p{i}", "f1", "PENDING") for i in range(40)]
    payments = [(f"x{i}", f"b{random.choice([1, 1, 2, 3, 40])}", i / 4, random.choice(["UPI", "CARD", None])) for i in range(80)]
    return (
        spark.createDataFrame(bookings, "booking_id string, passenger_id string, flight_id string, status string"),
        spark.createDataFrame(payments, "payment_id string, booking_id string, amount double, payment_method string"),
    )


@pytest.mark.parametrize("repeated", [False, True])
def test_facts_stand_for_bookings_and_payments(spark, repeated):
    bookings, payments = paid_twice(spark, repeated)
    counted = facts.payment_facts(payments)
    for source in (payments, counted):
        made = facts.booking_facts(bookings, source, unique=not repeated, rows_per_task=3)
        keep = ["passenger_id", "flight_id", "status"]
        columns = ["booking_id", *keep, "paid_rows", "paid", "line_rows"]
        lines = facts.booking_lines(bookings, payments, keep)
        assert rows(made.select(*columns)) == rows(lines.select(*columns))
        by_method = ("payment_method",)
        assert rows(facts.booking_lines(made, source, keep, by_method)) == rows(
            facts.booking_lines(bookings, payments, keep, by_method)
        )


def test_reports_of_facts_join_nothing_by_booking(spark, folder):
    r = Roles(spark, folder)
    reports = {
        "revenue": kpis.revenue_by_airline(r.facts, r.payments, r.timed),
        "demographics": kpis.passenger_demographics(r.passengers, r.facts, r.payments),
        "flyers": kpis.frequent_flyers(r.passengers_masked, r.facts, r.payments),
        "carriers": kpis.airline_passenger_demographics(r.facts, r.timed, r.payments, r.passengers),
        "measures": report.measures(r.facts, r.timed, r.payments, r.passengers, ["total_revenue"], "airline"),
    }
    for name, df in reports.items():
        df.collect()
        executed = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(booking_id" not in executed, name
        assert "l_extendedprice" not in executed, name


def test_a_run_shuffles_payments_once(spark, folder, monkeypatch):
    r = Roles(spark, folder)
    shuffled = []
    real = facts.payment_facts
    monkeypatch.setattr(facts, "payment_facts", lambda p: shuffled.append(1) or real(p))
    tables = {
        "cleaned_flights": r.timed,
        "cleaned_bookings_masked": r.bookings_masked,
        "cleaned_passengers_masked": r.passengers_masked,
        "cleaned_payments": r.stored_payments,
    }
    out = refresh.kpi_tables(tables)
    assert shuffled == [1]
    for name, df in out.items():
        if name != "kpi_payment_methods":
            assert "/payments-" not in physical(df), name
            files = df.inputFiles()
            assert not any("/payments-" in f for f in files), name
