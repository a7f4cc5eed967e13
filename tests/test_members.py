"""Distinct counts from stored bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac.operators.heavy import stored_with_sketches
from tarmac.plans import facts, members, report
from tarmac.roles import Roles


def test_numbers_are_dense_and_the_same_for_any_partitioning(spark):
    ids = [None, *[f"id{i % 500}" for i in range(1200)]]
    df = spark.createDataFrame([(i,) for i in ids], "k string")
    found = dict(members.numbered(df.repartition(5), "k", 7).collect())
    assert sorted(found.values()) == list(range(1, 501)) and None not in found
    assert dict(members.numbered(df.coalesce(1), "k", 7).collect()) == found
    assert members.numbered(df.limit(0), "k").count() == 0


@pytest.fixture(scope="module")
def world(spark):
    random.seed(9)
    airlines, groups = ["INDIGO", "AIR INDIA", None], ["18-30", "31-45", None]
    flights = [(f"AI{i}", random.choice(airlines)) for i in range(60)]
    people = [(f"p{i}", random.choice(groups)) for i in range(80)]
    # One flight holds a third of the bookings; some ids are missing or unknown to the other tables.
    booked = []
    for i in range(900):
        flight = "AI1" if i % 3 == 0 else random.choice([None, "gone", *[f[0] for f in flights]])
        booked.append((f"b{i}", random.choice([None, "nobody", *[p[0] for p in people]]), flight, "CONFIRMED"))
    bookings = spark.createDataFrame(booked, "booking_id string, passenger_id string, flight_id string, status string")
    payments = spark.createDataFrame([("x", "b3", 2.5, "UPI")], "payment_id string, booking_id string, amount double, payment_method string")
    paid = stored_with_sketches(facts.booking_facts(bookings, payments), "facts", ["passenger_id", "flight_id"])
    return (
        paid,
        spark.createDataFrame(flights, "flight_id string, airline string"),
        payments,
        spark.createDataFrame(people, "passenger_id string, age_group string"),
    )


@pytest.fixture(scope="module")
def sets(world):
    return members.member_sets(*world, ["airline", "age_group"], rows_per_task=50)


@pytest.mark.parametrize("by", ["airline", "age_group"])
def test_counts_by_column(world, sets, by):
    wanted = report.measures(*world, list(members.COUNTED), by)
    found = members.distinct_counts(sets, by).select(F.col("value").alias(by), *members.COUNTED)
    assert rows(found) == rows(wanted)
    names = ["unique_passengers", "total_bookings", "spend_per_passenger", "total_revenue"]
    assert rows(members.measures(sets, *world, names, by)) == rows(report.measures(*world, names, by))


def test_counts_of_everything_and_of_some_values(world, sets):
    assert rows(members.distinct_counts(sets)) == rows(report.measures(*world, list(members.COUNTED)))
    lines = report.report_lines(*world, {"age_group"}).filter("age_group IN ('18-30', '31-45')")
    wanted = lines.agg(F.countDistinct("flight_id"), F.countDistinct("passenger_id")).first()
    # Values that share flights and customers: merged, not added.
    some = members.distinct_counts(sets.filter("by = 'age_group'"), None, ["18-30", "31-45"]).first()
    assert tuple(some) == tuple(wanted)


def test_counts_read_no_line_and_expand_nothing(sets):
    counted = members.distinct_counts(sets, "airline")
    plan = counted._jdf.queryExecution().toString()
    assert "Expand" not in plan and "distinct" not in plan
    assert all("member-sets" in f for f in counted.inputFiles())


def test_lines_without_rows(world):
    paid, flights, payments, people = world
    none = stored_with_sketches(paid.limit(0), "none", ["passenger_id", "flight_id"])
    sets = members.member_sets(none, flights, payments, people, ["airline"])
    assert rows(members.distinct_counts(sets, "airline")) == []
    assert rows(members.distinct_counts(sets)) == [(0, 0)]


def test_measures_of_the_tables_expand_nothing(spark, folder):
    r = Roles(spark, folder)
    args = (r.facts, r.timed, r.payments, r.passengers)
    df = members.measures(members.member_sets(*args, ["airline"]), *args, ["total_flights", "unique_passengers"], "airline")
    assert "Expand" not in df._jdf.queryExecution().optimizedPlan().toString()
