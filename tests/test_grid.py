"""Joins of keys that are frequent on both sides."""

import random

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac.operators import heavy, joins, skew
from tarmac.plans import facts

HOT = 1000


@pytest.fixture(scope="module")
def both_hot(spark):
    random.seed(4)
    left = [("hot", i) for i in range(HOT)] + [("left", i) for i in range(HOT, 1400)]
    left += [(f"k{i % 40}", 2000 + i) for i in range(90)] + [(None, 3000 + i) for i in range(60)] + [("alone", 4000)]
    right = [("hot", f"r{i}") for i in range(HOT)] + [("right", f"s{i}") for i in range(300)]
    right += [("left", "one")] + [(f"k{i}", f"t{i}") for i in range(20, 60)] + [(None, "n")]
    random.shuffle(left)
    random.shuffle(right)
    return (
        heavy.stored_with_sketches(spark.createDataFrame(left, "k string, a int").repartition(4), "left", ["k"]),
        heavy.stored_with_sketches(spark.createDataFrame(right, "k string, b string").repartition(3), "right", ["k"]),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows_per_task", [40, 20_000, 10**7])
def test_same_rows_as_a_plain_join(both_hot, how, rows_per_task):
    left, right = both_hot
    got = skew.join_many_to_many(left, right, "k", "b", left, how, rows_per_task)
    wanted = left.join(right, "k", how)
    assert got.columns == wanted.columns
    assert got.count() == wanted.count()
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_cells_are_small_and_each_side_is_repeated_along_one_axis(both_hot):
    left, right = both_hot
    limit = 20_000
    sizes = [heavy.frequent(t, "k") for t in both_hot]
    grid = {r["k"]: (r["_rows"], r["_columns"]) for r in skew._grid(*sizes, "k", limit).collect()}
    assert set(grid) == {"hot"}
    high, wide = grid["hot"]
    assert HOT * HOT / (high * wide) <= limit
    assert (high, wide) == (8, 7)
    narrow = {r["k"]: (r["_rows"], r["_columns"]) for r in skew._grid(*sizes, "k", 250).collect()}
    assert narrow["left"] == (2, 1) and narrow["right"] == (1, 2)
    assert HOT / narrow["hot"][0] <= 250 and HOT / narrow["hot"][1] <= 250


def test_no_cell_holds_more_than_its_share(spark, both_hot):
    """Rows given per cell: the parts that the join is computed by."""
    left, right = both_hot
    limit = 20_000
    joined = skew.join_many_to_many(left, right, "k", "b", left, "inner", limit)
    grid = skew._grid(heavy.frequent(left, "k"), heavy.frequent(right, "k"), "k", limit)
    cell = [F.pmod(F.xxhash64("k", "a"), F.coalesce("_rows", F.lit(1))), F.pmod(F.xxhash64("b"), F.coalesce("_columns", F.lit(1)))]
    largest = joined.join(grid, "k", "left").groupBy("k", *cell).count().agg(F.max("count")).first()[0]
    assert largest < 1.6 * limit


def test_empty_sides(both_hot):
    left, right = both_hot
    none_left, none_right = left.limit(0), right.limit(0)
    assert rows(skew.join_many_to_many(none_left, right, "k", "b", none_left)) == []
    kept = skew.join_many_to_many(left, none_right, "k", "b", left, rows_per_task=5)
    assert rows(kept.select("k", "a")) == rows(left) and kept.filter("b IS NOT NULL").isEmpty()


def test_repeated_rows_stay(spark):
    left = spark.createDataFrame([("x", 1)] * 30, "k string, a int")
    right = spark.createDataFrame([("x", "r")] * 20, "k string, b string")
    got = skew.join_many_to_many(left, right, "k", "b", left, rows_per_task=3)
    assert got.count() == 600


def repeated(spark):
    bookings = [("b1", f"p{i}", f"f{i % 3}", "CONFIRMED") for i in range(50)] + [("b2", "p1", "f1", "PENDING"), (None, "p2", "f2", "X")]
    payments = [(f"x{i}", "b1", i / 4, random.choice(["UPI", "CARD"])) for i in range(70)] + [("y", "b9", 1.0, "UPI")]
    return (
        spark.createDataFrame(bookings, "booking_id string, passenger_id string, flight_id string, status string"),
        spark.createDataFrame(payments, "payment_id string, booking_id string, amount double, payment_method string"),
    )


def test_payments_of_repeated_bookings(spark):
    bookings, payments = repeated(spark)
    kept = heavy.stored_with_sketches(bookings, "repeated", ["booking_id"])
    got = joins.with_payments(kept, payments, 6, kept)
    assert rows(got) == rows(bookings.join(payments, "booking_id", "left"))


def test_lines_by_method_of_repeated_bookings(spark):
    bookings, payments = repeated(spark)
    kept = heavy.stored_with_sketches(bookings, "repeated", ["booking_id"])
    keep, also = ["passenger_id"], ("payment_method",)
    wanted = facts.booking_lines(bookings, payments, keep, also)
    assert rows(facts.booking_lines(kept, payments, keep, also, 6)) == rows(wanted.select(*facts.booking_lines(kept, payments, keep, also).columns))
