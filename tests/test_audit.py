"""Audit steps and the clean tables read from the same pass."""

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac.plans import audit, clean
from tarmac.roles import Roles
from tarmac.sources.readers import FILE_ORDER

CLEANERS = {
    "flights": clean.flights_without_delay,
    "bookings": clean.bookings,
    "passengers": clean.passengers,
    "payments": clean.payments,
}


@pytest.mark.parametrize("variant", ["script", "notebook"])
@pytest.mark.parametrize("name", list(CLEANERS))
def test_clean_table_is_the_cleaners(spark, folder, variant, name):
    r = Roles(spark, folder, variant)
    raw, order = r.untidy[name], r.order_by.get(name)
    done = audit.AUDITS[name](raw, variant, order)
    wanted = CLEANERS[name](raw, variant, order)
    assert done.clean.columns == wanted.columns
    assert rows(done.clean) == rows(wanted)
    steps = done.steps.collect()
    assert [s.position for s in steps] == list(range(1, len(steps) + 1))
    assert steps[0].rows_in == raw.count()
    for one, two in zip(steps, steps[1:]):
        assert one.rows_in - one.dropped == two.rows_in
    assert steps[-1].rows_in - steps[-1].dropped == done.clean.count()
    assert all(s.dropped > 0 for s in steps), steps


FLIGHTS = [
    ("AI1", "Air India", "DEL", "BOM", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 2),
    ("AI1", "Air India", "AAA", "BBB", "2024-01-01 10:00:00", "2024-01-01 13:00:00", 1),
    ("AI1", "Air India", "DEL", "BOM", "2024-01-01 10:00:00", "2024-01-01 12:00:00", 3),
    ("6E2", "x", None, "DEL", "2024-01-02 08:00:00", "2024-01-02 10:30:00", 4),
    ("6E3", "x", "DEL", "BOM", "soon", "2024-01-02 10:30:00", 5),
    ("6E4", "x", "DEL", "BOM", "2024-01-02 08:00:00", "2024-01-02 07:30:00", 6),
    ("6E5", "nan", "DEL", "BOM", "2024-01-02 08:00:00", "2024-01-02 10:30:00", 7),
    ("6E6", "x", "DEL", "BOM", "2024-01-02 08:00:00", "2024-01-09 10:30:00", 8),
    ("6E7", "x", "DEL", "BOM", "2024-01-02 08:00:00", "2024-01-02 10:30:00", 9),
]


def flights(spark):
    names = ["flight_id", "airline", "source", "destination", "departure_time", "arrival_time", "at"]
    return spark.createDataFrame(FLIGHTS, ", ".join(f"{n} {'int' if n == 'at' else 'string'}" for n in names))


def steps(done):
    return {s.step: s.dropped for s in done.steps.collect()}


def test_flight_steps_one_by_one(spark):
    done = audit.flights(flights(spark), order_by=["at"])
    assert steps(done) == {
        "null_times": 1, "duplicate_rows": 1, "duplicate_ids": 1, "invalid_interval": 1, "unresolved_carrier": 1,
        "duration_range": 1,
    }
    assert rows(done.clean.select("flight_id", "source")) == [("6E2", "NAN"), ("6E7", "DEL"), ("AI1", "AAA")]
    strict = audit.flights(flights(spark), order_by=["at"], strict=True)
    assert steps(strict)["null_text"] == 1
    assert rows(strict.clean.select("flight_id")) == [("6E7",), ("AI1",)]
    assert rows(strict.clean) == rows(clean.flights_without_delay(flights(spark), "script", ["at"], strict=True))


def test_the_order_given_decides(spark):
    last = flights(spark).withColumn("at", -F.col("at"))
    done = audit.flights(last, order_by=["at"])
    assert rows(done.clean.filter("flight_id = 'AI1'").select("source")) == [("DEL",)]
    placed = flights(spark).withColumnRenamed("at", FILE_ORDER)
    assert rows(audit.flights(placed, order_by=[FILE_ORDER]).clean.filter("flight_id = 'AI1'").select("source")) == [("AAA",)]


@pytest.mark.parametrize("name", list(CLEANERS))
def test_empty_tables(spark, folder, name):
    r = Roles(spark, folder)
    done = audit.AUDITS[name](r.raw[name].limit(0), order_by=r.order_by.get(name))
    assert done.clean.isEmpty()
    assert all((s.rows_in, s.dropped) == (0, 0) for s in done.steps.collect())
