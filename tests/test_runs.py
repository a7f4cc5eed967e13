"""Whole runs: file order by default, publishing, slicers."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac import schemas
from tarmac.plans import refresh, report
from tarmac.roles import TEST_SALT, Roles
from tarmac.sources import publish, readers

FLIGHTS = [
    ("AI1", "Air India", "DEL", "BOM", "2024-01-01 10:00:00", "2024-01-01 12:00:00"),
    ("AI1", "Air India", "AAA", "BBB", "2024-01-01 10:00:00", "2024-01-01 13:00:00"),
    ("6E2", "Indigo", "BOM", "DEL", "2024-01-02 08:00:00", "2024-01-02 10:30:00"),
]
BOOKINGS = [
    ("B1", "P1", "AI1", "2024-01-01", "confirmed", "x", "9Z", "Zed", "9"),
    ("B1", "P2", "6E2", "2024-01-01", "cancelled", "a", "1A", "Ann", "1"),
    ("B2", "P2", "6E2", "2024-01-01", "confirmed", "a", "1A", "Ann", "1"),
]
PASSENGERS = [
    ("P1", "Zoe", "Z", "40", "F", "z@x", "9", "9", "1980-01-01"),
    ("P1", "Amy", "A", "20", "F", "a@x", "1", "1", "2000-01-01"),
    ("P2", "Bob", "B", "30", "M", "b@x", "2", "2", "1990-01-01"),
]
PAYMENTS = [("T1", "B2", "900", "upi"), ("T1", "B1", "100", "card"), ("T2", "B1", "50", "upi")]
TABLES = {"flights": FLIGHTS, "bookings": BOOKINGS, "passengers": PASSENGERS, "payments": PAYMENTS}


@pytest.fixture
def csv(tmp_path):
    """Tables in two files each; the first rows stand in the first file."""
    for name, lines in TABLES.items():
        head = ",".join(schemas.INPUTS[name].fieldNames())
        (tmp_path / "raw" / name).mkdir(parents=True)
        for part, own in enumerate((lines[:1], lines[1:])):
            text = "\n".join([head, *(",".join(line) for line in own)]) + "\n"
            (tmp_path / "raw" / name / f"part-{part}.csv").write_text(text)
    return tmp_path


def load(spark, csv, **options):
    return readers.read_tables(spark, str(csv / "raw"), schemas.INPUTS, fmt="csv", schemas=schemas.INPUTS, **options)


def test_first_in_file_order_without_being_told(spark, csv):
    out = refresh.run(spark, load(spark, csv), TEST_SALT, str(csv / "out"))
    for table in out.values():
        assert readers.FILE_ORDER not in table.columns
    assert rows(out["cleaned_flights"].select("flight_id", "route")) == [("6E2", "BOM to DEL"), ("AI1", "DEL to BOM")]
    assert rows(out["cleaned_bookings_masked"].select("booking_id", "passenger_id")) == [("B1", "P1"), ("B2", "P2")]
    assert rows(out["cleaned_passengers_masked"].select("passenger_id", "age")) == [("P1", 40.0), ("P2", 30.0)]
    assert rows(out["cleaned_payments"].select("payment_id", "amount")) == [("T1", 900.0), ("T2", 50.0)]


def test_an_order_given_comes_before_file_order(spark, csv):
    first = {"payments": ["amount"], "bookings": ["passport_number"]}
    out = refresh.clean_tables(spark, load(spark, csv), TEST_SALT, str(csv / "out"), order_by=first)
    assert rows(out["cleaned_payments"].select("payment_id", "amount")) == [("T1", 100.0), ("T2", 50.0)]
    assert rows(out["cleaned_bookings_masked"].select("booking_id", "passenger_id")) == [("B1", "P2"), ("B2", "P2")]


def test_without_file_order_the_least_row_is_first(spark, csv):
    raw = load(spark, csv, keep_order=False)
    assert readers.file_order(raw["flights"]) is None
    out = refresh.clean_tables(spark, raw, TEST_SALT, str(csv / "out"))
    assert rows(out["cleaned_flights"].select("flight_id", "route")) == [("6E2", "BOM to DEL"), ("AI1", "AAA to BBB")]


def test_readers_see_whole_runs_only(spark, csv, monkeypatch):
    base = str(csv / "out")
    assert publish.published(spark, base) == {}
    first = refresh.run(spark, load(spark, csv), TEST_SALT, base)
    seen = publish.published(spark, base)
    assert set(seen) == set(first)
    before = {name: rows(df) for name, df in seen.items()}

    (csv / "raw" / "payments" / "part-2.csv").write_text("payment_id,booking_id,amount,payment_method\nT9,B2,7,upi\n")
    real = refresh.kpi_tables

    def dies(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(refresh, "kpi_tables", dies)
    with pytest.raises(RuntimeError, match="lost"):
        refresh.run(spark, load(spark, csv), TEST_SALT, base)
    assert {name: rows(df) for name, df in publish.published(spark, base).items()} == before

    monkeypatch.setattr(refresh, "kpi_tables", real)
    refresh.run(spark, load(spark, csv), TEST_SALT, base)
    after = publish.published(spark, base)
    assert after["cleaned_payments"].count() == len(before["cleaned_payments"]) + 1
    assert publish.manifests(spark, base).select("run").distinct().count() == 2


def test_slicers_filter_like_the_wide_table(spark, folder):
    r = Roles(spark, folder)
    from tarmac.operators import joins
    from tarmac.operators.filters import slice_by

    wide = joins.master(r.stored_bookings, r.flights, r.stored_payments, r.passengers_masked)
    for chosen in (
        {"route": "VIEW to CLICK"},
        {"gender": ["F"], "is_delayed": 0},
        {"departure_time": (datetime(2024, 1, 3), datetime(2024, 1, 20)), "status": "CONFIRMED"},
        {"amount": (100.0, 40_000.0), "age_group": "60+"},
    ):
        kept = slice_by(wide, chosen)
        got = report.measures(
            r.facts, r.flights, r.payments, r.passengers, ["total_bookings", "total_flights", "total_revenue"], slicers=chosen
        ).first()
        want = kept.agg(F.count(F.lit(1)), F.countDistinct("flight_id"), F.coalesce(F.sum("amount"), F.lit(0.0))).first()
        assert (got[0], got[1]) == (want[0], want[1]), chosen
        assert got[2] == pytest.approx(want[2])


def test_slicers_of_unknown_columns_are_refused(spark, folder):
    r = Roles(spark, folder)
    with pytest.raises(ValueError, match="moon"):
        report.measures(r.facts, r.flights, r.payments, r.passengers, ["total_bookings"], slicers={"moon": 1})


def test_sliced_tables_are_filtered_before_the_join(spark, folder):
    r = Roles(spark, folder)
    names = ["total_bookings"]
    df = report.measures(r.facts, r.flights, r.payments, r.passengers, names, slicers={"status": "CONFIRMED"})
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,CONFIRMED)]" in df._jdf.queryExecution().executedPlan().toString()
    assert "departure_time" not in df._jdf.queryExecution().optimizedPlan().toString()
