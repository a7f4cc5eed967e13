"""Cleaning of hand-made dirty tables, both variants."""

import pytest

from tables import rows
from tarmac import schemas
from tarmac.plans import audit, clean
from tarmac.sources.readers import ColumnCountError

DAY = "2024-01-01"
FLIGHTS = [
    # id, airline, source, destination, departure, arrival
    (" ai101 ", "unknown", "del", " bom\t", f"{DAY} 06:00:00", f"{DAY} 08:00:00"),
    ("AI101", "Air India", "DEL", "BOM", f"{DAY} 07:00:00", f"{DAY} 09:00:00"),
    ("SJ1", "spicejet", "DEL", "BOM", f"{DAY} 23:50:00", "2024-01-02 00:30:00"),
    ("SJ1", "spicejet", "DEL", "BOM", f"{DAY} 23:50:00", "2024-01-02 00:30:00"),
    ("6F2", "UNKNOWN", "DEL", "BOM", f"{DAY} 12:00:00", f"{DAY} 14:00:00"),
    ("ZZ1", "UNKNOWN", "DEL", "BLR", f"{DAY} 12:00:00", f"{DAY} 13:00:00"),
    ("UK9", None, "DEL", "BLR", f"{DAY} 12:00:00", f"{DAY} 13:00:00"),
    ("G81", "", "DEL", "BLR", f"{DAY} 12:00:00", f"{DAY} 13:00:00"),
    ("X1", "A", "DEL", "BLR", "never", f"{DAY} 13:00:00"),
    ("X2", "A", "DEL", "BLR", f"{DAY} 13:00:00", f"{DAY} 13:00:00"),
    ("X3", "A", "DEL", "BLR", f"{DAY} 13:00:00", f"{DAY} 12:00:00"),
    ("X4", "A", "DEL", "BLR", f"{DAY} 00:00:00", "2024-01-02 00:00:00"),
    ("X5", "A", "DEL", "BLR", f"{DAY} 00:00:00", "2024-01-02 00:00:01"),
    (None, "A", None, "BLR", f"{DAY} 00:00:00", f"{DAY} 01:00:00"),
]


@pytest.fixture(scope="module")
def raw(spark):
    df = spark.createDataFrame(FLIGHTS, schemas.FLIGHTS)
    return df.selectExpr("*", "'=F2-E2' AS duration", "1 AS `Unnamed: 7`")


def test_script_flights(raw):
    got = rows(clean.flights(raw).select("flight_id", "airline", "route", "duration_mins", "is_overnight", "is_delayed"))
    assert got == [
        ("6F2", "IndiGo", "DEL to BOM", 120.0, 0, 0),
        ("AI101", "AIR INDIA", "DEL to BOM", 120.0, 0, 0),
        ("NAN", "A", "NAN to BLR", 60.0, 0, 0),
        ("SJ1", "SPICEJET", "DEL to BOM", 40.0, 1, 0),
        ("X4", "A", "DEL to BLR", 1440.0, 1, 1),
        ("ZZ1", "UNKNOWN", "DEL to BLR", 60.0, 0, 0),
    ]


def test_notebook_keeps_placeholder_carriers(raw):
    got = clean.flights(raw, "notebook")
    assert rows(got.select("flight_id"))[-3:] == [("UK9",), ("X4",), ("ZZ1",)]
    assert rows(got.filter("flight_id = 'SJ1'").select("departure_slot", "departure_hour", "duration_hhmm")) == [
        ("Night", 23, "0h 40m")
    ]
    assert {"departure_date", "arrival_date"} <= set(got.columns)


def test_strict_drops_missing_ids(raw):
    assert "NAN" not in [r[0] for r in rows(clean.flights(raw, strict=True).select("flight_id"))]


def test_delay_needs_more_than_thirty_percent(spark):
    stamps = [("a", 100), ("b", 100), ("c", 130), ("d", 70)]  # mean 100
    data = [(i, "A", "X", "Y", f"{DAY} 00:00:00", f"{DAY} {m // 60:02d}:{m % 60:02d}:00") for i, m in stamps]
    flights = clean.flights(spark.createDataFrame(data, schemas.FLIGHTS))
    assert rows(flights.select("flight_id", "is_delayed")) == [("A", 0), ("B", 0), ("C", 0), ("D", 0)]
    data[2] = ("c", "A", "X", "Y", f"{DAY} 00:00:00", f"{DAY} 02:10:01")
    flights = clean.flights(spark.createDataFrame(data, schemas.FLIGHTS))
    assert rows(flights.select("flight_id", "is_delayed"))[2] == ("C", 1)


def test_first_row_follows_the_given_order(spark):
    data = [("p1", "b1", "5", "upi", 2), ("p1", "b1", "6", "card", 1), ("p1", "b1", None, "card", 0), ("p2", "b1", "x", "upi", 0)]
    df = spark.createDataFrame(data, "a string, b string, c string, d string, line int")
    assert rows(clean.payments(df, order_by=["line"])) == [("P1", "B1", 6.0, "CARD")]
    assert rows(clean.payments(df.drop("line"), "notebook")) == [("p1", "b1", 5.0, "UPI"), ("p1", "b1", 6.0, "CARD")]


def test_wrong_width_is_an_error(spark):
    with pytest.raises(ColumnCountError):
        clean.payments(spark.createDataFrame([("a", "b")], "a string, b string"))


def test_bookings_and_masks(spark):
    data = [
        (" b1", "p1 ", "ai1", DAY, "confirmed", " X1 ", "1a", " Bo", "None"),
        ("B1", "P1", "AI1", "2023-01-01", "CANCELLED", "X2", "2b", "", " 9 "),
        ("b2", None, None, "bad", None, None, None, None, None),
    ]
    raw = spark.createDataFrame(data, schemas.BOOKINGS)
    script = clean.bookings(raw, order_by=["status"])
    assert [(r[0], r[1], r[2], r[4]) for r in rows(script)] == [("B1", "P1", "AI1", "CANCELLED"), ("B2", "NAN", "NAN", "NAN")]
    masked = rows(clean.mask_bookings(script, "s").select("emergency_contact_name", "emergency_contact_phone"))
    assert masked[0][0] == "N***" and masked[1] == ("n***", "HASH_MISSING")
    book = clean.bookings(raw, "notebook")
    assert book.count() == 3
    hidden = clean.mask_bookings(book, "s", "notebook")
    assert "passport_number" not in hidden.columns and "passport_hash" in hidden.columns


def test_passengers(spark):
    data = [
        ("p1", "Al", "B", "17.5", "f", " A@B.c ", "1", "2", "1990-05-01"),
        ("P1 ", "Al", "B", "40", "f", "a", "1", "2", "1991-05-01"),
        ("p2", None, "", "old", "x", None, None, None, "bad"),
    ]
    raw = spark.createDataFrame(data, schemas.PASSENGERS)
    script = clean.mask_passengers(clean.passengers(raw, order_by=["age"]), "s")
    got = rows(script.select("passenger_id", "first_name", "last_name", "age", "gender", "age_group", "birth_year", "phone"))
    assert got[0][:7] == ("P1", "A***", "B***", 17.5, "F", "Under 18", 1990)
    assert got[1] == ("P2", "n***", "N***", None, "M", "Unknown", 0, "HASH_MISSING")
    assert "date_of_birth" not in script.columns
    book = clean.mask_passengers(clean.passengers(raw, "notebook"), "s", "notebook")
    assert rows(book.select("passenger_id", "gender", "birth_year"))[2] == ("p2", "X", None)
    assert not {"email", "phone", "first_name", "date_of_birth"} & set(book.columns)


def test_audit(raw):
    got = [tuple(r) for r in audit.flight_steps(clean._named(raw, schemas.FLIGHTS.fieldNames(), None)).collect()]
    assert got == [
        (1, "null_times", 14, 1),
        (2, "duplicate_rows", 13, 1),
        (3, "duplicate_ids", 12, 1),
        (4, "invalid_interval", 11, 2),
        (5, "unresolved_carrier", 9, 2),
        (6, "duration_range", 7, 1),
    ]
