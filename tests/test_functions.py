"""Column functions on hand-made values."""

import datetime
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.functions import masking, numeric, temporal, text

SALT = "pepper"


@pytest.fixture(scope="module")
def apply(spark):
    """Apply a function to a list of values of one type and return the results in order."""

    def run(fn, values, kind="string"):
        data = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(data, f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]

    return run


def test_text_forms(apply):
    raw = [None, "", "  ab ", "\t\n Cd\r\x0b", "  x　", "été ", "a b"]
    assert apply(text.norm_upper, raw) == ["NAN", "", "AB", "CD", "X", "ÉTÉ", "A B"]
    assert apply(text.norm_lower, raw)[:4] == ["nan", "", "ab", "cd"]
    assert apply(text.norm_strip, raw) == ["nan"] + [v.strip() for v in raw[1:]]
    assert apply(text.strip, [None]) == [None]


def test_try_double(apply):
    raw = ["1", " 2.5 ", "1,000", "NaN", "abc", "", None, "1e3", "7d", "7f", "inf", "-0.5"]
    assert apply(numeric.try_double, raw) == [1.0, 2.5, None, None, None, None, None, 1000.0, None, None, float("inf"), -0.5]
    assert apply(numeric.typed_double, [1.5, float("nan"), None], "double") == [1.5, None, None]
    assert apply(lambda c: numeric.numeric_or_zero(c, "int"), ["3.9", "-3.9", "x", None]) == [3, -3, 0, 0]


def test_round2_is_numpy(apply):
    values = [3.125, 0.575, 1.005, 2.675, 33.335, -0.125, 99.995] + [n / 7 * 100 for n in range(50)]
    assert apply(numeric.round2, values, "double") == [float(np.round(v, 2)) for v in values]


def test_ratios(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0)], "a double, b double")
    got = df.select(numeric.percent(F.col("a"), F.col("b")), numeric.divide_or_zero(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(25.0, 0.25), (None, 0.0), (None, 0.0)]


def test_age_groups(apply):
    ages = [None, float("nan"), -1.0, 17.0, 17.5, 18.0, 30.0, 30.5, 45.0, 46.0, 60.0, 61.0]
    assert apply(numeric.age_group, ages, "double") == [
        "Unknown", "Unknown", "Under 18", "Under 18", "Under 18", "18-30", "18-30", "31-45", "31-45", "46-60", "46-60", "60+",
    ]


def test_timestamps(apply):
    got = apply(temporal.try_timestamp, ["2024-01-02 03:04:05", "2024-01-02", "soon", None, "2024-13-01"])
    assert got == [datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.datetime(2024, 1, 2), None, None, None]
    got = apply(lambda c: temporal.try_timestamp(c, ("dd/MM/yyyy HH:mm",)), ["03/02/2024 10:30", "x"])
    assert got == [datetime.datetime(2024, 2, 3, 10, 30), None]


def test_time_slots(apply):
    hours = [4, 5, 8, 9, 11, 12, 16, 17, 20, 21, 0]
    stamps = [datetime.datetime(2024, 1, 1, h, 59) for h in hours] + [None]
    got = apply(temporal.time_slot, stamps, "timestamp_ntz")
    night, early, morning = "Night (21-05)", "Early Morning (05-09)", "Morning (09-12)"
    noon, evening = "Afternoon (12-17)", "Evening (17-21)"
    assert got == [night, early, early, morning, morning, noon, noon, evening, evening, night, night, "Unknown"]
    plain = apply(lambda c: temporal.time_slot(c, with_hours=False), stamps, "timestamp_ntz")
    assert plain == [g.split(" (")[0] for g in got]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_durations_ignore_the_session_zone(spark, zone):
    # The clocks of New York jump between these two moments.
    start, end = datetime.datetime(2024, 3, 10, 1, 30), datetime.datetime(2024, 3, 10, 3, 30, 0, 600000)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(start, end)], "a timestamp_ntz, b timestamp_ntz")
        got = df.select(
            temporal.duration_minutes(F.col("a"), F.col("b")), temporal.minute_number(F.col("b"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == 120.01
    assert got[1] == int((end - datetime.datetime(1970, 1, 1)).total_seconds() // 60)


def test_overnight_and_hhmm(spark, apply):
    pairs = [
        (datetime.datetime(2024, 1, 1, 23, 50), datetime.datetime(2024, 1, 2, 0, 30)),
        (datetime.datetime(2024, 1, 1, 1, 0), datetime.datetime(2024, 1, 1, 23, 0)),
    ]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(temporal.overnight(F.col("a"), F.col("b"))).collect()] == [1, 0]
    assert apply(temporal.hours_and_minutes, [0.01, 59.99, 60.0, 1440.0], "double") == ["0h 0m", "0h 59m", "1h 0m", "24h 0m"]


def test_years(apply):
    dob = [datetime.datetime(1990, 5, 1), None]
    assert apply(temporal.birth_year, dob, "timestamp_ntz") == [1990, 0]
    assert apply(lambda c: temporal.birth_year(c, zero_for_missing=False), dob, "timestamp_ntz") == [1990, None]


def test_hashes(apply):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    values = [" x ", "nan", "None", "", "  ", None, "NONE", "NaN"]
    missing = "HASH_MISSING"
    assert apply(lambda c: masking.hash_salt_last(c, SALT), values) == [sha("x" + SALT)] + [missing] * 7
    got = apply(lambda c: masking.hash_salt_first(c, SALT), values)
    assert got == [sha(f"{SALT}: x "), None, None, None, None, None, sha(f"{SALT}:NONE"), sha(f"{SALT}:NaN")]


def test_name_masks(apply):
    names = [" Ada ", "", "  ", None, "Éva"]
    assert apply(masking.initial_of_stripped, names) == ["A***", "N***", "N***", "n***", "É***"]
    assert apply(masking.initial_or_stars, names) == [" ***", "***", " ***", "***", "É***"]


def test_carrier_lookup(spark):
    df = spark.createDataFrame(
        [("UNKNOWN", "AI1"), ("UNKNOWN", "ZZ1"), ("INDIGO", "AI1"), ("", "ai1"), ("Unknown", "6F9"), ("NAN", "XX")],
        "airline string, flight_id string",
    )
    args = F.col("airline"), F.col("flight_id")
    assert [r[0] for r in df.select(text.impute_carrier(*args)).collect()] == [
        "Air India", "UNKNOWN", "INDIGO", "", "Unknown", "NAN",
    ]
    assert [r[0] for r in df.select(text.impute_carrier_for_report(*args)).collect()] == [
        "Air India", "UNKNOWN", "INDIGO", "Air India", "IndiGo", "NAN",
    ]


def test_value_maps(apply):
    assert apply(lambda c: text.map_values(c, {"a": "A"}), ["a", "b", None]) == ["A", "b", None]
    assert apply(text.collapse_status, ["CONFIRMED", "CANCELLED", "NAN", "PENDING"]) == [
        "CONFIRMED", "CANCELLED", "CONFIRMED", "CONFIRMED",
    ]
    assert apply(text.binary_gender, ["F", "M", "X", "NAN"]) == ["F", "M", "M", "M"]
