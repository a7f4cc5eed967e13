"""What travels: narrow look-ups, hashes as bytes, compressed files. Results stay those of plain joins."""

import datetime as dt
import hashlib
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac.functions.masking import packed_hash, unpacked_hash
from tarmac.catalog import QUERIES
from tarmac.operators import heavy, joins, skew
from tarmac.plans import clean, facts, kpis, refresh
from tarmac.roles import PAYMENT_ORDER, TABLE_SCHEMAS, Roles
from tarmac.session import shared_dir, stored
from tarmac.sources import writers


def digest(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


@pytest.fixture(scope="module")
def four(spark):
    def hashes(i):
        return (["HASH_MISSING", digest(i), digest(i).upper(), "abc"][i % 4], [digest(-i), None][i % 5 == 0])

    bookings = [(f"b{i}", f"p{i % 9}", [f"f{i % 4}", None][i % 7 == 0], "CONFIRMED", *hashes(i)) for i in range(40)]
    flights = [(f"f{i}", f"A{i}", f"R{i % 2}") for i in range(1, 4)]
    payments = [(f"t{i}", f"b{i % 11}", float(i), "UPI") for i in range(90)] + [("x", None, 1.0, "UPI"), ("y", "zz", 2.0, "UPI")]
    people = [(f"p{i}", "F", 30.0 + i, "31-45", digest(100 + i)) for i in range(8)]
    kinds = (
        "booking_id string, passenger_id string, flight_id string, status string, passport_number string, emergency_contact_phone string",
        "flight_id string, airline string, route string",
        "payment_id string, booking_id string, amount double, payment_method string",
        "passenger_id string, gender string, age double, status string, email string",
    )
    frames = [spark.createDataFrame(t, k) for t, k in zip((bookings, flights, payments, people), kinds)]
    keys = (["booking_id", "passenger_id", "flight_id"], ["flight_id"], ["booking_id"], ["passenger_id"])
    return [heavy.stored_with_sketches(df.repartition(3), "four", k) for df, k in zip(frames, keys)]


def plain(bookings, flights, payments, people):
    side = people.select("passenger_id", "age", "gender")
    wide = bookings.join(flights, "flight_id", "left").join(side, "passenger_id", "left").join(payments, "booking_id", "left")
    order = [*bookings.columns, *flights.columns[1:], "payment_id", "amount", "payment_method", "age", "gender"]
    return wide.select(*order)


@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("rows_per_task", [2, 10**7])
def test_wide_table_is_that_of_plain_joins(four, unique, rows_per_task):
    got = joins.master(*four, rows_per_task, unique)
    assert got.columns == plain(*four).columns
    assert rows(got) == rows(plain(*four))


def test_repeated_bookings_and_customers_keep_every_row(spark, four):
    bookings, flights, payments, people = four
    twice = bookings.unionAll(bookings.filter("booking_id IN ('b1', 'b2', 'b12')"))
    twice = twice.unionAll(bookings.limit(3).withColumn("booking_id", F.lit(None).cast("string")))
    twice = heavy.stored_with_sketches(twice, "twice", ["booking_id", "passenger_id", "flight_id"])
    listed = stored(people.unionAll(people.filter("passenger_id = 'p1'").withColumn("age", F.lit(1.0))), "listed")
    for limit in (2, 10**7):
        got = joins.master(twice, flights, payments, listed, limit, False)
        assert rows(got) == rows(plain(twice, flights, payments, listed))


def exchanges(df):
    """Columns of every shuffle by its keys."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((.*?), \d+\)", text)
    return [(re.sub(r"#\d+L?", "", keys), set(re.sub(r"#\d+L?", "", columns).split(", "))) for columns, keys in found]


def test_other_columns_of_bookings_travel_once(spark, four):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = exchanges(joins.master(*four))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Once more without a broadcast of the frequent ids, which Spark was told not to make here.
    assert sorted(keys for keys, columns in seen if "status" in columns) == ["booking_id", "booking_id, _part"]
    assert all("_passport_number" in columns for _, columns in seen if "status" in columns)


def test_unasked_hashes_do_not_travel_where_ids_repeat(spark, four):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = exchanges(joins.master(*four, unique=False).select("booking_id", "route", "amount", "gender"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(seen) >= 6
    for _, columns in seen:
        assert not columns & {"passport_number", "_passport_number", "status", "airline"}


def test_packed_hashes_give_their_text_back(spark):
    texts = [digest(1), digest(1).upper(), "HASH_MISSING", "", "0", "abc", "ab", None, "é" * 40, digest(2)[:-1]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    raw, text = packed_hash(F.col("t"))
    got = df.select("t", raw.alias("raw"), text.alias("text")).withColumn("back", unpacked_hash(F.col("raw"), F.col("text")))
    assert all(r["t"] == r["back"] and (r["raw"] is None or r["text"] is None) for r in got.collect())
    assert got.filter(F.octet_length("raw") == 32).count() == 1


def test_files_are_compressed_well(spark, four, tmp_path):
    path = writers.write_tables({"b": four[0]}, str(tmp_path))["b"]
    heavy.write_with_sketches(four[0], f"{tmp_path}/h", ["booking_id"])
    files = [*(tmp_path / "b").glob("*.parquet"), *(tmp_path / "h").glob("*.parquet")]
    files += [f.removeprefix("file:") for f in stored(four[0], "kept").inputFiles()]
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}


def test_script_reports_look_carriers_up_once(spark, four):
    bookings, flights, payments, people = four
    tables = {"cleaned_bookings_masked": bookings, "cleaned_flights": flights, "cleaned_payments": payments}
    paid, y = refresh.stored_facts(tables)
    assert "airline" in paid.columns
    before = facts.booking_facts(bookings.select("booking_id", "passenger_id", "flight_id", "status"), payments)
    before = heavy.stored_with_sketches(before, "before", ["passenger_id", "flight_id"])
    people = people.withColumn("age_group", F.lit("31-45"))
    assert rows(kpis.revenue_by_airline(paid, y, flights)) == rows(kpis.revenue_by_airline(before, payments, flights))
    seen = kpis.airline_passenger_demographics(paid, flights, y, people)
    assert rows(seen) == rows(kpis.airline_passenger_demographics(before, flights, payments, people))
    assert all("flight_id" not in keys for keys, _ in exchanges(seen))


@pytest.fixture(scope="module")
def untidy(spark, tmp_path_factory):
    """Tables with frequent bookings, customers and flights, whole-row copies, missing keys and amounts, and bookings all of
    whose payments are dropped."""
    base = str(tmp_path_factory.mktemp("untidy"))
    day = dt.datetime(2024, 1, 1)
    orders = [(i % 9 or None, [1, i % 5, None][i % 3], "FOP"[i % 3], 1.0, day + dt.timedelta(days=i), f"{i % 2}-HIGH") for i in range(60)]
    lines = [(i % 11 or None, 1, 1, i % 13, 1.0, [None, float(i)][i % 11 not in (3, 4) and i % 7 > 0], 0.0, 0.0, "ANR"[i % 3], "O", day) for i in range(120)]
    data = {
        "orders": orders + orders[:25],
        "lineitem": lines + lines[20:90],
        "customer": [(i % 4, f"C{i}", 1, 1.0, "BUILDING") for i in range(7)] * 2,
        "events": [(i, day + dt.timedelta(minutes=i), i % 3, "vcs"[i % 3], 1.0, "{}") for i in range(40)],
    }
    for name, table in data.items():
        spark.createDataFrame(table, TABLE_SCHEMAS[name]).repartition(3).write.parquet(f"{base}/{name}.parquet")
    return base


def kept_tables(spark, purpose):
    """Stored tables of a purpose, without the sketches beside them."""
    base = Path(shared_dir(spark).removeprefix("file:"))
    return {p.name for p in base.glob(f"{purpose}-*") if "-heavy-" not in p.name}


def test_notebook_wide_table_stores_neither_bookings_nor_payments(spark, untidy):
    before = kept_tables(spark, "bookings") | kept_tables(spark, "payments")
    assert QUERIES["master_4way_nb"](spark, untidy).count() > 0
    assert kept_tables(spark, "bookings") | kept_tables(spark, "payments") == before


@pytest.mark.parametrize("rows_per_task", [2, 10**7])
def test_notebook_wide_table_is_that_of_plain_joins(spark, untidy, rows_per_task):
    r = Roles(spark, untidy, "notebook", rows_per_task)
    got = joins.master(r.wide_bookings, r.flights, r.wide_payments, r.passengers_masked, rows_per_task, False)
    flights, people = r.flights, r.passengers_masked
    side = people.select(*[c for c in joins.PASSENGER_COLUMNS if c in people.columns])
    wide = r.bookings_masked.join(flights, "flight_id", "left").join(side, "passenger_id", "left").join(r.payments, "booking_id", "left")
    assert sorted(got.columns) == sorted(wide.columns)
    assert rows(got) == rows(wide.select(*got.columns))
    assert got.count() > r.bookings.count()


def test_sketches_of_tables_used_once_name_their_keys_only(spark, untidy):
    r = Roles(spark, untidy, "notebook")
    for table, key in ((r.wide_payments, "booking_id"), *((r.wide_bookings, k) for k in r.wide_bookings.heavy_keys_at)):
        own = dict(table.groupBy(key).count().collect())
        seen = dict(heavy.frequent(table, key).collect())
        assert seen.keys() == own.keys() and all(seen[k] >= own[k] for k in own)
    # Bookings without any payment left have no hot key, however many payments they had.
    assert not {"3", "4"} & {k for k, _ in skew.hot_keys(r.wide_payments, "booking_id", 1).collect()}
    assert not hasattr(r.payments, "heavy_keys_at")


def test_sketch_of_a_table_used_once_shuffles_nothing(spark, untidy):
    rows_before = clean.valid_payments(Roles(spark, untidy).raw_payments, "notebook", PAYMENT_ORDER).select("booking_id")
    assert exchanges(rows_before) == []
    empty = heavy.sketched(rows_before.limit(0), rows_before.limit(0), "none", ["booking_id"])
    assert rows(empty) == rows(heavy.frequent(empty, "booking_id")) == []


def test_marks_of_rows_are_two_bytes_and_differ(spark):
    marks = [m for (m,) in spark.range(5000).select(joins._mark(spark.range(1))).collect()]
    assert 0 <= min(marks) and max(marks) < joins.MARKS and len(set(marks)) > 4500
