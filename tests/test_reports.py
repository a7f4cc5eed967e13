"""Facts that must hold between the reports on any data, and the whole run end to end."""

import pytest
from pyspark.sql import functions as F

from tables import rows
from tarmac.plans import refresh, report
from tarmac.roles import TEST_SALT, Roles

KPI_NAMES = {
    "kpi_route_traffic", "kpi_avg_duration_by_airline", "kpi_avg_duration_by_route", "kpi_airline_distribution",
    "kpi_delay_summary", "kpi_revenue_by_airline", "kpi_departure_slots", "kpi_booking_status", "kpi_payment_methods",
    "kpi_passenger_demographics", "kpi_frequent_flyers", "kpi_airline_passenger_demographics",
}


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


@pytest.fixture(scope="module")
def run(spark, folder, tmp_path_factory):
    r = Roles(spark, folder)
    base = str(tmp_path_factory.mktemp("run"))
    return refresh.run(spark, r.raw, TEST_SALT, base, order_by=r.order_by)


def test_all_tables_are_written(run):
    cleaned = {"cleaned_flights", "cleaned_bookings_masked", "cleaned_passengers_masked", "cleaned_payments", "master_dataset"}
    assert set(run) == KPI_NAMES | cleaned
    assert all(not df.isEmpty() for df in run.values())


def test_flight_totals_agree(run):
    flights = run["cleaned_flights"].count()
    assert total(run["kpi_route_traffic"], "flight_count") == flights
    assert total(run["kpi_airline_distribution"], "flight_count") == flights
    assert total(run["kpi_delay_summary"], "total_flights") == flights
    assert total(run["kpi_departure_slots"], "flight_count") == flights


def test_delay_totals_agree(run):
    delayed = total(run["cleaned_flights"], "is_delayed")
    assert total(run["kpi_delay_summary"], "delayed_flights") == delayed
    assert total(run["kpi_departure_slots"], "delayed_flights") == delayed
    assert total(run["kpi_delay_summary"], "overnight_flights") == total(run["cleaned_flights"], "is_overnight")


def test_shares_add_up(run):
    assert total(run["kpi_booking_status"], "booking_count") == run["cleaned_bookings_masked"].count()
    assert total(run["kpi_booking_status"], "percentage") == pytest.approx(100, abs=0.05)
    assert total(run["kpi_airline_distribution"], "market_share_pct") == pytest.approx(100, abs=0.05)


def test_money_agrees(run):
    paid = total(run["cleaned_payments"], "amount")
    assert total(run["kpi_payment_methods"], "total_amount") == pytest.approx(paid)
    assert total(run["kpi_passenger_demographics"], "total_spend") == pytest.approx(paid)
    carried = total(run["master_dataset"].filter("airline IS NOT NULL"), "amount")
    assert total(run["kpi_revenue_by_airline"], "total_revenue") == pytest.approx(carried)
    assert total(run["kpi_airline_passenger_demographics"], "revenue") == pytest.approx(carried)


def test_fan_out_counts_payments(run):
    payments, bookings = run["cleaned_payments"], run["cleaned_bookings_masked"]
    unpaid = bookings.count() - payments.select("booking_id").distinct().count()
    assert run["master_dataset"].count() == payments.count() + unpaid
    assert total(run["kpi_passenger_demographics"], "total_bookings") == payments.count() + unpaid


def test_every_passenger_is_counted(run):
    assert total(run["kpi_passenger_demographics"], "passenger_count") == run["cleaned_passengers_masked"].count()
    assert run["kpi_frequent_flyers"].count() == 20


def test_no_personal_data_left(run):
    people, bookings = run["cleaned_passengers_masked"], run["cleaned_bookings_masked"]
    assert "date_of_birth" not in people.columns
    assert people.filter(~F.col("first_name").endswith("***") | F.col("email").contains("@")).isEmpty()
    assert bookings.filter((F.length("passport_number") != 64) & (F.col("passport_number") != "HASH_MISSING")).isEmpty()


def test_written_and_direct_reports_are_the_same(run, spark, folder):
    """The stored flag and the counted one lead to the same delays."""
    r = Roles(spark, folder)
    tables = {
        "cleaned_flights": r.timed,
        "cleaned_bookings_masked": r.bookings_masked,
        "cleaned_passengers_masked": r.passengers_masked,
        "cleaned_payments": r.payments,
    }
    for name, df in refresh.kpi_tables(tables).items():
        assert rows(df) == rows(run[name]), name


def test_notebook_run(spark, folder, tmp_path):
    r = Roles(spark, folder, "notebook")
    out = refresh.run(spark, r.raw, TEST_SALT, str(tmp_path), "notebook", r.order_by)
    assert out["cleaned_flights"].columns == refresh.FLIGHT_EXPORT
    assert "payment_id" not in out["master_dataset"].columns
    assert {"birth_year", "first_name_masked"} <= set(out["master_dataset"].columns)
    assert total(out["kpi_route_traffic"], "flight_count") == out["cleaned_flights"].count()


def test_measures_match_the_wide_table(run, spark):
    wide = run["master_dataset"]
    names = list(report.MEASURES)
    got = report.measures(
        run["cleaned_bookings_masked"], run["cleaned_flights"], run["cleaned_payments"],
        run["cleaned_passengers_masked"], names,
    ).first()
    assert got["total_bookings"] == wide.count()
    assert got["delayed_flights"] == wide.filter("is_delayed = 1").count()
    assert got["avg_age"] == pytest.approx(wide.agg(F.avg("age")).first()[0])
    assert got["avg_duration"] == pytest.approx(wide.agg(F.avg("duration_mins")).first()[0])
    normal = report.normalise(wide)
    assert got["avg_duration_zero_filled"] == pytest.approx(normal.agg(F.avg("duration_mins")).first()[0])
    assert got["avg_age_zero_filled"] == pytest.approx(normal.agg(F.avg("age")).first()[0])
    text_columns = [c for c, t in normal.dtypes if t == "string"]
    assert normal.filter(" OR ".join(f"{c} IS NULL" for c in text_columns)).isEmpty()


def test_hot_user_and_hot_booking_change_nothing(spark, folder):
    """Splitting every key into small parts gives the same wide table."""
    from tarmac.operators import joins

    small, normal = Roles(spark, folder, rows_per_task=2), Roles(spark, folder)
    tables = [
        joins.master(r.bookings, r.timed, r.stored_payments, r.passengers, r.rows_per_task) for r in (small, normal)
    ]
    assert rows(tables[0]) == rows(tables[1])


def test_customers_listed_twice_multiply_rows(spark):
    """The notebook variant joins every listing of a customer."""
    from tarmac.plans import extended

    bookings = spark.createDataFrame(
        [("b1", "p1", "f1", "CONFIRMED"), ("b2", "p1", "f1", "PENDING"), ("b3", "p2", "zz", "CONFIRMED")],
        "booking_id string, passenger_id string, flight_id string, status string",
    )
    payments = spark.createDataFrame(
        [("x", "b1", 10.0, "UPI"), ("y", "b1", 5.5, "UPI")],
        "payment_id string, booking_id string, amount double, payment_method string",
    )
    people = spark.createDataFrame(
        [("p1", "F", "18-30"), ("p1", "F", "18-30"), ("p2", "M", "60+")], "passenger_id string, gender string, age_group string"
    )
    flights = spark.createDataFrame([("f1", "A")], "flight_id string, airline string")
    assert rows(extended.passenger_demographics(bookings, payments, people)) == [
        ("F", "18-30", 1, 6, 31.0, 7.75), ("M", "60+", 1, 1, 0.0, None),
    ]
    assert rows(extended.frequent_flyers(bookings, payments, people)) == [
        ("p1", "F", "18-30", 6, 4, 31.0, 7.75), ("p2", "M", "60+", 1, 1, 0.0, None),
    ]
    assert rows(extended.airline_passenger_demographics(bookings, payments, flights, people)) == [
        ("A", "F", "18-30", 6, 1, 31.0, 7.75),
    ]
