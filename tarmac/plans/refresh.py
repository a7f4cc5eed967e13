"""The whole run: raw tables to clean tables, the wide table and the KPI tables.

Every table that is used more than once is written and read back, so no cleaning step runs
twice and a lost executor never forces one to start over.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tarmac import constants as C
from tarmac import schemas
from tarmac.operators import joins
from tarmac.operators.heavy import narrowed, read_with_sketches, stored_with_sketches, write_with_sketches
from tarmac.plans import clean, extended, facts, kpis
from tarmac.session import stored
from tarmac.sources import readers
from tarmac.sources.publish import publish, run_folder
from tarmac.sources.readers import read, require_tables
from tarmac.sources.writers import write_tables

FLIGHT_EXPORT = [
    "flight_id", "airline", "source", "destination", "route", "departure_time", "arrival_time",
    "duration_mins", "duration_hhmm", "is_overnight", "departure_slot", "is_delayed",
    "departure_date", "arrival_date", "departure_hour",
]


#: Columns that the wide table and the reports join by; sketches of their frequent values lie beside the tables.
JOINED_BY = {
    "cleaned_bookings_masked": ["booking_id", "passenger_id", "flight_id"],
    "cleaned_payments": ["booking_id"],
}


def clean_tables(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    salt: str,
    base: str,
    variant: str = "script",
    order_by: Mapping[str, list[str]] | None = None,
    rows_per_task: int = C.ROWS_PER_TASK,
) -> dict[str, DataFrame]:
    """Write the clean tables and the wide table below `base` and return them as read back.

    The first row of a key is that of `order_by`; where it names nothing for a table, the first in file order if the table was
    read with it (`readers.read_tables`), else the least row.
    """
    require_tables(raw, schemas.INPUTS)
    first = {name: readers.file_order(df) for name, df in raw.items()} | dict(order_by or {})

    def kept(name: str, df: DataFrame) -> DataFrame:
        path, keys = f"{base}/{name}", JOINED_BY.get(name, [])
        if not keys:
            return read(spark, write_tables({name: df}, base)[name])
        write_with_sketches(df, path, keys)
        return read_with_sketches(read(spark, path), path, keys)

    timed = kept("flights_without_delay", clean.flights_without_delay(raw["flights"], variant, first.get("flights")))
    flights = clean.with_delay_flag(timed)
    if variant == "notebook":
        flights = flights.select(*FLIGHT_EXPORT)
    bookings = clean.mask_bookings(clean.bookings(raw["bookings"], variant, first.get("bookings")), salt, variant)
    passengers = clean.mask_passengers(
        clean.passengers(raw["passengers"], variant, first.get("passengers")), salt, variant
    )
    out = {
        "cleaned_flights": kept("cleaned_flights", flights),
        "cleaned_bookings_masked": kept("cleaned_bookings_masked", bookings),
        "cleaned_passengers_masked": kept("cleaned_passengers_masked", passengers),
        "cleaned_payments": kept(
            "cleaned_payments", clean.payments(raw["payments"], variant, first.get("payments"))
        ),
    }
    wide = joins.master(
        out["cleaned_bookings_masked"],
        out["cleaned_flights"],
        out["cleaned_payments"],
        out["cleaned_passengers_masked"],
        rows_per_task,
        variant == "script",
    )
    if variant == "notebook":
        wide = wide.drop("payment_id")
    out["master_dataset"] = kept("master_dataset", wide)
    return out


def stored_facts(
    tables: Mapping[str, DataFrame], variant: str = "script", rows_per_task: int = C.ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame]:
    """Bookings with what was paid, and payments by booking and method: the only place where payments are shuffled.

    Flights are unique in the script variant, and bookings get their carrier here, once for all reports and while they are narrow.
    """
    keys = ["passenger_id", "flight_id"]
    bookings = narrowed(tables["cleaned_bookings_masked"], "booking_id", *keys, "status")
    payments = stored(facts.payment_facts(tables["cleaned_payments"]), "payment-facts")
    if variant == "script":
        flown = joins.with_carrier(bookings, tables["cleaned_flights"], rows_per_task=rows_per_task)
        return stored_with_sketches(facts.booking_facts(flown, payments), "facts", keys), payments
    paid = facts.booking_facts(bookings, payments, False, rows_per_task)
    return stored_with_sketches(paid, "facts", ["booking_id", *keys]), payments


def kpi_tables(
    tables: Mapping[str, DataFrame], variant: str = "script", rows_per_task: int = C.ROWS_PER_TASK
) -> dict[str, DataFrame]:
    """The twelve KPI tables of clean tables, by name. Those with shares store their counts first."""
    f, p = tables["cleaned_flights"], tables["cleaned_passengers_masked"]
    paid, y = stored_facts(tables, variant, rows_per_task)
    b, paying = tables["cleaned_bookings_masked"], tables["cleaned_payments"]
    if variant == "script":
        return {
            "kpi_route_traffic": kpis.route_traffic(f),
            "kpi_avg_duration_by_airline": kpis.avg_duration_by_airline(f),
            "kpi_avg_duration_by_route": kpis.avg_duration_by_route(f),
            "kpi_airline_distribution": kpis.airline_distribution(f),
            "kpi_delay_summary": kpis.delay_summary(f),
            "kpi_revenue_by_airline": kpis.revenue_by_airline(paid, y, f),
            "kpi_departure_slots": kpis.departure_slots(f),
            "kpi_booking_status": kpis.booking_status(b),
            "kpi_payment_methods": kpis.payment_methods(paying),
            "kpi_passenger_demographics": kpis.passenger_demographics(p, paid, y),
            "kpi_frequent_flyers": kpis.frequent_flyers(p, paid, y),
            "kpi_airline_passenger_demographics": kpis.airline_passenger_demographics(paid, f, y, p, rows_per_task),
        }
    return {
        "kpi_route_traffic": extended.route_traffic(f),
        "kpi_avg_duration_by_airline": extended.avg_by_airline(f),
        "kpi_avg_duration_by_route": extended.avg_by_route(f),
        "kpi_airline_distribution": extended.airline_distribution(f),
        "kpi_delay_summary": extended.delay_summary(f),
        "kpi_revenue_by_airline": extended.revenue_by_airline(paid, y, f),
        "kpi_departure_slots": extended.slot_traffic(f),
        "kpi_booking_status": extended.booking_status(b),
        "kpi_payment_methods": extended.payment_method(paying),
        "kpi_passenger_demographics": extended.passenger_demographics(paid, y, p),
        "kpi_frequent_flyers": extended.frequent_flyers(paid, y, p),
        "kpi_airline_passenger_demographics": extended.airline_passenger_demographics(paid, y, f, p, rows_per_task),
    }


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    salt: str,
    base: str,
    variant: str = "script",
    order_by: Mapping[str, list[str]] | None = None,
    rows_per_task: int = C.ROWS_PER_TASK,
) -> dict[str, DataFrame]:
    """Everything: clean tables, wide table and KPI tables, written to a folder of this run below `base`.

    They are published together at the end (`publish.publish`): readers see the run before until then, and
    go on seeing it if this one dies.
    """
    folder = run_folder(base)
    out = clean_tables(spark, raw, salt, folder, variant, order_by, rows_per_task)
    paths = write_tables(kpi_tables(out, variant, rows_per_task), folder)
    publish(spark, base, folder, [*out, *paths])
    return out | {name: read(spark, path) for name, path in paths.items()}
