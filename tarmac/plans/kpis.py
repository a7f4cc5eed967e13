"""The twelve KPI tables.

Where bookings and payments are asked for, the stored facts of `facts.booking_facts` may be given as bookings.
`flights` is the table without the delay flag wherever delays are counted here; see
facts.delay_facts for how the flag is found without a second pass over the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.numeric import exact_mean, exact_sum, percent, round2
from tarmac.operators.aggregates import share_of_total
from tarmac.plans.facts import (
    booking_lines,
    collapse,
    delay_facts,
    minutes_sum,
    not_null,
    paid_mean,
    paid_total,
    with_flight_and_passenger,
)


def _delayed():
    return F.sum(F.col("is_delayed") * F.col("flights"))


def _rate(part, whole):
    return round2(percent(part, whole))


def route_traffic(flights: DataFrame) -> DataFrame:
    n = F.sum("flights")
    return (
        not_null(delay_facts(flights, []), "route")
        .groupBy("route")
        .agg(
            n.alias("flight_count"),
            F.try_divide(minutes_sum(), n.cast("double")).alias("avg_duration_mins"),
            round2(F.try_divide(_delayed().cast("double"), n.cast("double")) * 100).alias("delay_rate_pct"),
        )
        .orderBy(F.desc("flight_count"), "route")
    )


def avg_duration_by_airline(flights: DataFrame) -> DataFrame:
    minutes = F.col("duration_mins")
    return (
        not_null(flights, "airline")
        .groupBy("airline")
        .agg(
            exact_mean(minutes).alias("avg_duration_mins"),
            F.min(minutes).alias("min_duration_mins"),
            F.max(minutes).alias("max_duration_mins"),
        )
        .orderBy("airline")
    )


def avg_duration_by_route(flights: DataFrame) -> DataFrame:
    return (
        not_null(flights, "route")
        .groupBy("route")
        .agg(exact_mean(F.col("duration_mins")).alias("avg_duration_mins"))
        .orderBy("route")
    )


def airline_distribution(flights: DataFrame) -> DataFrame:
    """Market share of each carrier; the whole includes flights without a carrier."""
    counts = flights.groupBy("airline").agg(F.count(F.lit(1)).alias("flight_count"))
    return not_null(share_of_total(counts, "flight_count", "market_share_pct"), "airline").orderBy(
        F.desc("flight_count"), "airline"
    )


def delay_summary(flights: DataFrame) -> DataFrame:
    return (
        not_null(delay_facts(flights, ["airline", "is_overnight"]), "airline")
        .groupBy("airline")
        .agg(
            F.sum("flights").alias("total_flights"),
            _delayed().alias("delayed_flights"),
            F.sum(F.col("is_overnight") * F.col("flights")).alias("overnight_flights"),
        )
        .withColumn("delay_rate_pct", _rate(F.col("delayed_flights"), F.col("total_flights")))
        .orderBy("airline")
    )


def revenue_by_airline(bookings: DataFrame, payments: DataFrame, flights: DataFrame) -> DataFrame:
    """Paid bookings only; payments without a known carrier are left out. Bookings that know their carrier join no flights."""
    if "airline" in bookings.columns:
        return _revenue(not_null(booking_lines(bookings, payments, ["airline"]), "airline").filter("paid_rows IS NOT NULL"))
    paid = booking_lines(bookings, payments, ["flight_id"]).filter(F.col("paid_rows").isNotNull())
    per_flight = collapse(paid, "flight_id")
    return _revenue(per_flight.join(not_null(flights.select("flight_id", "airline"), "airline"), "flight_id"))


def _revenue(flown: DataFrame) -> DataFrame:
    return (
        flown.groupBy("airline")
        .agg(
            paid_total().alias("total_revenue"),
            F.sum("paid_rows").alias("total_bookings"),
            paid_mean().alias("avg_ticket_value"),
        )
        .orderBy(F.desc("total_revenue"), "airline")
    )


def departure_slots(flights: DataFrame) -> DataFrame:
    return (
        not_null(delay_facts(flights, ["departure_slot"]), "departure_slot")
        .groupBy("departure_slot")
        .agg(F.sum("flights").alias("flight_count"), _delayed().alias("delayed_flights"))
        .withColumn("delay_rate_pct", _rate(F.col("delayed_flights"), F.col("flight_count")))
        .orderBy("departure_slot")
    )


def booking_status(bookings: DataFrame) -> DataFrame:
    counts = bookings.groupBy("status").agg(F.count(F.lit(1)).alias("booking_count"))
    return not_null(share_of_total(counts, "booking_count", "percentage"), "status").orderBy(
        F.desc("booking_count"), "status"
    )


def payment_methods(payments: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return (
        not_null(payments, "payment_method")
        .groupBy("payment_method")
        .agg(
            F.count("payment_id").alias("transaction_count"),
            exact_sum(amount).alias("total_amount"),
            exact_mean(amount).alias("avg_amount"),
        )
        .orderBy("payment_method")
    )


def spend_per_passenger(passengers: DataFrame, bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """Every customer with the number of booking rows and what was paid; zero without bookings."""
    lines = collapse(booking_lines(bookings, payments, ["passenger_id"]), "passenger_id")
    return passengers.join(lines, "passenger_id", "left").withColumn(
        "line_rows", F.coalesce("line_rows", F.lit(0))
    )


def passenger_demographics(passengers: DataFrame, bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """Customer ids are unique here, so rows are customers."""
    people = passengers.select("passenger_id", "gender", "age_group")
    return (
        not_null(spend_per_passenger(people, bookings, payments), "gender", "age_group")
        .groupBy("gender", "age_group")
        .agg(
            F.count("passenger_id").alias("passenger_count"),
            F.sum("line_rows").alias("total_bookings"),
            paid_total().alias("total_spend"),
        )
        .orderBy("gender", "age_group")
    )


def frequent_flyers(passengers: DataFrame, bookings: DataFrame, payments: DataFrame, top: int = C.TOP_FLYERS) -> DataFrame:
    names = ["passenger_id", "first_name", "last_name", "age_group"]
    return (
        not_null(spend_per_passenger(passengers.select(*names), bookings, payments), *names)
        .select(
            *names,
            F.col("line_rows").alias("total_bookings"),
            F.coalesce(F.col("paid").cast("double"), F.lit(0.0)).alias("total_spend"),
        )
        .orderBy(F.desc("total_bookings"), F.desc("total_spend"), "passenger_id")
        .limit(top)
    )


def airline_passenger_demographics(
    bookings: DataFrame,
    flights: DataFrame,
    payments: DataFrame,
    passengers: DataFrame,
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """Customers and revenue per carrier, gender and age group; unmatched bookings have no
    group and are left out, so inner joins are enough. Bookings that know their carrier join no flights."""
    keys = ["airline", "gender", "age_group"]
    flown = "airline" in bookings.columns
    lines = booking_lines(bookings, payments, ["passenger_id", "airline" if flown else "flight_id"])
    known = with_flight_and_passenger(
        not_null(lines, "airline") if flown else lines,
        bookings,
        None if flown else flights.select("flight_id", "airline"),
        passengers.select("passenger_id", "gender", "age_group"),
        "inner",
        rows_per_task,
    )
    return (
        not_null(known, *keys)
        .groupBy(*keys)
        .agg(F.countDistinct("passenger_id").alias("passenger_count"), paid_total().alias("revenue"))
        .orderBy(*keys)
    )
