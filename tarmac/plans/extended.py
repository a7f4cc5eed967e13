"""Extended reports: the notebook variant of the KPI tables, with every figure rounded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.numeric import exact_mean, exact_sum, in_hours, percent, round2
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


def _duration_stats(flights: DataFrame, key: str) -> DataFrame:
    minutes = F.col("duration_mins")
    return not_null(flights, key).groupBy(key).agg(
        F.count(minutes).alias("flight_count"),
        round2(exact_mean(minutes)).alias("avg_duration_mins"),
        round2(F.min(minutes)).alias("min_duration_mins"),
        round2(F.max(minutes)).alias("max_duration_mins"),
    )


def avg_by_airline(flights: DataFrame) -> DataFrame:
    return (
        _duration_stats(flights, "airline")
        .select("airline", "avg_duration_mins", "min_duration_mins", "max_duration_mins", "flight_count")
        .orderBy(F.desc("avg_duration_mins"), "airline")
    )


def avg_by_route(flights: DataFrame) -> DataFrame:
    return (
        _duration_stats(flights, "route")
        .select("route", "avg_duration_mins", "flight_count")
        .orderBy(F.desc("avg_duration_mins"), "route")
    )


def _delay_counts(flights: DataFrame, key: str):
    facts = not_null(delay_facts(flights, [key, "is_overnight"]), key)
    n = F.col("flights")
    return facts.groupBy(key).agg(
        F.sum(n).alias("n"),
        round2(F.try_divide(minutes_sum(), F.sum(n).cast("double"))).alias("avg_duration"),
        F.sum(F.col("is_delayed") * n).alias("delayed_flights"),
        F.sum(F.col("is_overnight") * n).alias("overnight_flights"),
    ).withColumn("delay_rate_%", round2(percent(F.col("delayed_flights"), F.col("n"))))


def route_traffic(flights: DataFrame) -> DataFrame:
    return (
        _delay_counts(flights, "route")
        .withColumnRenamed("n", "flight_count")
        .select("route", "flight_count", "avg_duration", "delayed_flights", "overnight_flights", "delay_rate_%")
        .orderBy(F.desc("flight_count"), "route")
    )


def delay_summary(flights: DataFrame) -> DataFrame:
    return (
        _delay_counts(flights, "airline")
        .select(
            "airline",
            F.col("n").alias("total_flights"),
            "delayed_flights",
            F.col("overnight_flights").alias("overnight_count"),
            "delay_rate_%",
        )
        .orderBy("airline")
    )


def airline_distribution(flights: DataFrame) -> DataFrame:
    """Shares among the listed carriers only."""
    return (
        share_of_total(_duration_stats(flights, "airline"), "flight_count", "market_share_%")
        .orderBy(F.desc("flight_count"), "airline")
    )


def revenue_by_airline(bookings: DataFrame, payments: DataFrame, flights: DataFrame) -> DataFrame:
    per_flight = collapse(booking_lines(bookings, payments, ["flight_id"]), "flight_id")
    return (
        per_flight.join(not_null(flights.select("flight_id", "airline"), "airline"), "flight_id")
        .groupBy("airline")
        .agg(
            round2(paid_total()).alias("total_revenue"),
            round2(paid_mean()).alias("avg_ticket_price"),
            F.coalesce(F.sum("paid_rows"), F.lit(0)).alias("bookings_with_payment"),
        )
        .orderBy(F.desc("total_revenue"), "airline")
    )


def slot_traffic(flights: DataFrame) -> DataFrame:
    return (
        not_null(flights, "departure_slot")
        .groupBy("departure_slot")
        .agg(F.count("flight_id").alias("flight_count"))
        .orderBy("departure_slot")
    )


def booking_status(bookings: DataFrame) -> DataFrame:
    return (
        not_null(bookings, "status").groupBy("status").agg(F.count("booking_id").alias("count")).orderBy("status")
    )


def payment_method(payments: DataFrame) -> DataFrame:
    return (
        not_null(payments, "payment_method")
        .groupBy("payment_method")
        .agg(F.count("amount").alias("count"), round2(exact_sum(F.col("amount"))).alias("sum"))
        .orderBy("payment_method")
    )


def _people(passengers: DataFrame) -> DataFrame:
    """Customers by id and group with the number of their rows, as this variant keeps customers
    that are listed more than once; each listing multiplies the booking rows."""
    keys = ["passenger_id", "gender", "age_group"]
    return not_null(passengers, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def _times_copies(lines: DataFrame) -> DataFrame:
    sums = [c for c in ("line_rows", "paid_rows", "paid", "confirmed") if c in lines.columns]
    return lines.withColumns({c: F.col(c) * F.col("copies") for c in sums})


def passenger_demographics(bookings: DataFrame, payments: DataFrame, passengers: DataFrame) -> DataFrame:
    """From the bookings' side: customers with bookings only."""
    lines = collapse(booking_lines(bookings, payments, ["passenger_id"]), "passenger_id")
    return (
        _times_copies(lines.join(_people(passengers), "passenger_id"))
        .groupBy("gender", "age_group")
        .agg(
            F.countDistinct("passenger_id").alias("total_passengers"),
            F.sum("line_rows").alias("total_bookings"),
            round2(paid_total()).alias("total_revenue"),
            round2(paid_mean()).alias("avg_spend"),
        )
        .orderBy("gender", "age_group")
    )


def frequent_flyers(bookings: DataFrame, payments: DataFrame, passengers: DataFrame) -> DataFrame:
    """All travellers, most bookings first, with their confirmed bookings."""
    confirmed = F.sum(F.when(F.col("status") == "CONFIRMED", F.col("line_rows")).otherwise(0))
    lines = collapse(
        booking_lines(bookings, payments, ["passenger_id", "status"]), "passenger_id", extra={"confirmed": confirmed}
    )
    keys = ["passenger_id", "gender", "age_group"]
    return (
        _times_copies(lines.join(_people(passengers), "passenger_id"))
        .groupBy(*keys)
        .agg(
            F.sum("line_rows").alias("total_bookings"),
            F.sum("confirmed").alias("confirmed_bookings"),
            round2(paid_total()).alias("total_spend"),
            round2(paid_mean()).alias("avg_spend_per_booking"),
        )
        .orderBy(F.desc("total_bookings"), F.desc("total_spend"), "passenger_id", "gender", "age_group")
    )


def airline_passenger_demographics(
    bookings: DataFrame,
    payments: DataFrame,
    flights: DataFrame,
    passengers: DataFrame,
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    keys = ["airline", "gender", "age_group"]
    known = with_flight_and_passenger(
        booking_lines(bookings, payments, ["passenger_id", "flight_id"]),
        bookings,
        flights.select("flight_id", "airline"),
        _people(passengers),
        "inner",
        rows_per_task,
    )
    return (
        _times_copies(not_null(known, "airline"))
        .groupBy(*keys)
        .agg(
            F.sum("line_rows").alias("booking_count"),
            F.countDistinct("passenger_id").alias("passenger_count"),
            round2(paid_total()).alias("total_revenue"),
            round2(paid_mean()).alias("avg_revenue"),
        )
        .orderBy(*keys)
    )


def global_kpis(flights: DataFrame) -> DataFrame:
    n = F.col("flights")
    total = F.sum(n)
    mean = F.try_divide(minutes_sum(), total.cast("double"))
    delayed = F.coalesce(F.sum(F.col("is_delayed") * n), F.lit(0))
    return delay_facts(flights, ["airline", "is_overnight"]).agg(
        mean.alias("avg_duration_mins"),
        in_hours(mean).alias("avg_duration_hours"),
        delayed.alias("total_delayed"),
        F.coalesce(F.sum(F.col("is_overnight") * n), F.lit(0)).alias("total_overnight"),
        percent(delayed, total).alias("delay_rate_pct"),
        F.countDistinct("route").alias("unique_routes"),
        F.countDistinct("airline").alias("active_airlines"),
    )
