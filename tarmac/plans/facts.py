"""Compact intermediate tables that the reports are computed from.

They replace row-level joins: payments collapse to one row per booking before anything is
joined, and flights collapse to counts per duration before route means are compared, so no hot
booking, flight, customer or route ever travels through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.numeric import cents, flag
from tarmac.operators.skew import join_one


def delay_facts(flights: DataFrame, dims: list[str]) -> DataFrame:
    """Flights counted by route, duration, the given columns and delay.

    Durations have two decimals and at most 1440 minutes, so a route has at most 144,000
    different ones: the window below sees that many rows per route and combination of `dims`,
    however many flights there are. A table that already has the delay flag needs no counting.
    """
    keys = list(dict.fromkeys(["route", "duration_mins", *dims]))
    if "is_delayed" in flights.columns:
        return flights.select(*keys, "is_delayed", F.lit(1).alias("flights"))
    counted = flights.groupBy(*keys).agg(F.count(F.lit(1)).alias("flights"))
    route = Window.partitionBy("route")
    total = F.sum(cents(F.col("duration_mins")) * F.col("flights")).over(route)
    mean = total.cast("double") / F.sum("flights").over(route).cast("double")
    late = F.col("route").isNotNull() & (F.col("duration_mins") > mean * C.DELAY_FACTOR)
    return counted.withColumn("is_delayed", flag(late))


def minutes_sum() -> Column:
    """Total minutes over rows of delay_facts, independent of row order."""
    return F.sum(cents(F.col("duration_mins")) * F.col("flights")).cast("double")


def payment_facts(payments: DataFrame) -> DataFrame:
    """Number and sum of payments for every booking and method. Stored, it takes the place of the payments in what follows."""
    return payments_per_booking(payments, ("payment_method",))


def payments_per_booking(payments: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Number and sum of payments for every booking (and further columns), from payments or their facts."""
    counted = "paid_rows" in payments.columns
    number = F.sum("paid_rows") if counted else F.count(F.lit(1))
    amount = F.col("paid") if counted else cents(F.col("amount"))
    return payments.groupBy("booking_id", *also).agg(number.alias("paid_rows"), F.sum(amount).alias("paid"))


def booking_facts(
    bookings: DataFrame, payments: DataFrame, unique: bool = True, rows_per_task: int = C.ROWS_PER_TASK
) -> DataFrame:
    """Bookings with what was paid for them. Stored, it takes the place of bookings and payments in the reports, which then
    join nothing by booking.

    Where booking ids may repeat (`unique` is false), bookings are a stored table and a frequent id is spread over parts.
    """
    sums = payments_per_booking(payments)
    if unique:
        paid = bookings.join(sums, "booking_id", "left")
    else:
        # Rows are spread by all that they have: those of one id differ.
        paid = join_one(bookings, sums, "booking_id", "", how="left", rows_per_task=rows_per_task)
    return paid.withColumn("line_rows", F.coalesce("paid_rows", F.lit(1)))


def booking_lines(
    bookings: DataFrame,
    payments: DataFrame,
    keep: list[str],
    also: tuple[str, ...] = (),
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """Bookings with what was paid; `line_rows` is the number of rows a plain left join would give.

    Given stored facts instead of bookings, nothing is joined unless lines are wanted by payment method. Bookings that
    know the sketch of their ids are split by it, as ids may repeat; sums have one row per id and method.
    """
    if "line_rows" in bookings.columns and not also:
        return bookings.select("booking_id", *keep, "paid_rows", "paid", "line_rows")
    sums = payments_per_booking(payments, also)
    own = bookings.select("booking_id", *keep)
    if "booking_id" in getattr(bookings, "heavy_keys_at", {}):
        paid = join_one(own, sums, "booking_id", "", bookings, rows_per_task=rows_per_task)
    else:
        paid = own.join(sums, "booking_id", "left")
    return paid.withColumn("line_rows", F.coalesce("paid_rows", F.lit(1)))


def with_flight_and_passenger(
    lines: DataFrame,
    bookings: DataFrame,
    flights: DataFrame | None,
    passengers: DataFrame | None,
    how: str | tuple[str, str] = "left",
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    """Booking lines with columns of flight and customer, hot flights and customers spread.

    Booking lines are one per booking, but for a few payment methods, so the stored bookings
    tell which keys are hot. `how` is for both joins, or for each.
    """
    to_flight, to_passenger = (how, how) if isinstance(how, str) else how
    if flights is not None:
        lines = join_one(lines, flights, "flight_id", "booking_id", bookings, to_flight, rows_per_task)
    if passengers is not None:
        lines = join_one(lines, passengers, "passenger_id", "booking_id", bookings, to_passenger, rows_per_task)
    return lines


def collapse(lines: DataFrame, *keys: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """Booking lines added up by key."""
    return lines.groupBy(*keys).agg(
        F.sum("line_rows").alias("line_rows"),
        F.sum("paid_rows").alias("paid_rows"),
        F.sum("paid").alias("paid"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def paid_total() -> Column:
    return F.coalesce(F.sum("paid").cast("double"), F.lit(0.0))


def paid_mean() -> Column:
    return F.try_divide(F.sum("paid").cast("double"), F.sum("paid_rows").cast("double"))


def not_null(df: DataFrame, *keys: str) -> DataFrame:
    """Groups with a missing key are left out of every report."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df
