"""Equi-joins between the four tables.

Bookings and payments should be tables stored with sketches of their frequent keys (`heavy.stored_with_sketches`); of
some of their columns, `heavy.narrowed` keeps these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.masking import packed_hash, unpacked_hash
from tarmac.operators.heavy import narrowed
from tarmac.operators.skew import join_many_to_many, join_one, left_join_many

# Customer columns carried into joined tables, as far as the table has them.
PASSENGER_COLUMNS = [
    "passenger_id", "age", "age_group", "gender", "birth_year",
    "first_name", "last_name", "first_name_masked", "last_name_masked",
]
# Values of the marks that tell rows of one key apart where these are spread. Two bytes differ from row to row, not eight.
MARKS = 1 << 16
# Hashes in bookings, which travel as bytes.
HASH_COLUMNS = ["passport_number", "emergency_contact_phone", "passport_hash", "emg_phone_hash"]


def bookings_with_flight(
    bookings: DataFrame, flights: DataFrame, rows_per_task: int = C.ROWS_PER_TASK
) -> DataFrame:
    """Flight ids are unique, so bookings keep their number; hot flights are spread."""
    return join_one(bookings, flights, "flight_id", "booking_id", rows_per_task=rows_per_task)


def with_payments(
    lines: DataFrame,
    payments: DataFrame,
    rows_per_task: int = C.ROWS_PER_TASK,
    sizes: DataFrame | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """One row per booking and payment; bookings without payment stay, with nulls.

    Where booking ids may repeat, `sizes` is the stored table that tells how often: both sides of an id are split then,
    lines by `spread_by` if it is given.
    """
    if sizes is None:
        return left_join_many(lines, payments, "booking_id", "payment_id", rows_per_task)
    return join_many_to_many(lines, payments, "booking_id", "payment_id", sizes, "left", rows_per_task, spread_by)


def with_passenger(
    lines: DataFrame,
    passengers: DataFrame,
    columns: list[str] | None = None,
    suffix: str = "_pax",
    sizes: DataFrame | None = None,
    rows_per_task: int = C.ROWS_PER_TASK,
    taken: list[str] | None = None,
) -> DataFrame:
    """Customer columns by id; names that exist on both sides (or in `taken`, if given) get the suffix."""
    keep = [c for c in (columns or PASSENGER_COLUMNS) if c in passengers.columns]
    side = passengers.select(
        *[
            F.col(c).alias(c + suffix) if c != "passenger_id" and c in (taken or lines.columns) else F.col(c)
            for c in keep
        ]
    )
    return join_one(lines, side, "passenger_id", "booking_id", sizes, rows_per_task=rows_per_task)


def master(
    bookings: DataFrame,
    flights: DataFrame,
    payments: DataFrame,
    passengers: DataFrame,
    rows_per_task: int = C.ROWS_PER_TASK,
    unique: bool = True,
) -> DataFrame:
    """Bookings with flight, payments and customer in one wide table.

    Flights and customers are joined while there is still one row per booking; payments, which
    multiply rows, come last. The columns are put in the order booking, flight, payment, customer.

    If `unique` is true, booking ids, flight ids and customers must be there once each, as cleaning leaves them. Flights and customers
    are then looked up by the ids alone, and the other columns of bookings travel once, for the join with payments.
    Otherwise all of them may repeat or be missing; bookings and payments with one id are then split on both sides.
    Hashes travel as bytes.
    """
    flight_columns = [c for c in flights.columns if c != "flight_id"]
    payment_columns = [c for c in payments.columns if c != "booking_id"]
    front = bookings.columns + flight_columns + payment_columns
    kinds = dict(bookings.dtypes)
    hashes = [c for c in HASH_COLUMNS if kinds.get(c) == "string"]
    packed = bookings
    for c in hashes:
        raw, text = packed_hash(F.col(c))
        packed = packed.withColumns({f"_{c}": raw, c: text})
    if unique:
        ids = narrowed(bookings, "booking_id", "passenger_id", "flight_id")
        taken = bookings.columns + flight_columns
        known = with_passenger(ids, passengers, rows_per_task=rows_per_task, taken=taken).drop("passenger_id")
        found = join_one(known, flights, "flight_id", "booking_id", bookings, rows_per_task=rows_per_task).drop("flight_id")
        wide = left_join_many(packed, payments, "booking_id", "payment_id", rows_per_task, found)
        extra = [c for c in known.columns if c not in front]
    else:
        # Lines are told apart by marks of what they are made of, so that columns nobody asks for need not travel.
        own = packed.withColumn("_booking", _mark(bookings))
        flown = join_one(own, flights, "flight_id", "booking_id", bookings, rows_per_task=rows_per_task)
        listed = passengers.withColumn("_listing", _mark(passengers))
        kept = [*PASSENGER_COLUMNS, "_listing"]
        one_each = with_passenger(flown, listed, kept, sizes=bookings, rows_per_task=rows_per_task)
        wide = with_payments(one_each, payments, rows_per_task, bookings, ["_booking", "_listing"])
        extra = [c for c in one_each.columns if c not in front and not c.startswith("_")]
    return wide.select(*[unpacked_hash(F.col(f"_{c}"), F.col(c)).alias(c) if c in hashes else F.col(c) for c in front], *extra)


def _mark(df: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*df.columns), F.lit(MARKS)).cast("int")


def paid_bookings(bookings: DataFrame, payments: DataFrame, rows_per_task: int = C.ROWS_PER_TASK) -> DataFrame:
    """Bookings that were paid, one row per payment; hot bookings are spread by payment."""
    paid = join_one(payments, bookings, "booking_id", "payment_id", how="inner", rows_per_task=rows_per_task)
    return paid.select(*bookings.columns, *[c for c in payments.columns if c != "booking_id"])


def with_carrier(
    lines: DataFrame,
    flights: DataFrame,
    columns: tuple[str, ...] = ("airline",),
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    side = flights.select("flight_id", *columns)
    return join_one(lines, side, "flight_id", "booking_id", rows_per_task=rows_per_task)


def passengers_with_revenue(
    passengers: DataFrame, bookings: DataFrame, payments: DataFrame, rows_per_task: int = C.ROWS_PER_TASK
) -> DataFrame:
    """Every customer with bookings and payments; customers without bookings stay."""
    booked = left_join_many(
        passengers, narrowed(bookings, "passenger_id", "booking_id"), "passenger_id", "booking_id", rows_per_task
    )
    paid = narrowed(payments, "payment_id", "booking_id", "amount")
    return with_payments(booked, paid, rows_per_task).drop("payment_id")


def bookings_with_revenue_and_passenger(
    bookings: DataFrame, payments: DataFrame, passengers: DataFrame, rows_per_task: int = C.ROWS_PER_TASK
) -> DataFrame:
    columns = ["passenger_id", "age", "age_group", "gender"]
    known = with_passenger(bookings, passengers, columns, rows_per_task=rows_per_task)
    return with_payments(known, payments, rows_per_task)


def revenue_with_flight_and_passenger(
    bookings: DataFrame,
    payments: DataFrame,
    flights: DataFrame,
    passengers: DataFrame,
    rows_per_task: int = C.ROWS_PER_TASK,
) -> DataFrame:
    flown = with_carrier(bookings, flights, ("airline", "route"), rows_per_task)
    columns = ["passenger_id", "gender", "age_group"]
    known = with_passenger(flown, passengers, columns, sizes=bookings, rows_per_task=rows_per_task)
    return with_payments(known, payments, rows_per_task)
