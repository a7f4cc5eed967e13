"""How many rows each cleaning step removes, read from the cleaning itself.

One pass per table brings all rows of a key together as sums: its rows, those that are complete, the different ones among
these, and the first of them in the cleaner's order. It is stored, and both the clean table and the counts are read
from it. Equal rows are counted before they travel, so copies of one key cost nothing.

Counts are queries over that table instead of counters inside a job: counters count twice when a
lost executor makes a stage run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac import schemas
from tarmac.functions import temporal, text
from tarmac.plans import clean
from tarmac.session import stored

STEP_SCHEMA = "position int, step string, rows_in bigint, dropped bigint"


@dataclass(frozen=True)
class Audited:
    """A clean table and the rows that each of its steps got and dropped, from one stored pass."""

    clean: DataFrame
    steps: DataFrame


def _by_key(df: DataFrame, key: str, names: list[str], order_by: list[str] | None, valid: dict[str, Column]) -> DataFrame:
    """Per key the rows that are left after each of the conditions (`rows`, then their names), the different rows among the
    last of these (`different`), and `first`. Names are those of the columns that make rows equal."""
    rest = [c for c in names if c != key]
    marks, so_far = {}, F.lit(True)
    for name, condition in valid.items():
        so_far = so_far & condition
        marks[name] = F.coalesce(so_far, F.lit(False))
    marked = df.select("*", *[c.alias(n) for n, c in marks.items()])
    at = F.min(F.struct(*order_by)) if order_by else F.lit(0)
    copies = marked.groupBy(*names, *marks).agg(F.count(F.lit(1)).alias("n"), at.alias("_at"))
    last = F.col(list(marks)[-1]) if marks else F.lit(True)
    count = lambda mark: F.coalesce(F.sum(F.when(mark, F.col("n"))), F.lit(0))
    per_key = copies.groupBy(key).agg(
        F.sum("n").alias("rows"),
        *[count(F.col(m)).alias(m) for m in marks],
        F.count_if(last).alias("different"),
        F.min(F.when(last, F.struct("_at", *rest))).alias("first"),
    )
    return stored(per_key, "audited")


def _steps(df: DataFrame, left: dict[str, Column], rows: Column) -> DataFrame:
    """Rows in and dropped by step; `left` has what is left after each step."""
    sums = df.agg(rows.alias("_0"), *[F.coalesce(c, F.lit(0)).alias(f"_{i}") for i, c in enumerate(left.values(), 1)])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(step).alias("step"),
            F.col(f"_{i - 1}").cast("bigint").alias("rows_in"),
            (F.col(f"_{i - 1}") - F.col(f"_{i}")).cast("bigint").alias("dropped"),
        )
        for i, step in enumerate(left, 1)
    ]
    return sums.select(F.inline(F.array(*lines))).orderBy("position")


def _rows_of(per_key: DataFrame) -> Column:
    return F.coalesce(F.sum("rows"), F.lit(0))


def _firsts(per_key: DataFrame, names: list[str], key: str) -> DataFrame:
    found = per_key.filter(F.col("first").isNotNull())
    return found.select(*[F.col(c) if c == key else F.col(f"first.{c}").alias(c) for c in names])


def flights(
    raw: DataFrame, variant: str = "script", order_by: list[str] | None = None, strict: bool = False
) -> Audited:
    """Clean flights without the delay flag, as `clean.flights_without_delay` has them, and their steps."""
    names = schemas.FLIGHTS.fieldNames()
    valid = {"text": F.col("_has_text")} if strict else {}
    valid["complete"] = F.col("departure_time").isNotNull() & F.col("arrival_time").isNotNull()
    per_key = _by_key(clean.prepared_flights(raw, order_by), "flight_id", names, order_by, valid)
    departure, arrival = F.col("first.departure_time"), F.col("first.arrival_time")
    carrier = text.impute_carrier(F.col("first.airline"), F.col("flight_id"))
    minutes = temporal.duration_minutes(departure, arrival)
    unique = F.col("first").isNotNull()
    forward = unique & (arrival > departure)
    named = forward & ~carrier.isin(C.CARRIER_PLACEHOLDERS) if variant == "script" else forward
    in_range = named & (minutes > 0) & (minutes <= C.MAX_JOURNEY_MINUTES)
    left = {"null_text": F.sum("text")} if strict else {}
    left |= {
        "null_times": F.sum("complete"),
        "duplicate_rows": F.sum("different"),
        "duplicate_ids": F.count_if(unique),
        "invalid_interval": F.count_if(forward),
    }
    if variant == "script":
        left["unresolved_carrier"] = F.count_if(named)
    left["duration_range"] = F.count_if(in_range)
    tidy = clean.finished_flights(_firsts(per_key, names, "flight_id"), variant)
    return Audited(tidy, _steps(per_key, left, _rows_of(per_key)))


def flight_steps(raw: DataFrame) -> DataFrame:
    """Rows in and rows dropped for every step of flight cleaning, in order."""
    return flights(raw).steps


def bookings(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> Audited:
    ready = clean.prepared_bookings(raw, variant, order_by)
    return _keyed("booking_id", schemas.BOOKINGS.fieldNames(), ready, clean.finished_bookings, variant, order_by)


def passengers(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> Audited:
    ready = clean.prepared_passengers(raw, variant, order_by)
    return _keyed("passenger_id", schemas.PASSENGERS.fieldNames(), ready, clean.finished_passengers, variant, order_by)


def payments(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> Audited:
    ready = clean.prepared_payments(raw, variant, order_by)
    needed = {"null_amount": F.col("amount").isNotNull()}
    return _keyed("payment_id", schemas.PAYMENTS.fieldNames(), ready, clean.finished_payments, variant, order_by, needed)


def _keyed(key, names, ready, finish, variant, order_by, needed: dict[str, Column] | None = None) -> Audited:
    """Tables whose steps are missing values, equal rows and, in the script variant, equal ids."""
    needed = needed or {}
    if variant == "script":
        per_key = _by_key(ready, key, names, order_by, needed)
        left = {step: F.sum(step) for step in needed}
        left |= {"duplicate_rows": F.sum("different"), "duplicate_ids": F.count_if(F.col("first").isNotNull())}
        return Audited(finish(_firsts(per_key, names, key), variant), _steps(per_key, left, _rows_of(per_key)))
    there = F.lit(True)
    for condition in needed.values():
        there = there & condition
    copies = ready.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))
    copies = stored(copies.withColumn("_there", there), "audited")
    left = {step: F.sum(F.when(F.col("_there"), F.col("rows"))) for step in needed}
    left["duplicate_rows"] = F.count_if("_there")
    return Audited(finish(copies.filter("_there").select(*names), variant), _steps(copies, left, _rows_of(copies)))


AUDITS = {"flights": flights, "bookings": bookings, "passengers": passengers, "payments": payments}


def raw_and_clean_counts(raw: dict[str, DataFrame], clean: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table before and after cleaning."""
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.lit(1 if kind == "raw" else 0).alias("raw"),
            F.lit(1 if kind == "clean" else 0).alias("clean"),
        )
        for kind, tables in (("raw", raw), ("clean", clean))
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return (
        out.groupBy("table_name")
        .agg(F.sum("raw").alias("raw_rows"), F.sum("clean").alias("clean_rows"))
        .orderBy("table_name")
    )
