"""Report measures and chart tables over the joined data.

Measures are defined on booking lines: one row per booking (and payment method where needed)
that stands for `line_rows` rows of the wide table. Only the tables a measure asks for are
joined, and the payments are added up before the first join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions import text
from tarmac.functions.numeric import cents, divide_or_zero, typed_double
from tarmac.operators.aggregates import share_of_total, shares_of_total, value_counts
from tarmac.operators.filters import fill_strings, slice_by
from tarmac.plans import kpis
from tarmac.plans.facts import booking_lines, delay_facts, not_null, paid_total, with_flight_and_passenger


def _label(column: str) -> Column:
    """Report spelling of one text column; a missing value gets a name."""
    c = F.col(column)
    if column == "airline":
        spelled = text.map_values(F.coalesce(c, F.lit(C.UNKNOWN_LABEL)), C.CARRIER_SPELLING)
        return text.impute_carrier_for_report(spelled, F.col("flight_id"))
    if column == "payment_method":
        return text.map_values(F.coalesce(c, F.lit(C.DEFAULT_PAYMENT_LABEL)), C.PAYMENT_LABEL)
    if column == "status":
        return text.collapse_status(text.norm_upper(c))
    return text.strip(F.coalesce(c.cast("string"), F.lit(C.UNKNOWN_LABEL)))


def normalise(wide: DataFrame) -> DataFrame:
    """The wide table in report spelling, numbers and text without missing values."""
    labels = {c: _label(c) for c in ("airline", "status", "payment_method")}
    numbers = {"amount": "double", "duration_mins": "double", "is_delayed": "int", "is_overnight": "int", "age": "int"}
    zeros = {c: F.coalesce(typed_double(F.col(c)), F.lit(0.0)).cast(kind) for c, kind in numbers.items()}
    return fill_strings(wide.withColumns(labels | zeros))


#: What slicers choose, by column: a value, a list of values, or a (from, to) pair.
Slicers = dict[str, object]


def owned(slicers: Slicers, **tables: DataFrame) -> dict[str, Slicers]:
    """The slicers of each table: a column belongs to the first table that has it."""
    out: dict[str, Slicers] = {name: {} for name in tables}
    for column, choice in slicers.items():
        owner = next((name for name, df in tables.items() if column in df.columns), None)
        if owner is None:
            raise ValueError(f"no table has the column {column}")
        out[owner][column] = choice
    return out


def report_lines(
    bookings: DataFrame,
    flights: DataFrame,
    payments: DataFrame,
    passengers: DataFrame,
    columns: set[str],
    rows_per_task: int = C.ROWS_PER_TASK,
    slicers: Slicers | None = None,
) -> DataFrame:
    """Booking lines with the given columns, joining only the tables that have them.

    Each slicer filters the table that owns its column before anything is joined. It compares clean values, not report
    spelling; a missing value is in no choice, so lines without a row of a sliced table go.
    """
    also = ("payment_method",) if "payment_method" in columns else ()
    chosen = owned(slicers or {}, bookings=bookings, flights=flights, passengers=passengers, payments=payments)
    own = [c for c in bookings.columns if c in columns or c in ("flight_id", "passenger_id")]
    flown = [c for c in flights.columns if c in columns and c not in bookings.columns]
    personal = [c for c in passengers.columns if c in columns and c not in bookings.columns]
    if chosen["payments"]:
        paying = slice_by(payments, chosen["payments"])
        plain = bookings.select(*[c for c in bookings.columns if c not in ("paid_rows", "paid", "line_rows")])
        lines = booking_lines(slice_by(plain, chosen["bookings"]), paying, own, also).filter(F.col("paid_rows").isNotNull())
    else:
        lines = booking_lines(slice_by(bookings, chosen["bookings"]), payments, own, also)
    ways = ["inner" if chosen[name] else "left" for name in ("flights", "passengers")]
    return with_flight_and_passenger(
        lines,
        bookings,
        slice_by(flights, chosen["flights"]).select("flight_id", *flown) if flown or chosen["flights"] else None,
        slice_by(passengers, chosen["passengers"]).select("passenger_id", *personal)
        if personal or chosen["passengers"]
        else None,
        (ways[0], ways[1]),
        rows_per_task,
    )


def _rows(condition: Column | None = None) -> Column:
    n = F.col("line_rows") if condition is None else F.when(condition, F.col("line_rows"))
    return F.coalesce(F.sum(n), F.lit(0))


def _mean(column: str, zero_fill: bool = False) -> Column:
    value = F.coalesce(F.col(column), F.lit(0.0)) if zero_fill else F.col(column)
    if zero_fill and column == "age":
        value = value.cast("int")
    total = F.sum(cents(value) * F.col("line_rows")).cast("double")
    return F.try_divide(total, F.sum(F.when(value.isNotNull(), F.col("line_rows"))).cast("double"))


@dataclass(frozen=True)
class Measure:
    needs: frozenset[str]
    value: Callable[[], Column]


def _measure(value: Callable[[], Column], *needs: str) -> Measure:
    return Measure(frozenset(needs), value)


def _share(condition: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: divide_or_zero(_rows(condition()), _rows()) * 100


def _delayed() -> Column:
    return F.col("is_delayed") == 1


def _overnight() -> Column:
    return F.col("is_overnight") == 1


MEASURES: dict[str, Measure] = {
    "total_flights": _measure(lambda: F.countDistinct("flight_id")),
    "total_bookings": _measure(_rows),
    "total_revenue": _measure(paid_total),
    "avg_duration": _measure(lambda: _mean("duration_mins"), "duration_mins"),
    "avg_duration_zero_filled": _measure(lambda: _mean("duration_mins", True), "duration_mins"),
    "delayed_flights": _measure(lambda: _rows(_delayed()), "is_delayed"),
    "overnight_flights": _measure(lambda: _rows(_overnight()), "is_overnight"),
    "unique_passengers": _measure(lambda: F.countDistinct("passenger_id")),
    "avg_age": _measure(lambda: _mean("age"), "age"),
    "avg_age_zero_filled": _measure(lambda: _mean("age", True), "age"),
    "delay_rate": _measure(_share(_delayed), "is_delayed"),
    "overnight_pct": _measure(_share(_overnight), "is_overnight"),
    "spend_per_passenger": _measure(lambda: divide_or_zero(paid_total(), F.countDistinct("passenger_id"))),
    "confirmation_rate": _measure(_share(lambda: F.col("status") == "CONFIRMED"), "status"),
}


def needs_delay_flag(names: list[str]) -> bool:
    return any("is_delayed" in MEASURES[n].needs for n in names)


def measures(
    bookings: DataFrame,
    flights: DataFrame,
    payments: DataFrame,
    passengers: DataFrame,
    names: list[str],
    by: str | None = None,
    rows_per_task: int = C.ROWS_PER_TASK,
    slicers: Slicers | None = None,
) -> DataFrame:
    """The named measures over everything that the slicers leave, or per value of one column in report spelling."""
    columns = set().union(*(MEASURES[n].needs for n in names)) | ({by} if by else set())
    lines = report_lines(bookings, flights, payments, passengers, columns, rows_per_task, slicers)
    values = [MEASURES[n].value().alias(n) for n in names]
    if by is None:
        return lines.agg(*values)
    # The label has a name of its own: measures may read the column that it is made from.
    labelled = lines.withColumn("_label", _label(by)).groupBy("_label").agg(*values)
    return labelled.withColumnRenamed("_label", by).orderBy(by)


def daily_volume(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy(F.to_date("departure_time").alias("departure_date"))
        .agg(F.count(F.lit(1)).alias("flight_count"))
        .orderBy("departure_date")
    )


def top_routes(bookings, flights, payments, passengers, top: int = C.TOP_ROUTES) -> DataFrame:
    """Busiest routes by rows of the wide table; bookings without a flight count as Unknown."""
    lines = report_lines(bookings, flights, payments, passengers, {"route"})
    return value_counts(lines.withColumn("route", _label("route")), "route", "row_count", F.col("line_rows")).limit(top)


def revenue_by_airline(bookings, flights, payments, passengers) -> DataFrame:
    return measures(bookings, flights, payments, passengers, ["total_revenue"], "airline").orderBy(
        F.desc("total_revenue"), "airline"
    )


def payment_split(bookings, flights, payments, passengers) -> DataFrame:
    """Share of each payment label by rows and by revenue."""
    split = measures(bookings, flights, payments, passengers, ["total_bookings", "total_revenue"], "payment_method")
    split = split.select("payment_method", F.col("total_bookings").alias("row_count"), "total_revenue")
    shares = {"row_share_pct": "row_count", "revenue_share_pct": "total_revenue"}
    return shares_of_total(split, shares).orderBy("payment_method")


def delayed_vs_ontime(flights: DataFrame) -> DataFrame:
    n, late = F.col("flights"), F.col("is_delayed")
    return (
        not_null(delay_facts(flights, ["airline"]), "airline")
        .groupBy("airline")
        .agg(F.sum(late * n).alias("delayed_flights"), F.sum((1 - late) * n).alias("on_time_flights"))
        .orderBy("airline")
    )


def overnight_by_airline(flights: DataFrame) -> DataFrame:
    return (
        not_null(flights, "airline")
        .groupBy("airline")
        .agg(F.sum("is_overnight").alias("overnight_flights"))
        .orderBy("airline")
    )


def worst_route(flights: DataFrame) -> DataFrame:
    return (
        kpis.route_traffic(flights)
        .orderBy(F.desc("delay_rate_pct"), "route")
        .select("route", "flight_count", "delay_rate_pct")
        .limit(1)
    )


def age_group_revenue(passengers: DataFrame, bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """Bookings and revenue for each age group in display order, zero where there are none."""
    per_group = (
        kpis.spend_per_passenger(passengers.select("passenger_id", "age_group"), bookings, payments)
        .groupBy("age_group")
        .agg(F.sum("line_rows").alias("total_bookings"), paid_total().alias("total_revenue"))
    )
    listed = passengers.sparkSession.createDataFrame(
        list(enumerate(C.AGE_GROUPS)), "position int, age_group string"
    )
    return (
        listed.join(per_group, "age_group", "left")
        .select(
            "position",
            "age_group",
            F.coalesce("total_bookings", F.lit(0)).alias("total_bookings"),
            F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        )
        .orderBy("position")
    )


def gender_split(passengers: DataFrame) -> DataFrame:
    return share_of_total(value_counts(passengers, "gender", "passenger_count"), "passenger_count", "share_pct").orderBy(
        F.desc("passenger_count"), "gender"
    )
