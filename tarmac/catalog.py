"""Every operator as a query over the driver's tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac import schemas
from tarmac.functions import masking, numeric, temporal, text
from tarmac.operators import aggregates, dedup, filters, joins
from tarmac.operators.heavy import narrowed, stored_with_sketches
from tarmac.operators.skew import group_mean, left_join_many
from tarmac.plans import audit, clean, extended, kpis, members, refresh, report
from tarmac.roles import PAYMENT_ORDER, TABLE_SCHEMAS, TEST_SALT, Roles
from tarmac.session import fresh_folder, stored
from tarmac.sources import readers, sorted_files, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Untidy text made from the event type: blanks around it, mixed case, missing values.
UNTIDY = [
    "event_id",
    "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 0 THEN '' WHEN event_id % 3 = 0"
    " THEN chr(9) || ' ' || event_type || ' ' || chr(10) ELSE upper(event_type) END AS raw",
    "CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 13 = 0 THEN 'NaN' WHEN event_id % 17 = 0 THEN '1,000'"
    " WHEN event_id % 19 = 0 THEN '12d' ELSE ' ' || cast(event_id AS string) || '.25' END AS raw_number",
    "CASE WHEN event_id % 9 = 0 THEN 'soon' WHEN event_id % 10 = 0 THEN NULL"
    " ELSE cast(cast(ts AS date) AS string) || ' 07:30:00' END AS raw_time",
]
# Carriers and flight ids of all kinds, one per event.
CARRIERS = [
    "event_id",
    "CASE event_type WHEN 'view' THEN 'UNKNOWN' WHEN 'click' THEN 'INDIGO' WHEN 'error' THEN 'NAN'"
    " WHEN 'signup' THEN '' ELSE 'UNKNOWN' END AS airline",
    "CASE user_id % 7 WHEN 0 THEN 'AI' WHEN 1 THEN 'SJ' WHEN 2 THEN '6F' WHEN 3 THEN 'UK' WHEN 4 THEN 'G8'"
    " WHEN 5 THEN 'ai' ELSE 'XX' END || cast(event_id AS string) AS flight_id",
]


def query(name: str, variant: str = "script"):
    def register(build: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Roles(spark, folder, variant))
        return build

    return register


def _events(r: Roles, *projection: str) -> DataFrame:
    return r.table("events").selectExpr(*projection)


def _untidy(r: Roles) -> DataFrame:
    return _events(r, *UNTIDY)


def _per_event(r: Roles, value, name: str = "value") -> DataFrame:
    return _untidy(r).select("event_id", value.alias(name))


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return readers._union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


# ---------------------------------------------------------------- reading and writing


@query("src_first_available")
def _(r):
    paths = [f"{r.folder}/{name}.parquet" for name in ("journeys", "events", "orders")]
    return readers.first_available(r.spark, paths).select("event_id", "user_id", "event_type")


INPUT_TABLES = ["events", "orders", "customer", "lineitem"]


@query("src_multi_table")
def _(r):
    return _row_counts(readers.read_tables(r.spark, r.folder, INPUT_TABLES, suffix=".parquet"))


@query("src_required_tables")
def _(r):
    found = readers.read_tables(r.spark, r.folder, INPUT_TABLES, suffix=".parquet")
    customers = readers.require_tables(found, INPUT_TABLES)["customer"]
    return customers.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))


@query("src_drop_junk_columns")
def _(r):
    junk = r.table("events").select(
        "event_id", "event_type", F.col("value").alias("Unnamed: 0"), F.col("props").alias("duration")
    )
    return readers.drop_junk_columns(junk)


@query("src_check_columns")
def _(r):
    raw = dict(r.raw)
    raw["flights"] = r.table("events").withColumnRenamed("ts", "departure_time")
    raw["bookings"] = raw["bookings"].drop("seat_number", "status")
    return readers.column_report(raw, schemas.INPUTS)


@query("src_empty_check")
def _(r):
    tables = {n: r.table(n) for n in INPUT_TABLES}
    return readers.empty_report(tables | {"negative_balances": r.table("customer").filter("c_acctbal < -1e9")})


@query("src_positional_rename")
def _(r):
    names = ["passenger_id", "full_name", "region_code", "balance", "segment"]
    return readers.rename_by_position(r.table("customer"), names)


@query("src_csv")
def _(r):
    paths = writers.write_tables({"orders": r.table("orders")}, fresh_folder(r.spark, "csv"), "csv")
    return readers.read_csv(r.spark, paths["orders"], TABLE_SCHEMAS["orders"])


def _clean_tables(r: Roles, base: str) -> dict[str, DataFrame]:
    return refresh.clean_tables(r.spark, r.raw, TEST_SALT, base, r.variant, r.order_by)


@query("sink_tables")
def _(r):
    return _row_counts(_clean_tables(r, fresh_folder(r.spark, "tables")))


@query("sink_kpis")
def _(r):
    base = fresh_folder(r.spark, "kpis")
    paths = writers.write_tables(refresh.kpi_tables(_clean_tables(r, base)), base)
    return _row_counts({name: readers.read(r.spark, path) for name, path in paths.items()})


@query("audit_row_counts")
def _(r):
    return audit.flight_steps(r.raw_flights)


def _audited(name: str):
    def build(r: Roles) -> DataFrame:
        return audit.AUDITS[name](r.untidy[name], r.variant, r.order_by.get(name)).steps

    return build


query("audit_flights")(_audited("flights"))
query("audit_bookings")(_audited("bookings"))
query("audit_passengers")(_audited("passengers"))
query("audit_payments")(_audited("payments"))


@query("audit_nb", "notebook")
def _(r):
    parts = [_audited(n)(r).select(F.lit(n).alias("table_name"), "position", "step", "rows_in", "dropped") for n in r.untidy]
    return readers._union(parts)


@query("audit_clean_bookings")
def _(r):
    """The clean table that the audit reads from its one pass."""
    tidy = audit.bookings(r.untidy["bookings"], r.variant, r.order_by["bookings"]).clean
    return tidy.select("booking_id", "passenger_id", "status", "seat_number")


@query("audit_raw_and_clean")
def _(r):
    tables = {"flights": r.timed, "bookings": r.bookings, "passengers": r.passengers, "payments": r.payments}
    return audit.raw_and_clean_counts(r.raw, tables)


@query("sink_typed_export")
def _(r):
    wide = _master(r).select(
        "booking_id", "booking_date", "status", "amount", "payment_id", "duration_mins", "is_delayed", "is_overnight", "age"
    )
    paths = writers.write_tables({"export": writers.typed_for_export(wide)}, fresh_folder(r.spark, "export"))
    return readers.read(r.spark, paths["export"])


@query("sink_model_types")
def _(r):
    return writers.typed_for_model(
        _master(r).select("booking_id", "payment_id", "booking_date", "amount", "duration_mins", "is_overnight", "age", "gender")
    )


@query("check_outputs")
def _(r):
    base = fresh_folder(r.spark, "outputs")
    tables = _clean_tables(r, base)
    expected = {name: df.schema for name, df in tables.items()}
    expected["cleaned_payments"] = ["payment_id", "booking_id"]
    expected["kpi_route_traffic"] = ["route", "flight_count"]
    return writers.check_outputs(r.spark, base, expected)


# ---------------------------------------------------------------- projections, filters, nulls


@query("project_columns")
def _(r):
    return filters.project(r.timed, ["flight_id", "route", "duration_mins"])


@query("project_present")
def _(r):
    return filters.project_present(r.passengers, ["passenger_id", "age", "loyalty_tier", "age_group", "gender"])


@query("drop_columns")
def _(r):
    return r.table("customer").drop("c_name", "c_phone", "c_acctbal")


@query("drop_null_critical")
def _(r):
    return filters.drop_null_critical(r.raw_flights, ["destination", "arrival_time"])


@query("filter_valid_interval")
def _(r):
    return filters.valid_interval(r.raw_flights).select("flight_id", "departure_time", "arrival_time")


@query("filter_duration_range")
def _(r):
    minutes = temporal.duration_minutes(F.col("departure_time"), F.col("arrival_time"))
    timed = r.raw_flights.select("flight_id", minutes.alias("duration_mins"))
    return filters.duration_in_range(timed)


@query("filter_not_in")
def _(r):
    carriers = _events(r, *CARRIERS).withColumn("airline", text.norm_upper(F.col("airline")))
    return filters.not_in(carriers, "airline", C.CARRIER_PLACEHOLDERS)


@query("filter_not_equal")
def _(r):
    return filters.not_equal(r.table("orders"), "o_orderstatus", "F").select("o_orderkey", "o_orderstatus")


@query("filter_slicers")
def _(r):
    dated = r.timed.withColumn("departure_date", F.to_date("departure_time"))
    chosen = {
        "airline": ["CLICK", "VIEW"],
        "departure_slot": "Morning (09-12)",
        "departure_date": ("2024-01-05", "2024-01-20"),
    }
    return filters.slice_by(dated, chosen).select("flight_id", "airline", "route", "departure_slot", "departure_date")


@query("detail_delayed")
def _(r):
    return filters.delayed_only(r.flights).select("flight_id", "airline", "route", "duration_mins")


@query("fill_null_constants")
def _(r):
    people = r.raw_passengers.select("passenger_id", "age")
    booked = r.raw_bookings.select("passenger_id", "booking_id", "emergency_contact_name")
    bookings = stored_with_sketches(booked, "contacts", ["passenger_id"])
    joined = left_join_many(people, bookings, "passenger_id", "booking_id", r.rows_per_task)
    return filters.fill_constants(joined, {"age": 0, "booking_id": -1, "emergency_contact_name": "Unknown"})


@query("fill_all_strings")
def _(r):
    return filters.fill_strings(_untidy(r).select("event_id", "raw", "raw_time"))


@query("preview_head")
def _(r):
    return filters.head(r.timed, ["departure_time", "flight_id"], 10).select("flight_id", "route", "duration_hhmm")


# ---------------------------------------------------------------- duplicates


@query("dedup_rows")
def _(r):
    return dedup.distinct_rows(r.table("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"))


@query("dedup_first_by_key")
def _(r):
    first = dedup.first_by_key(r.raw_payments, "payment_id", PAYMENT_ORDER)
    return first.select("payment_id", "amount", "payment_method")


def _payments_with_gaps(r: Roles) -> DataFrame:
    amount = F.when(F.col("l_quantity") >= 5, F.col("amount"))
    return r.raw_payments.withColumn("amount", amount)


@query("dedup_valid_then_first")
def _(r):
    first = dedup.valid_then_first(_payments_with_gaps(r), "payment_id", ["amount"], PAYMENT_ORDER)
    return first.select("payment_id", "amount", "payment_method")


@query("dedup_rows_then_valid")
def _(r):
    rows = _payments_with_gaps(r).select("booking_id", "amount", "payment_method")
    return dedup.valid_distinct(rows, ["amount"])


@query("count_duplicate_rows")
def _(r):
    return dedup.count_duplicate_rows(r.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


# ---------------------------------------------------------------- column functions


@query("fn_norm_upper")
def _(r):
    return _per_event(r, text.norm_upper(F.col("raw")))


@query("fn_norm_lower")
def _(r):
    return _per_event(r, text.norm_lower(F.col("raw")))


@query("fn_strip")
def _(r):
    return _per_event(r, text.norm_strip(F.col("raw")))


@query("fn_try_timestamp")
def _(r):
    return _per_event(r, temporal.try_timestamp(F.col("raw_time")))


@query("fn_try_double")
def _(r):
    return _per_event(r, numeric.try_double(F.col("raw_number")))


@query("fn_prefix_impute")
def _(r):
    value = text.impute_carrier(F.col("airline"), F.col("flight_id"))
    return _events(r, *CARRIERS).select("event_id", value.alias("value"))


@query("fn_prefix_impute_bi")
def _(r):
    value = text.impute_carrier_for_report(F.col("airline"), F.col("flight_id"))
    return _events(r, *CARRIERS).select("event_id", value.alias("value"))


@query("fn_map_values")
def _(r):
    method = F.upper(F.trim("payment_method"))
    mapped = text.map_values(method, C.PAYMENT_LABEL)
    carrier = text.map_values(F.col("airline"), C.CARRIER_SPELLING)
    payments = r.raw_payments.select("payment_id", mapped.alias("value"))
    carriers = _events(r, *CARRIERS).select(F.col("flight_id").alias("payment_id"), carrier.alias("value"))
    return payments.unionByName(carriers)


@query("fn_collapse_status")
def _(r):
    status = text.norm_upper(F.col("status"))
    return r.raw_bookings.select("booking_id", text.collapse_status(status).alias("value"))


@query("fn_binary_gender")
def _(r):
    gender = text.norm_upper(F.col("gender"))
    return r.raw_passengers.select("passenger_id", text.binary_gender(gender).alias("value"))


@query("fn_age_group")
def _(r):
    age = numeric.typed_double(F.col("age"))
    return r.raw_passengers.select("passenger_id", numeric.age_group(age).alias("value"))


@query("fn_time_slot")
def _(r):
    ts = temporal.try_timestamp(F.col("raw_time"))
    return (
        r.table("events")
        .selectExpr("ts", *UNTIDY)
        .select(
            "event_id",
            temporal.time_slot(F.col("ts")).alias("value"),
            temporal.time_slot(F.col("ts"), with_hours=False).alias("plain"),
            temporal.time_slot(ts).alias("unsure"),
        )
    )


@query("fn_hour")
def _(r):
    return r.table("events").select("event_id", F.hour("ts").alias("value"))


@query("fn_date")
def _(r):
    return r.table("events").select("event_id", F.to_date("ts").alias("value"))


@query("fn_year")
def _(r):
    dob = temporal.try_timestamp(F.col("date_of_birth"))
    return r.raw_passengers.select(
        "passenger_id",
        temporal.birth_year(dob).alias("value"),
        temporal.birth_year(dob, zero_for_missing=False).alias("nullable"),
    )


@query("fn_duration_minutes")
def _(r):
    minutes = temporal.duration_minutes(F.col("departure_time"), F.col("arrival_time"))
    return r.raw_flights.select("flight_id", minutes.alias("value"))


@query("fn_overnight_flag")
def _(r):
    night = temporal.overnight(F.col("departure_time"), F.col("arrival_time"))
    return r.raw_flights.select("flight_id", night.alias("value"))


@query("fn_duration_hhmm")
def _(r):
    return r.timed.select("flight_id", temporal.hours_and_minutes(F.col("duration_mins")).alias("value"))


@query("fn_route")
def _(r):
    return r.raw_flights.select(
        "flight_id", text.route_name(F.col("source"), F.col("destination")).alias("value")
    )


@query("mask_hash_suffix")
def _(r):
    return r.raw_bookings.select(
        "booking_id", masking.hash_salt_last(F.col("passport_number"), TEST_SALT).alias("value")
    )


@query("mask_hash_prefix")
def _(r):
    return r.raw_bookings.select(
        "booking_id", masking.hash_salt_first(F.col("passport_number"), TEST_SALT).alias("value")
    )


@query("mask_name")
def _(r):
    return r.raw_bookings.select(
        "booking_id", masking.initial_of_stripped(F.col("emergency_contact_name")).alias("value")
    )


@query("mask_name_nb")
def _(r):
    return r.raw_bookings.select(
        "booking_id", masking.initial_or_stars(F.col("emergency_contact_name")).alias("value")
    )


@query("generalise_dob")
def _(r):
    return r.passengers_masked


@query("generalise_dob_nb", "notebook")
def _(r):
    return r.passengers_masked


@query("mask_bookings")
def _(r):
    return r.bookings_masked


@query("mask_bookings_nb", "notebook")
def _(r):
    return r.bookings_masked


@query("fn_round_half_even")
def _(r):
    return r.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numeric.round2(F.col("l_extendedprice") * F.col("l_discount")).alias("value"),
        numeric.round2(F.col("l_quantity") / 8).alias("eighths"),
    )


@query("fn_percent")
def _(r):
    part = numeric.percent(F.col("l_discount"), F.col("l_tax"))
    return r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", part.alias("value"))


@query("fn_divide_default")
def _(r):
    ratio = numeric.divide_or_zero(F.col("l_discount"), F.col("l_tax"))
    return r.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ratio.alias("value"))


@query("fn_flag_to_int")
def _(r):
    return r.table("orders").select("o_orderkey", numeric.flag(F.col("o_totalprice") > 250000).alias("value"))


@query("fn_safe_numeric_fill")
def _(r):
    return _untidy(r).select(
        "event_id",
        numeric.numeric_or_zero(F.col("raw_number")).alias("value"),
        numeric.numeric_or_zero(F.col("raw_number"), "int").alias("whole"),
    )


@query("fn_unit_scale_format")
def _(r):
    price = F.col("o_totalprice")
    return r.table("orders").select(
        "o_orderkey",
        numeric.in_millions(price).alias("millions"),
        numeric.in_hours(F.col("o_custkey")).alias("hours"),
        F.format_number(F.col("o_custkey") * 1000, 0).alias("display"),
    )


# ---------------------------------------------------------------- joins


@query("join_booking_flight")
def _(r):
    return joins.bookings_with_flight(r.booking_keys, r.timed, r.rows_per_task).select("booking_id", "flight_id", "route", "duration_mins")


@query("join_fanout_payment")
def _(r):
    lines = r.booking_keys.select("booking_id", "status")
    return joins.with_payments(lines, r.stored_payments, r.rows_per_task)


@query("join_passenger_subset")
def _(r):
    lines = r.booking_keys.select("booking_id", "passenger_id", F.col("status").alias("gender"))
    return joins.with_passenger(lines, r.passengers_masked, sizes=r.booking_keys, rows_per_task=r.rows_per_task)


def _master(r: Roles) -> DataFrame:
    unique = r.variant == "script"
    return joins.master(
        r.wide_bookings, r.flights, r.wide_payments, r.passengers_masked, r.rows_per_task, unique
    )


@query("master_4way")
def _(r):
    return _master(r).select(
        "booking_id", "passenger_id", "flight_id", "status", "route", "duration_mins", "is_overnight", "is_delayed",
        "payment_id", "amount", "payment_method", "age", "age_group", "gender", "first_name",
    )


@query("master_4way_nb", "notebook")
def _(r):
    return _master(r).select(
        "booking_id", "passenger_id", "status", "route", "is_delayed", "departure_hour", "amount", "payment_method",
        "age_group", "gender", "birth_year", "first_name_masked",
    )


@query("join_inner_paid")
def _(r):
    return joins.paid_bookings(r.booking_keys.select("booking_id", "flight_id"), r.stored_payments, r.rows_per_task)


@query("join_carrier_lookup")
def _(r):
    lines = narrowed(r.booking_keys, "booking_id", "flight_id")
    return joins.with_carrier(lines, r.timed, ("airline", "route"), r.rows_per_task)


@query("join_pax_revenue")
def _(r):
    people = r.passengers.select("passenger_id", "gender", "age_group")
    return joins.passengers_with_revenue(people, r.booking_keys, r.stored_payments, r.rows_per_task)


@query("join_booking_pax_revenue")
def _(r):
    lines = narrowed(r.booking_keys, "booking_id", "passenger_id", "status")
    return joins.bookings_with_revenue_and_passenger(lines, r.stored_payments, r.passengers, r.rows_per_task)


@query("join_revenue_pax")
def _(r):
    lines = narrowed(r.booking_keys, "booking_id", "passenger_id", "flight_id")
    return joins.revenue_with_flight_and_passenger(lines, r.stored_payments, r.timed, r.passengers, r.rows_per_task)


# ---------------------------------------------------------------- window operators


@query("win_group_mean")
def _(r):
    mean = numeric.exact_mean(F.col("duration_mins"))
    rows = stored(r.timed.select("flight_id", "route", "duration_mins"), "timed")
    return group_mean(rows, "route", mean, "route_mean")


@query("win_delay_flag")
def _(r):
    return clean.with_delay_flag(r.timed.select("flight_id", "route", "duration_mins"))


@query("win_share_of_total")
def _(r):
    counts = r.table("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.share_of_total(counts, "n", "share_pct")


# ---------------------------------------------------------------- KPI tables

query("kpi_route_traffic")(lambda r: kpis.route_traffic(r.timed))
query("kpi_avg_duration_by_airline")(lambda r: kpis.avg_duration_by_airline(r.timed))
query("kpi_avg_duration_by_route")(lambda r: kpis.avg_duration_by_route(r.timed))
query("kpi_airline_distribution")(lambda r: kpis.airline_distribution(r.timed))
query("kpi_delay_summary")(lambda r: kpis.delay_summary(r.timed))
query("kpi_revenue_by_airline")(lambda r: kpis.revenue_by_airline(r.facts, r.payments, r.timed))
query("kpi_departure_slots")(lambda r: kpis.departure_slots(r.timed))
query("kpi_booking_status")(lambda r: kpis.booking_status(r.bookings))
query("kpi_payment_methods")(lambda r: kpis.payment_methods(r.payments))
query("kpi_passenger_demographics")(lambda r: kpis.passenger_demographics(r.passengers, r.facts, r.payments))
query("kpi_frequent_flyers")(lambda r: kpis.frequent_flyers(r.passengers_masked, r.facts, r.payments))
query("kpi_airline_passenger_demographics")(
    lambda r: kpis.airline_passenger_demographics(r.facts, r.timed, r.payments, r.passengers, r.rows_per_task)
)

# ---------------------------------------------------------------- extended reports

query("nb_avg_by_airline", "notebook")(lambda r: extended.avg_by_airline(r.timed))
query("nb_avg_by_route", "notebook")(lambda r: extended.avg_by_route(r.timed))
query("nb_route_traffic", "notebook")(lambda r: extended.route_traffic(r.timed))
query("nb_delay_summary", "notebook")(lambda r: extended.delay_summary(r.timed))
query("nb_airline_dist", "notebook")(lambda r: extended.airline_distribution(r.timed))
query("nb_revenue_by_airline", "notebook")(lambda r: extended.revenue_by_airline(r.facts, r.payments, r.timed))
query("nb_slot_traffic", "notebook")(lambda r: extended.slot_traffic(r.timed))
query("nb_booking_status", "notebook")(lambda r: extended.booking_status(r.bookings))
query("nb_payment_method", "notebook")(lambda r: extended.payment_method(r.payments))
query("nb_passenger_demographics", "notebook")(
    lambda r: extended.passenger_demographics(r.facts, r.payments, r.passengers)
)
query("nb_frequent_flyers", "notebook")(lambda r: extended.frequent_flyers(r.facts, r.payments, r.passengers))
query("nb_airline_pax_demographics", "notebook")(
    lambda r: extended.airline_passenger_demographics(r.facts, r.payments, r.timed, r.passengers, r.rows_per_task)
)
query("global_kpis", "notebook")(lambda r: extended.global_kpis(r.timed))
query("median_duration")(lambda r: aggregates.median_and_mean(r.timed, "duration_mins"))
query("histogram_duration")(lambda r: aggregates.histogram(r.timed, "duration_mins"))


#: Column headers of the pivot: the event types, in upper case.
EVENT_TYPES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]


@query("pivot_route_matrix")
def _(r):
    return aggregates.pivot_counts(r.timed, "source", "destination", EVENT_TYPES, other="OTHER")


query("pair_route_counts")(lambda r: aggregates.pair_counts(r.timed, "source", "destination"))
query("histogram_constant")(lambda r: aggregates.histogram(r.timed.withColumn("one", F.lit(7.0)), "one"))


query("profile_table")(lambda r: aggregates.profile(r.table("customer"), "c_custkey"))
query("value_counts")(lambda r: aggregates.value_counts(r.timed, "departure_slot", "flight_count"))
query("value_counts_map")(
    lambda r: aggregates.value_counts_json(r.timed, "departure_slot", [*C.SLOT_ORDER_WITH_HOURS, C.UNKNOWN_LABEL])
)


@query("count_over_fixed_categories")
def _(r):
    order = [*C.SLOT_ORDER_WITH_HOURS, C.UNKNOWN_LABEL]
    counted = aggregates.counts_in_order(r.timed, "departure_slot", order, zero_fill=False)
    return counted.select(
        "position", "departure_slot", F.coalesce("count", F.lit(0)).alias("count"), F.col("count").alias("count_or_null")
    )


# ---------------------------------------------------------------- report measures


def _measures(names: list[str], by: str | None = None):
    def build(r: Roles) -> DataFrame:
        flights = r.flights if report.needs_delay_flag(names) else r.timed
        return report.measures(r.facts, flights, r.payments, r.passengers, names, by, r.rows_per_task)

    return build


@query("m_total_flights")
def _(r):
    booked = _measures(["total_flights"])(r)
    return booked.select(
        "total_flights", r.timed.agg(F.count(F.lit(1))).scalar().alias("clean_flights")
    )


query("m_total_bookings")(_measures(["total_bookings"]))
query("m_total_revenue")(_measures(["total_revenue"]))
query("m_avg_duration")(_measures(["avg_duration", "avg_duration_zero_filled"]))
query("m_delayed_flights")(_measures(["delayed_flights"]))
query("m_overnight_flights")(_measures(["overnight_flights"]))
query("m_unique_passengers")(_measures(["unique_passengers"]))
query("m_avg_age")(_measures(["avg_age", "avg_age_zero_filled"]))
query("m_delay_rate")(_measures(["delay_rate"]))
query("m_overnight_pct")(_measures(["overnight_pct"]))
query("m_spend_per_passenger")(_measures(["spend_per_passenger"]))
query("m_confirmation_rate")(_measures(["confirmation_rate"]))
query("measures_by_dimension")(
    _measures(["total_flights", "total_bookings", "total_revenue", "delayed_flights", "unique_passengers"], "airline")
)
query("measures_by_delayed")(_measures(["total_bookings", "delayed_flights"], "is_delayed"))
query("measures_by_status")(_measures(["total_bookings", "confirmation_rate"], "status"))
query("measures_by_route")(_measures(["delayed_flights", "delay_rate"], "route"))
query("measures_by_payment_method")(_measures(["total_revenue", "total_bookings"], "payment_method"))
query("measures_by_age_group")(_measures(["unique_passengers", "spend_per_passenger"], "age_group"))


#: Report columns that distinct counts are stored for.
COUNTED_BY = ["airline", "route", "status", "age_group", "gender"]


def _member_sets(r: Roles, by: list[str]) -> DataFrame:
    return members.member_sets(r.facts, r.timed, r.payments, r.passengers, by, r.rows_per_task)


@query("distinct_from_sets")
def _(r):
    sets = _member_sets(r, COUNTED_BY)
    each = [members.distinct_counts(sets, c).select(F.lit(c).alias("by"), "value", *members.COUNTED) for c in COUNTED_BY]
    all_lines = F.lit(members.EVERYTHING)
    whole = members.distinct_counts(sets).select(all_lines.alias("by"), all_lines.alias("value"), *members.COUNTED)
    return readers._union([*each, whole])


@query("measures_from_sets")
def _(r):
    names = ["total_flights", "total_bookings", "total_revenue", "unique_passengers", "spend_per_passenger"]
    sets = _member_sets(r, ["airline"])
    return members.measures(sets, r.facts, r.timed, r.payments, r.passengers, names, "airline", r.rows_per_task)


SLICED = ["total_flights", "total_bookings", "total_revenue", "delayed_flights", "unique_passengers"]
#: Slicer settings by name: columns of all four tables, alone and together.
SLICERS: dict[str, report.Slicers] = {
    "route": {"route": ["VIEW to CLICK", "CLICK to VIEW"]},
    "status": {"status": "CONFIRMED"},
    "age_group": {"age_group": ["18-30", "60+"]},
    "dates": {"departure_time": (datetime(2024, 1, 5), datetime(2024, 1, 12))},
    "delayed": {"is_delayed": 1},
    "method": {"payment_method": "UPI"},
    "page": {
        "status": ["CONFIRMED", "CANCELLED"],
        "departure_time": (datetime(2024, 1, 2), datetime(2024, 1, 25)),
        "age_group": ["18-30", "31-45", "46-60", "60+"],
        "payment_method": ["CARD", "UPI"],
    },
}


@query("measures_with_slicers")
def _(r):
    pages = [
        report.measures(r.facts, r.flights, r.payments, r.passengers, SLICED, "airline", r.rows_per_task, chosen).select(
            F.lit(name).alias("slicers"), "airline", *SLICED
        )
        for name, chosen in SLICERS.items()
    ]
    return readers._union(pages)


def _tables(r: Roles):
    return r.facts, r.timed, r.payments, r.passengers


query("daily_volume")(lambda r: report.daily_volume(r.timed))
query("top_routes")(lambda r: report.top_routes(*_tables(r)))
query("revenue_by_airline_bi")(lambda r: report.revenue_by_airline(*_tables(r)))
query("payment_split")(lambda r: report.payment_split(*_tables(r)))
query("delayed_vs_ontime")(lambda r: report.delayed_vs_ontime(r.timed))
query("overnight_by_airline")(lambda r: report.overnight_by_airline(r.timed))
query("worst_route")(lambda r: report.worst_route(r.timed))
query("age_group_revenue")(lambda r: report.age_group_revenue(r.passengers, r.facts, r.payments))
query("gender_split")(lambda r: report.gender_split(r.passengers))


@query("bi_normalised_master")
def _(r):
    return report.normalise(_master(r)).select(
        "booking_id", "flight_id", "airline", "status", "payment_id", "payment_method", "amount", "duration_mins",
        "is_delayed", "is_overnight", "age", "route", "departure_slot", "gender", "age_group",
    )


# ---------------------------------------------------------------- sorting and top rows

ORDER_COLUMNS = ["o_orderkey", "o_totalprice"]


@query("sort_single")
def _(r):
    return r.table("orders").select(*ORDER_COLUMNS).orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("sort_multi")
def _(r):
    columns = ["o_orderstatus", "o_orderpriority", "o_orderkey"]
    return r.table("orders").select(*columns).orderBy(*columns)


#: Sort orders of the stored tables, by name.
ORDERS: dict[str, sorted_files.Order] = {
    "single": [("o_totalprice", True), ("o_orderkey", False)],
    "multi": [("o_orderstatus", False), ("o_orderpriority", False), ("o_orderkey", False)],
}


def _sorted_orders(r: Roles, name: str) -> str:
    path = fresh_folder(r.spark, f"sorted-{name}")
    columns = dict.fromkeys(["o_orderkey", *[c for c, _ in ORDERS[name]]])
    sorted_files.write_sorted(r.table("orders").select(*columns), path, ORDERS[name])
    return path


query("sort_stored")(lambda r: sorted_files.positions(r.spark, _sorted_orders(r, "single")))
query("sort_stored_multi")(lambda r: sorted_files.positions(r.spark, _sorted_orders(r, "multi")))


@query("sort_order_report")
def _(r):
    reports = [
        sorted_files.order_report(r.spark, _sorted_orders(r, name), order).select(F.lit(name).alias("sorted_by"), "*")
        for name, order in ORDERS.items()
    ]
    return readers._union(reports)


@query("topk")
def _(r):
    return r.table("orders").select(*ORDER_COLUMNS).orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)


@query("bottom_up_order")
def _(r):
    top = extended.avg_by_route(r.timed).limit(15)
    return top.orderBy("avg_duration_mins", F.desc("route"))
