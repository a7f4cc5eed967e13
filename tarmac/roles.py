"""The driver's tables in the roles of the four inputs.

Journeys are pairs of consecutive events of a user, bookings are orders, payments are order
lines and passengers are customers. The projections are plain SQL that other engines read too;
they add the untidy values (blanks, odd case, missing-value words, bad dates) that the cleaners
are there for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.operators.heavy import sketched, stored_with_sketches
from tarmac.operators.skew import next_row
from tarmac.plans import clean
from tarmac.plans.facts import booking_facts
from tarmac.session import stored

# A stand-in for the secret that callers pass in.
TEST_SALT = "not-a-secret"

BOOKINGS_SQL = [
    "o_orderkey AS booking_id",
    "o_custkey AS passenger_id",
    "o_orderkey AS flight_id",
    "o_orderdate AS booking_date",
    "CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN ' Cancelled ' ELSE 'PENDING' END AS status",
    "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN ' nan '"
    " ELSE ' P' || cast(o_custkey AS string) END AS passport_number",
    "o_orderpriority AS seat_number",
    "CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN '  '"
    " ELSE ' ' || o_orderpriority END AS emergency_contact_name",
    "CASE WHEN o_orderkey % 29 = 0 THEN 'None' ELSE cast(o_custkey * 7919 AS string) END AS emergency_contact_phone",
]
PASSENGERS_SQL = [
    "c_custkey AS passenger_id",
    "c_name AS first_name",
    "c_mktsegment AS last_name",
    "CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_custkey % 95 END AS age",
    "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN ' f' ELSE 'Male' END AS gender",
    "' ' || c_name || '@Example.COM ' AS email",
    "cast(c_nationkey AS string) || '-' || cast(c_custkey AS string) AS phone",
    "CASE WHEN c_custkey % 31 = 0 THEN 'NONE' ELSE cast(c_custkey * 1000003 AS string) END AS aadhaar_id",
    "CASE WHEN c_custkey % 37 = 0 THEN 'not a date' ELSE cast(1950 + c_custkey % 60 AS string) || '-0'"
    " || cast(1 + c_custkey % 9 AS string) || '-15' END AS date_of_birth",
]
PAYMENTS_SQL = [
    "cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) AS payment_id",
    "l_orderkey AS booking_id",
    "l_extendedprice AS amount",
    "CASE l_returnflag WHEN 'A' THEN 'upi' WHEN 'N' THEN ' Card ' ELSE 'netbanking' END AS payment_method",
]
# Payment ids repeat; these columns say which of the rows comes first.
PAYMENT_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag",
]
# Order ids are unique; the columns the other booking columns are made from decide if they were not.
BOOKING_ORDER = ["booking_date", "passenger_id", "status", "seat_number"]
# Rows added to the raw tables for the audit: which rows are repeated, and what is changed in the copy.
UNTIDY_ROWS: dict[str, list[tuple[str, dict[str, str]]]] = {
    "flights": [
        ("flight_id % 7 = 0", {}),
        ("flight_id % 11 = 0", {"airline": "'zz'"}),
        ("flight_id % 13 = 0", {"flight_id": "flight_id + 1000000000", "departure_time": "arrival_time", "arrival_time": "departure_time"}),
        ("flight_id % 17 = 0", {"flight_id": "flight_id + 2000000000", "airline": "' nan '"}),
    ],
    "bookings": [("booking_id % 7 = 0", {}), ("booking_id % 11 = 0", {"status": "'zz'"})],
    "passengers": [("passenger_id % 7 = 0", {}), ("passenger_id % 11 = 0", {"last_name": "'zz'"})],
    "payments": [
        ("booking_id % 7 = 0", {}),
        ("booking_id % 11 = 0", {"amount": "NULL"}),
        ("booking_id % 13 = 0", {"payment_method": "'zz'", "l_partkey": "l_partkey + 1000000"}),
    ],
}

# Columns that bookings are joined by.
BOOKING_KEYS = ["booking_id", "passenger_id", "flight_id"]


# Declared, so that opening a table reads no file.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


class Roles:
    """Raw and clean tables of one data folder, built when first used."""

    def __init__(
        self, spark: SparkSession, folder: str, variant: str = "script", rows_per_task: int = C.ROWS_PER_TASK
    ):
        self.spark, self.folder, self.variant, self.rows_per_task = spark, folder, variant, rows_per_task

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def raw_flights(self) -> DataFrame:
        events = self.table("events").select("event_id", "user_id", "ts", "event_type")
        following = {"destination": "event_type", "arrival_time": "ts"}
        journeys = next_row(events, "user_id", ["ts", "event_id"], following, self.rows_per_task)
        return journeys.select(
            F.col("event_id").alias("flight_id"),
            F.upper("event_type").alias("airline"),
            F.col("event_type").alias("source"),
            "destination",
            F.col("ts").alias("departure_time"),
            "arrival_time",
        )

    @cached_property
    def raw_bookings(self) -> DataFrame:
        return self.table("orders").selectExpr(*BOOKINGS_SQL)

    @cached_property
    def raw_passengers(self) -> DataFrame:
        return self.table("customer").selectExpr(*PASSENGERS_SQL)

    @cached_property
    def raw_payments(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*PAYMENTS_SQL, *PAYMENT_ORDER)

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {
            "flights": self.raw_flights,
            "bookings": self.raw_bookings,
            "passengers": self.raw_passengers,
            "payments": self.raw_payments,
        }

    @cached_property
    def untidy(self) -> dict[str, DataFrame]:
        """The raw tables with rows of the kinds that cleaning is there for (see `UNTIDY_ROWS`)."""
        out = {}
        for name, table in self.raw.items():
            parts = table
            for condition, changes in UNTIDY_ROWS[name]:
                kinds = dict(table.dtypes)
                changed = {c: F.expr(e).cast(kinds[c]) for c, e in changes.items()}
                parts = parts.unionAll(table.filter(condition).select(*[changed.get(c, F.col(c)).alias(c) for c in table.columns]))
            out[name] = parts
        return out

    @property
    def order_by(self) -> dict[str, list[str]]:
        return {"payments": PAYMENT_ORDER, "bookings": BOOKING_ORDER}

    @cached_property
    def timed(self) -> DataFrame:
        """Clean flights without the delay flag."""
        return clean.flights_without_delay(self.raw_flights, self.variant)

    @cached_property
    def flights(self) -> DataFrame:
        """Clean flights, stored before the delay flag as route means need a pass of their own."""
        return clean.with_delay_flag(stored(self.timed, "timed"))

    @cached_property
    def bookings(self) -> DataFrame:
        return clean.bookings(self.raw_bookings, self.variant, BOOKING_ORDER)

    @cached_property
    def payments(self) -> DataFrame:
        return clean.payments(self.raw_payments, self.variant, PAYMENT_ORDER)

    @cached_property
    def booking_keys(self) -> DataFrame:
        """Bookings without personal data, stored with sketches of their frequent keys."""
        keys = self.bookings.select("booking_id", "passenger_id", "flight_id", "status")
        return stored_with_sketches(keys, "bookings", BOOKING_KEYS)

    @cached_property
    def stored_bookings(self) -> DataFrame:
        """Masked bookings, stored for the wide table."""
        return stored_with_sketches(self.bookings_masked, "bookings", BOOKING_KEYS)

    @cached_property
    def stored_payments(self) -> DataFrame:
        """For row-level joins, which split frequent bookings."""
        return stored_with_sketches(self.payments, "payments", ["booking_id"])

    @cached_property
    def wide_bookings(self) -> DataFrame:
        """Masked bookings with sketches, for the wide table. The notebook variant reads them once, so it stores none of them;
        its distinct rows have the keys that the rows before had."""
        if self.variant == "script":
            return self.stored_bookings
        rows = clean.prepared_bookings(self.raw_bookings, self.variant, BOOKING_ORDER)
        return sketched(self.bookings_masked, rows, "bookings", BOOKING_KEYS)

    @cached_property
    def wide_payments(self) -> DataFrame:
        """Payments with sketches, for the wide table; stored in the script variant only, which may drop all rows of a booking
        as further rows of payment ids."""
        if self.variant == "script":
            return self.stored_payments
        rows = clean.valid_payments(self.raw_payments, self.variant, PAYMENT_ORDER)
        return sketched(self.payments, rows, "payments", ["booking_id"])

    @cached_property
    def facts(self) -> DataFrame:
        """Bookings without personal data with what was paid for each, stored with sketches of the keys that reports join by.
        Ids may repeat in the notebook variant."""
        if self.variant == "script":
            bookings = self.bookings.select("booking_id", "passenger_id", "flight_id", "status")
            paid = booking_facts(bookings, self.payments)
        else:
            paid = booking_facts(self.booking_keys, self.payments, False, self.rows_per_task)
        return stored_with_sketches(paid, "facts", BOOKING_KEYS[1:] if self.variant == "script" else BOOKING_KEYS)

    @cached_property
    def passengers(self) -> DataFrame:
        return clean.passengers(self.raw_passengers, self.variant)

    @cached_property
    def bookings_masked(self) -> DataFrame:
        return clean.mask_bookings(self.bookings, TEST_SALT, self.variant)

    @cached_property
    def passengers_masked(self) -> DataFrame:
        return clean.mask_passengers(self.passengers, TEST_SALT, self.variant)
