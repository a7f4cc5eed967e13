"""From raw tables to clean ones.

Two variants exist. "script" is the default; "notebook" keeps placeholder carriers and all
genders, removes whole-row duplicates only, and gives masked columns new names.

`order_by` names columns that say which of several rows with one key is first. They may be
columns beyond the declared ones and are dropped at the end; without them the order of all
columns decides, so the result never depends on partitioning. Where only the first row of a key is
kept, columns that play no part in finding it are brought into normal form afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac import schemas
from tarmac.functions import masking, numeric, temporal, text
from tarmac.operators import dedup, filters
from tarmac.operators.skew import group_mean
from tarmac.sources.readers import ColumnCountError, drop_junk_columns

Form = Callable[[Column, str], Column]
UPPER = (text.norm_upper, C.NULL_TOKEN_UPPER)
LOWER = (text.norm_lower, C.NULL_TOKEN_LOWER)
STRIPPED = (text.norm_strip, C.NULL_TOKEN_LOWER)


def _named(raw: DataFrame, names: list[str], order_by: list[str] | None) -> DataFrame:
    """Junk columns dropped, the others named by position, order columns kept as they are."""
    extra = [c for c in order_by or [] if c in raw.columns and c not in names]
    kept = [c for c in drop_junk_columns(raw).columns if c not in extra]
    if len(kept) != len(names):
        raise ColumnCountError(f"expected columns {names}, found {kept}")
    return raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)], *extra)


def _times(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: temporal.try_timestamp(F.col(n)) for n in names})


def _normal(df: DataFrame, forms: dict[str, tuple[Form, str]]) -> DataFrame:
    """Columns in normal form, a missing value becoming the token.

    Digits have neither case nor blanks, so whole numbers only become text.
    """
    kinds = dict(df.dtypes)
    whole = ("tinyint", "smallint", "int", "bigint")
    return df.withColumns(
        {
            name: text.text_or_token(F.col(name), token) if kinds[name] in whole else form(F.col(name), token)
            for name, (form, token) in forms.items()
        }
    )


def _number(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return numeric.try_double(F.col(name)) if kind == "string" else numeric.typed_double(F.col(name))


def flights_without_delay(
    raw: DataFrame, variant: str = "script", order_by: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """Clean flights but for the delay flag.

    Whole-row duplicates share their flight id, so keeping the first row of each id removes
    them as well; one shuffle does both. Missing text becomes a token before the null test,
    which then only finds missing times; `strict` tests the text columns first.
    """
    ready = prepared_flights(raw, order_by)
    if strict:
        ready = ready.filter("_has_text")
    timed = filters.drop_null_critical(ready, ["departure_time", "arrival_time"]).drop("_has_text")
    single = dedup.first_by_key(timed, "flight_id", order_by).select(*schemas.FLIGHTS.fieldNames())
    return finished_flights(single, variant)


def prepared_flights(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """All flights in normal form; `_has_text` says whether the text columns were there."""
    ids = ["flight_id", "source", "destination"]
    named = _named(raw, schemas.FLIGHTS.fieldNames(), order_by)
    there = F.lit(True)
    for name in ids:
        there = there & F.col(name).isNotNull()
    normal = _normal(named.withColumn("_has_text", there), dict.fromkeys([*ids, "airline"], UPPER))
    return _times(normal, "departure_time", "arrival_time")


def finished_flights(single: DataFrame, variant: str = "script") -> DataFrame:
    """Flights with one row an id: impossible ones dropped, times and route worked out."""
    known = filters.valid_interval(single).withColumn(
        "airline", text.impute_carrier(F.col("airline"), F.col("flight_id"))
    )
    if variant == "script":
        known = filters.not_in(known, "airline", C.CARRIER_PLACEHOLDERS)
    departure, arrival = F.col("departure_time"), F.col("arrival_time")
    measured = filters.duration_in_range(
        known.withColumn("duration_mins", temporal.duration_minutes(departure, arrival))
    )
    features = {
        "is_overnight": temporal.overnight(departure, arrival),
        "duration_hhmm": temporal.hours_and_minutes(F.col("duration_mins")),
        "route": text.route_name(F.col("source"), F.col("destination")),
        "departure_slot": temporal.time_slot(departure, with_hours=variant == "script"),
    }
    if variant == "notebook":
        features |= {
            "departure_date": F.to_date(departure),
            "arrival_date": F.to_date(arrival),
            "departure_hour": F.hour(departure),
        }
    return measured.withColumns(features)


def with_delay_flag(flights: DataFrame) -> DataFrame:
    """Flag flights that take more than 1.3 times the mean of their route."""
    mean = numeric.exact_mean(F.col("duration_mins"))
    return (
        group_mean(flights, "route", mean, "_route_mean")
        .withColumn("is_delayed", numeric.flag(F.col("duration_mins") > F.col("_route_mean") * C.DELAY_FACTOR))
        .drop("_route_mean")
    )


def flights(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None, strict: bool = False) -> DataFrame:
    return with_delay_flag(flights_without_delay(raw, variant, order_by, strict))


def bookings(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> DataFrame:
    """Clean bookings, personal data not yet masked."""
    ready = prepared_bookings(raw, variant, order_by)
    if variant == "script":
        first = dedup.first_by_key(ready, "booking_id", order_by).select(*schemas.BOOKINGS.fieldNames())
        return finished_bookings(first, variant)
    return finished_bookings(dedup.distinct_rows(ready), variant)


def prepared_bookings(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> DataFrame:
    """All bookings in the form in which copies are looked for."""
    named = _named(raw, schemas.BOOKINGS.fieldNames(), order_by)
    if variant == "script":
        return _times(_normal(named, {"booking_id": UPPER}), "booking_date")
    forms = {"booking_id": STRIPPED, "passenger_id": STRIPPED, "flight_id": UPPER, "status": UPPER}
    return _times(_normal(named.select(*schemas.BOOKINGS.fieldNames()), forms), "booking_date")


def finished_bookings(single: DataFrame, variant: str = "script") -> DataFrame:
    if variant != "script":
        return single
    return _normal(single, dict.fromkeys(["passenger_id", "flight_id", "status", "seat_number"], UPPER))


def mask_bookings(clean: DataFrame, salt: str, variant: str = "script") -> DataFrame:
    if variant == "script":
        return clean.withColumns(
            {
                "passport_number": masking.hash_salt_last(F.col("passport_number"), salt),
                "emergency_contact_name": masking.initial_of_stripped(F.col("emergency_contact_name")),
                "emergency_contact_phone": masking.hash_salt_last(F.col("emergency_contact_phone"), salt),
            }
        )
    return clean.withColumns(
        {
            "passport_hash": masking.hash_salt_first(F.col("passport_number"), salt),
            "emg_phone_hash": masking.hash_salt_first(F.col("emergency_contact_phone"), salt),
            "emg_name_masked": masking.initial_or_stars(F.col("emergency_contact_name")),
        }
    ).drop("passport_number", "emergency_contact_phone", "emergency_contact_name")


def passengers(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> DataFrame:
    """Clean customers with age group and birth year, personal data not yet masked."""
    ready = prepared_passengers(raw, variant, order_by)
    if variant == "script":
        first = dedup.first_by_key(ready, "passenger_id", order_by).select(*schemas.PASSENGERS.fieldNames())
        return finished_passengers(first, variant)
    return finished_passengers(dedup.distinct_rows(ready), variant)


def prepared_passengers(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> DataFrame:
    """All customers in the form in which copies are looked for."""
    names = schemas.PASSENGERS.fieldNames()
    named = _times(_named(raw, names, order_by), "date_of_birth")
    named = named.withColumn("age", _number(named, "age"))
    if variant == "script":
        normal = _normal(named, {"passenger_id": UPPER, "gender": UPPER})
        return normal.withColumn("gender", text.binary_gender(F.col("gender")))
    return _normal(named.select(*names), {"passenger_id": STRIPPED, "gender": UPPER, "email": LOWER})


def finished_passengers(single: DataFrame, variant: str = "script") -> DataFrame:
    group = numeric.age_group(F.col("age"))
    if variant == "script":
        return single.withColumns({"birth_year": temporal.birth_year(F.col("date_of_birth")), "age_group": group})
    return single.withColumn("age_group", group)


def mask_passengers(clean: DataFrame, salt: str, variant: str = "script") -> DataFrame:
    """Hashes and initials instead of personal data, the year instead of the date of birth."""
    if variant == "script":
        masked = {c: masking.initial_of_stripped(F.col(c)) for c in ("first_name", "last_name")}
        masked |= {c: masking.hash_salt_last(F.col(c), salt) for c in ("email", "phone", "aadhaar_id")}
        return clean.withColumns(masked).drop("date_of_birth")
    return clean.withColumns(
        {
            "aadhaar_id_hash": masking.hash_salt_first(F.col("aadhaar_id"), salt),
            "email_hash": masking.hash_salt_first(F.col("email"), salt),
            "phone_hash": masking.hash_salt_first(F.col("phone"), salt),
            "first_name_masked": masking.initial_or_stars(F.col("first_name")),
            "last_name_masked": masking.initial_or_stars(F.col("last_name")),
            "birth_year": temporal.birth_year(F.col("date_of_birth"), zero_for_missing=False),
        }
    ).drop("aadhaar_id", "email", "phone", "first_name", "last_name", "date_of_birth")


def payments(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> DataFrame:
    ready = prepared_payments(raw, variant, order_by, present_only=True)
    if variant == "script":
        first = dedup.valid_then_first(ready, "payment_id", ["amount"], order_by).select(*schemas.PAYMENTS.fieldNames())
        return finished_payments(first, variant)
    return finished_payments(dedup.valid_distinct(ready, ["amount"]), variant)


def valid_payments(raw: DataFrame, variant: str = "script", order_by: list[str] | None = None) -> DataFrame:
    """The rows that `payments` looks for copies among: prepared, with an amount."""
    return dedup.valid(prepared_payments(raw, variant, order_by, present_only=True), ["amount"])


def prepared_payments(
    raw: DataFrame, variant: str = "script", order_by: list[str] | None = None, present_only: bool = False
) -> DataFrame:
    """All payments in the form in which copies are looked for; an amount that is no number is missing."""
    named = _named(raw, schemas.PAYMENTS.fieldNames(), order_by)
    if present_only:
        # A missing amount is dropped in the end; saying so first lets the scan skip those rows.
        named = named.filter(F.col("amount").isNotNull())
    named = named.withColumn("amount", _number(named, "amount"))
    if variant == "script":
        return _normal(named, {"payment_id": UPPER})
    forms = {"payment_id": STRIPPED, "booking_id": STRIPPED, "payment_method": UPPER}
    return _normal(named.select(*schemas.PAYMENTS.fieldNames()), forms)


def finished_payments(single: DataFrame, variant: str = "script") -> DataFrame:
    return _normal(single, {"booking_id": UPPER, "payment_method": UPPER}) if variant == "script" else single
