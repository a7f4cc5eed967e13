"""Timestamps without zone, durations and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.numeric import flag, round2


def try_timestamp(c: Column, formats: tuple[str, ...] = ()) -> Column:
    """Timestamp from text, null when unreadable; extra formats are tried in order."""
    tries = [c.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(c.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def duration_minutes(start: Column, end: Column) -> Column:
    """Minutes between two zone-less timestamps. Subtracting them involves no time zone, which
    timestampdiff would: it reads them in the zone of the session."""
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return round2((seconds * 1_000_000).cast("double") / 6e7)


def minute_number(ts: Column) -> Column:
    """Calendar minutes since 1970 of a zone-less timestamp, again without a time zone."""
    return F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def overnight(start: Column, end: Column) -> Column:
    return flag(F.to_date(end) > F.to_date(start))


def hours_and_minutes(minutes: Column) -> Column:
    whole = minutes.cast("int")
    return F.concat(F.floor(whole / 60).cast("string"), F.lit("h "), (whole % 60).cast("string"), F.lit("m"))


def time_slot(ts: Column, with_hours: bool = True) -> Column:
    slots, night = (
        (C.SLOTS_WITH_HOURS, C.NIGHT_WITH_HOURS) if with_hours else (C.SLOTS_PLAIN, C.NIGHT_PLAIN)
    )
    hour = F.hour(ts)
    out = F.when(hour.isNull(), C.UNKNOWN_LABEL)
    for label, first, end in slots:
        out = out.when((hour >= first) & (hour < end), label)
    return out.otherwise(night)


def birth_year(dob: Column, zero_for_missing: bool = True) -> Column:
    year = F.year(dob)
    return F.coalesce(year, F.lit(0)) if zero_for_missing else year
