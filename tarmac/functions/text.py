"""Text clean-up and value mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac import constants as C

# Every character Python's str.strip removes; SQL trim alone removes spaces only.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())


def strip(c: Column) -> Column:
    """Without outer white space. The cost of trimming grows with the list of characters, so
    only text beyond ASCII, which has fewer characters than bytes, is trimmed by the long one."""
    only_ascii = F.length(c) == F.octet_length(c)
    return F.when(only_ascii, F.trim(c, F.lit(ASCII_WHITESPACE))).otherwise(F.trim(c, F.lit(WHITESPACE)))


def text_or_token(c: Column, token: str) -> Column:
    """Text of any column, a missing value becoming the given token."""
    return F.coalesce(c.cast("string"), F.lit(token))


def norm_upper(c: Column, token: str = C.NULL_TOKEN_UPPER) -> Column:
    return F.upper(strip(text_or_token(c, token)))


def norm_lower(c: Column, token: str = C.NULL_TOKEN_LOWER) -> Column:
    return F.lower(strip(text_or_token(c, token)))


def norm_strip(c: Column, token: str = C.NULL_TOKEN_LOWER) -> Column:
    return strip(text_or_token(c, token))


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def map_values(c: Column, pairs: dict[str, str]) -> Column:
    """Replace the listed values, keep all others."""
    return F.coalesce(F.try_element_at(literal_map(pairs), c), c)


def impute_carrier(carrier: Column, flight_id: Column) -> Column:
    """A carrier named UNKNOWN is looked up by the prefix of the flight id."""
    by_prefix = F.try_element_at(literal_map(C.CARRIER_BY_PREFIX), F.substring(flight_id, 1, 2))
    return F.when(carrier == C.CARRIER_UNKNOWN, F.coalesce(by_prefix, carrier)).otherwise(carrier)


def impute_carrier_for_report(carrier: Column, flight_id: Column) -> Column:
    """Same lookup for reports: more spellings of 'unknown', prefix in any case."""
    prefix = F.upper(F.substring(flight_id, 1, 2))
    by_prefix = F.try_element_at(literal_map(C.CARRIER_BY_PREFIX), prefix)
    unresolved = carrier.isin(C.CARRIER_UNRESOLVED_IN_REPORTS)
    return F.when(unresolved, F.coalesce(by_prefix, carrier)).otherwise(carrier)


def collapse_status(status: Column) -> Column:
    return F.when(status.isin(C.STATUS_KEPT), status).otherwise(C.STATUS_DEFAULT)


def binary_gender(gender: Column) -> Column:
    return F.when(gender == "F", "F").otherwise("M")


def route_name(source: Column, destination: Column) -> Column:
    return F.concat(source, F.lit(" to "), destination)
