"""Salted hashes and pseudonyms for personal data. The salt is always given by the caller."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac import constants as C
from tarmac.functions.text import strip, text_or_token


def hash_salt_last(c: Column, salt: str) -> Column:
    """SHA-256 of the stripped text followed by the salt; a marker for missing values."""
    value = strip(text_or_token(c, ""))
    missing = F.upper(value).isin("", "NAN", "NONE")
    return F.when(missing, C.HASH_MISSING).otherwise(F.sha2(F.concat(value, F.lit(salt)), 256))


def hash_salt_first(c: Column, salt: str) -> Column:
    """SHA-256 of `salt:text` with the text as it is; null for missing values."""
    value = text_or_token(c, "")
    missing = strip(value).isin("", "nan", "None")
    return F.when(~missing, F.sha2(F.concat(F.lit(salt + ":"), value), 256))


def packed_hash(c: Column) -> tuple[Column, Column]:
    """A hash in hexadecimal as bytes, half as long, and any other text as it is: one of the two columns is null.
    `unpacked_hash` gives the text back."""
    raw = F.unhex(c)
    is_hash = F.coalesce(F.lower(F.hex(raw)) == c, F.lit(False))
    return F.when(is_hash, raw), F.when(~is_hash, c)


def unpacked_hash(raw: Column, text: Column) -> Column:
    return F.coalesce(F.lower(F.hex(raw)), text)


def initial_of_stripped(c: Column) -> Column:
    """First letter and stars; blank text gives N***, a missing value n*** (its text is 'nan')."""
    value = strip(text_or_token(c, C.NULL_TOKEN_LOWER))
    return F.when(value == "", "N***").otherwise(F.concat(F.substring(value, 1, 1), F.lit("***")))


def initial_or_stars(c: Column) -> Column:
    """First character as it stands and stars; only stars for missing or empty text."""
    return F.concat(F.substring(text_or_token(c, ""), 1, 1), F.lit("***"))
