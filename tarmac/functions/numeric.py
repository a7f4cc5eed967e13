"""Number parsing, rounding, ratios and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac import constants as C


def not_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def try_double(c: Column) -> Column:
    """Number from text; anything that is no plain number gives null.

    The engine also reads Java's `1d` and `2f` suffixes, which are no numbers here.
    """
    text = F.lower(F.trim(c.cast("string")))
    suffixed = F.right(text, F.lit(1)).isin("d", "f") & ~text.contains("inf")
    return not_nan(F.when(suffixed, None).otherwise(c.try_cast("double")))


def typed_double(c: Column) -> Column:
    """Same result for a column that already is numeric, without the text checks."""
    return not_nan(c.cast("double"))


def round2(c: Column) -> Column:
    """Two decimals, ties to the even neighbour of the scaled binary value."""
    return F.rint(c * 100) / 100


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def divide_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def flag(cond: Column) -> Column:
    return cond.cast("int")


def numeric_or_zero(c: Column, kind: str = "double") -> Column:
    """Text or number to a number, missing values as zero, whole numbers cut towards zero."""
    return F.coalesce(try_double(c), F.lit(0.0)).cast(kind)


def in_millions(c: Column) -> Column:
    return c / 1e6


def in_hours(c: Column) -> Column:
    return c / 60


def cents(c: Column) -> Column:
    """Two-decimal quantity as a decimal, so that sums do not depend on the order of rows."""
    return c.cast("decimal(18,2)")


def exact_sum(c: Column) -> Column:
    """Sum of a two-decimal quantity; zero for a group without values."""
    return F.coalesce(F.sum(cents(c)).cast("double"), F.lit(0.0))


def exact_mean(c: Column) -> Column:
    return F.try_divide(F.sum(cents(c)).cast("double"), F.count(c).cast("double"))


def age_group(age: Column) -> Column:
    under, to30, to45, to60, over = C.AGE_GROUPS
    return (
        F.when(age.isNull() | F.isnan(age), C.UNKNOWN_LABEL)
        .when(age < 18, under)
        .when(age <= 30, to30)
        .when(age <= 45, to45)
        .when(age <= 60, to60)
        .otherwise(over)
    )
