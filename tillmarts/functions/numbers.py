"""Casts, ratios and signs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a double of up to 28 digits before and ten after the point holds; sums of it stay exact.
MONEY = "decimal(38,10)"


def safe_cast(col: Column, to: str) -> Column:
    """NULL where the text is not a value of the type."""
    return col.try_cast(to)


def cast_nullif(col: Column, to: str) -> Column:
    """Empty text is NULL; any other text that is not a value of the type is an error."""
    return F.nullif(col, F.lit("")).cast(to)


def coerce_int(col: Column) -> Column:
    """Blank and junk are NULL, decimals are cut towards zero."""
    return F.trim(col).try_cast("double").try_cast("bigint")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Floating division, NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def sign_flip(value: Column, when: Column) -> Column:
    """Negated where ``when`` is true, as it is where false or unknown."""
    return F.when(when, -value).otherwise(value)


def money_sum(col: Column) -> Column:
    """Sum in exact decimal arithmetic, so the result does not depend on row order."""
    return F.sum(col.cast(MONEY)).cast("double")


def fallback_budget(primary: Column, secondary: Column, shares: Column) -> Column:
    """The primary budget when it exceeds 1, else the secondary one, divided by ``shares``."""
    primary, secondary = primary.cast("double"), secondary.cast("double")
    return safe_ratio(F.when(primary > 1, primary).otherwise(secondary), shares)
