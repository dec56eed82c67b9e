"""Arithmetic, rounding and tax expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_col

MONEY = "decimal(18,2)"

# Value added tax of 11 %.
TAX_FACTOR = 1.11
TAX_RATE = 0.11


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division; NULL when the divisor is zero."""
    return F.try_divide(as_col(top).cast("double"), as_col(bottom).cast("double"))


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division; 0 when the divisor is zero or a side is missing."""
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def round_even(column: Column | str, digits: int = 0) -> Column:
    """Half-to-even rounding."""
    return F.bround(as_col(column), digits)


def zero_below(column: Column | str, limit: float) -> Column:
    """0 for values under ``limit``; NULL stays NULL."""
    column = as_col(column)
    return F.when(column < limit, F.lit(0)).otherwise(column)


def tax_base(value: Column | str) -> Column:
    """Value without tax."""
    return as_col(value).cast("double") / F.lit(TAX_FACTOR)


def with_tax(cost: Column | str) -> Column:
    cost = as_col(cost).cast("double")
    return cost + cost * F.lit(TAX_RATE)


def money(column: Column | str) -> Column:
    return as_col(column).cast(MONEY)


def try_money(column: Column | str) -> Column:
    """Text to money; text that is not a number becomes NULL."""
    return as_col(column).try_cast(MONEY)
