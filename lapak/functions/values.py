"""Null-aware comparison, conditional and lookup expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def differs(column: Column | str, value: Any) -> Column:
    """``column != value`` that keeps rows whose column is NULL."""
    return ~as_col(column).eqNullSafe(F.lit(value))


def is_in(column: Column | str, values: Iterable[Any]) -> Column:
    """Membership that is false (never NULL) for a NULL column."""
    return F.coalesce(as_col(column).isin(list(values)), F.lit(False))


def not_in(column: Column | str, values: Iterable[Any]) -> Column:
    """Non-membership that keeps rows whose column is NULL."""
    return ~is_in(column, values)


def first_match(cases: Iterable[tuple[Column, Any]], default: Any = None) -> Column:
    """The value of the first true condition; a NULL condition counts as false."""
    result = None
    for condition, value in cases:
        result = (F if result is None else result).when(condition, value)
    return result.otherwise(default)


def _literal_map(mapping: Mapping[Any, Any]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_values(column: Column | str, mapping: Mapping[Any, Any]) -> Column:
    """Dictionary lookup; values without an entry become NULL."""
    return F.try_element_at(_literal_map(mapping), as_col(column))


def replace_values(column: Column | str, mapping: Mapping[Any, Any]) -> Column:
    """Dictionary replacement; values without an entry are kept."""
    return F.coalesce(map_values(column, mapping), as_col(column))


def zero_if_null(column: Column | str) -> Column:
    return F.coalesce(as_col(column), F.lit(0))


def sum0(column: Column | str) -> Column:
    """Sum that is 0, not NULL, for a group holding only NULLs."""
    return F.coalesce(F.sum(as_col(column)), F.lit(0))


def nan_to_null(column: Column | str) -> Column:
    column = as_col(column)
    return F.when(~F.isnan(column), column)


def all_present(names: Iterable[str]) -> Column:
    """True where no listed column is NULL.

    One test per column: unlike ``dropna`` each can be pushed down and inferred on its own.
    """
    result = F.lit(True)
    for name in names:
        result = result & F.col(f"`{name}`").isNotNull()
    return result
