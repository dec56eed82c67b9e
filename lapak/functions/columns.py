"""Whole-frame column operations: renames, fills, type-driven edits."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.toDF(*[rule(name) for name in df.columns])


def camel_to_snake(name: str) -> str:
    """``StorePosID`` to ``store_pos_id``: a break before each capital that starts a word."""
    broken = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Za-z0-9])(?=[A-Z][a-z])", "_", name)
    return broken.lower()


def snake(name: str) -> str:
    return name.lower().replace(" ", "_")


def report_title(name: str, words: Mapping[str, str] | None = None) -> str:
    """``cust_paid_peritem_ly`` to ``Sales Last Year`` with the given word replacements."""
    for old, new in (words or {}).items():
        name = name.replace(old, new)
    return name.replace("_", " ").title()


def drop_matching(df: DataFrame, text: str) -> DataFrame:
    """Drop every column whose name holds ``text``."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if text not in c])


def col_or(df: DataFrame, name: str, default: Any = 0) -> Column:
    """The column, or a constant where the frame has no such column."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return default if isinstance(default, Column) else F.lit(default)


def conform(df: DataFrame, names: Sequence[str], defaults: Mapping[str, Any] | None = None) -> DataFrame:
    """Project to exactly ``names``; missing ones take a default or NULL text."""
    defaults = defaults or {}
    missing = F.lit(None).cast("string")
    return df.select(*[col_or(df, n, defaults.get(n, missing)).alias(n) for n in names])


def columns_of_type(df: DataFrame, *types: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def fill_by_type(df: DataFrame, number: float | None = 0, text: str | None = None) -> DataFrame:
    """Fill numeric and text columns separately in a single projection."""
    numeric = set(columns_of_type(df, T.NumericType))
    textual = set(columns_of_type(df, T.StringType))
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if number is not None and field.name in numeric:
            column = F.coalesce(column, F.lit(number).cast(field.dataType))
        elif text is not None and field.name in textual:
            column = F.coalesce(column, F.lit(text))
        out.append(column.alias(field.name))
    return df.select(*out)


def round_columns(df: DataFrame, names: Iterable[str], digits: int) -> DataFrame:
    return df.withColumns({n: F.bround(F.col(n), digits) for n in names})


def fill_from(df: DataFrame, target: str, *sources: str) -> DataFrame:
    """NULLs of ``target`` take the first non-NULL source."""
    return df.withColumn(target, F.coalesce(F.col(target), *[F.col(s) for s in sources]))
