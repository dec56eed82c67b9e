"""Collects registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shapes import Shapes, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Rounded as decimals: a quotient such as 0.00125 is then a tie for both engines or for neither.
FINE = "decimal(28,8)"
DIGITS = 4


def comparable(df: DataFrame) -> DataFrame:
    """Numbers as doubles of four digits and times as text, the form the SQL side returns."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double").cast(FINE), DIGITS).cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        out.append(column.alias(field.name))
    return df.select(*out)


def ts(sql: str) -> str:
    return f"strftime({sql}, '%Y-%m-%d %H:%M:%S')"


def r(sql: str) -> str:
    return f"CAST(round(CAST(CAST({sql} AS DOUBLE) AS {FINE}), {DIGITS}) AS DOUBLE)"


def rs(names: str) -> str:
    """``a, b`` as rounded doubles under their own names."""
    return ", ".join(f"{r(n.strip())} AS {n.strip()}" for n in names.split(","))


def with_shapes(body: str, *shapes: str) -> str:
    """A query over the named shapes; ``body`` is a SELECT or further CTEs and a SELECT."""
    definitions = duck(*shapes)
    if not definitions:
        return body
    joint = "\n" if body.lstrip().upper().startswith("SELECT") else ",\n"
    return f"WITH {definitions}{joint}{body}"


def query(sql: str | None = None, shapes: str = "", name: str | None = None):
    """Register a function of :class:`Shapes`; ``shapes`` are the CTEs its SQL starts from."""

    def register(function: Callable[[Shapes], DataFrame]):
        key = name or function.__name__
        assert key not in QUERIES, key

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(Shapes(spark, sf_dir)))

        run.__doc__ = function.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = with_shapes(sql, *shapes.split())
        return function

    return register
