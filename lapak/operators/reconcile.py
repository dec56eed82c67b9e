"""Two systems' lines reconciled by digests first.

Most companies, days and stores agree. Each side is summed into one digest per scope that does not
depend on the order of rows; only the lines of scopes whose digests differ are joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import sum0

#: How a line differs.
HERE, THERE, DIFFERENT = "only here", "only there", "different"


def digests(lines: DataFrame, scope: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per scope the number of lines and two independent sums over their hashes.

    Hashes are added as decimals, so no sum overflows, and combined by exclusive-or; lines are summed
    where they lie, and a hot store is one row per task. Values that are equal must have one type on
    both sides.
    """
    row = [F.col(f"`{c}`") for c in columns]
    return lines.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*row).cast("decimal(20,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit("other"), *row)).alias("mix"),
    )


def _all_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in pairs])


def differing_scopes(here: DataFrame, there: DataFrame, scope: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Scopes in which the two sides do not hold the same lines; one that a side lacks is one of them."""
    a, b = digests(here, scope, columns).alias("a"), digests(there, scope, columns).alias("b")
    met = a.join(b, _all_equal([(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in scope]), "full_outer")
    same = _all_equal([(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in ("rows", "sum", "mix")])
    shown = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in scope]
    return met.where(~same).select(*shown)


def reconcile(here: DataFrame, there: DataFrame, scope: Sequence[str], keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Lines that the sides do not share: scope, keys, each value of both sides, and ``state``.

    Lines that repeat a key are added up on each side. A scope whose digests agree is not looked at
    further; that it differs all the same has a chance of about 2 ** -128.
    """
    names = [*scope, *keys]
    open_ = differing_scopes(here, there, scope, [*names, *values])

    def summed(lines: DataFrame, suffix: str) -> DataFrame:
        own = lines.alias("l").join(open_.alias("o"), _all_equal([(F.col(f"l.{c}"), F.col(f"o.{c}")) for c in scope]), "left_semi")
        return own.groupBy(*names).agg(*[sum0(v).alias(v + suffix) for v in values]).withColumn("there" + suffix, F.lit(True))

    a, b = summed(here, "_here").alias("a"), summed(there, "_there").alias("b")
    met = a.join(b, _all_equal([(F.col(f"a.{c}"), F.col(f"b.{c}")) for c in names]), "full_outer")
    same = _all_equal([(F.col(f"{v}_here"), F.col(f"{v}_there")) for v in values])
    state = F.when(F.col("there_there").isNull(), F.lit(HERE)).when(F.col("there_here").isNull(), F.lit(THERE)).when(~same, F.lit(DIFFERENT))
    shown = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in names]
    return met.select(*shown, *[v + s for v in values for s in ("_here", "_there")], state.alias("state")).where("state is not null")
