"""Join shapes.

Dimensions carry no broadcast hint: Spark broadcasts a side only when its statistics (or, at
run time, the measured stage size) are under ``spark.sql.autoBroadcastJoinThreshold``, and
otherwise shuffles both sides, splitting hot keys of the preserved side. Facts are always on
the left, so their side is the one that may be split. Only calendar sides, which hold a few
rows per calendar date whatever the amount of sales, are marked with ``bounded=True``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Sequence[str] | Mapping[str, str]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(k, k) for k in on]


def _quoted(names: Iterable[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _equal(pairs: Iterable[tuple[str, str]], null_safe: bool) -> Column:
    """Equality of left and (renamed, so unambiguous) right key columns."""
    tests = []
    for a, b in pairs:
        left, right = F.col(f"`{a}`"), F.col(f"`{b}`")
        tests.append(left.eqNullSafe(right) if null_safe else left == right)
    return reduce(lambda x, y: x & y, tests)


def keep_facts(
    facts: DataFrame,
    dimension: DataFrame,
    on: Keys,
    null_safe: bool | None = None,
    suffix: str = "",
    flag: str | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Left join that returns the fact columns, then the dimension's non-key columns.

    Missing keys match missing keys, unless told otherwise or ``bounded``. This also matters
    for hot keys: a side that was grouped or deduplicated on the plain key would be joined
    without another shuffle, and Spark splits a hot key only between two fresh shuffles.

    ``suffix`` renames dimension columns that collide; ``flag`` adds a boolean match column;
    ``bounded`` asks for a broadcast and is only for sides whose size cannot grow with the data.
    """
    null_safe = not bounded if null_safe is None else null_safe
    pairs = _pairs(on)
    keys = {b: f"__k_{b}" for _, b in pairs}
    fact_names = facts.columns
    renamed = {
        c: keys.get(c) or (c + suffix if c in fact_names else c) for c in dimension.columns
    }
    extra = [n for c, n in renamed.items() if c not in keys]
    if clash := set(extra) & set(fact_names):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    right = dimension.withColumnsRenamed(renamed)
    if flag:
        right = right.withColumn(flag, F.lit(True))
    if bounded:
        right = F.broadcast(right)
    joined = facts.join(right, _equal([(a, keys[b]) for a, b in pairs], null_safe), "left")
    out = _quoted([*fact_names, *extra])
    if flag:
        out.append(F.coalesce(F.col(flag), F.lit(False)).alias(flag))
    return joined.select(*out)


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer equi-join in which NULL keys match; each key appears once."""
    names = {c: f"__k_{c}" for c in on}
    others = [c for c in right.columns if c not in names]
    joined = left.join(right.withColumnsRenamed(names), _equal(names.items(), True), "full")
    keys = [F.coalesce(*_quoted([k, n])).alias(k) for k, n in names.items()]
    rest = [c for c in left.columns if c not in names] + others
    return joined.select(*keys, *_quoted(rest))


def _key_side(other: DataFrame, on: Keys) -> tuple[DataFrame, list[tuple[str, str]]]:
    pairs = _pairs(on)
    keys = other.select(*[F.col(f"`{b}`").alias(f"__k_{b}") for _, b in pairs])
    return keys, [(a, f"__k_{b}") for a, b in pairs]


def present_in(df: DataFrame, other: DataFrame, on: Keys, bounded: bool = False) -> DataFrame:
    """Rows whose key exists in ``other``."""
    keys, pairs = _key_side(other, on)
    return df.join(F.broadcast(keys) if bounded else keys, _equal(pairs, False), "left_semi")


def absent_from(
    df: DataFrame, other: DataFrame, on: Keys, null_safe: bool = False, bounded: bool = False
) -> DataFrame:
    """Rows whose key does not exist in ``other``."""
    keys, pairs = _key_side(other, on)
    return df.join(F.broadcast(keys) if bounded else keys, _equal(pairs, null_safe), "left_anti")


def attach_totals(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Group totals written onto every row of the group (NULL keys form a group).

    The totals are partially aggregated before their shuffle and joined back, so a group that
    holds a large share of all rows is never gathered in one task, as it would be in a window.
    """
    source = df if source is None else source
    sums = source.groupBy(*keys).agg(*[c.alias(n) for n, c in totals.items()])
    return keep_facts(df, sums, list(keys), null_safe=True)


def with_leading_zero_retry(
    facts: DataFrame,
    code: str,
    dimension: DataFrame,
    dim_code: str,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Match ``code`` exactly, else as ``"0" + code``, within equal ``scope`` columns.

    Dimension codes must be unique in their scope. The retry is folded into the dimension:
    each row is also listed under its code without the leading zero, the better entry per
    code is kept, and the facts are joined once.
    """
    own = F.col(dim_code)
    shorter = F.when(own.startswith("0"), F.substr(own, F.lit(2)))
    entries = F.array(
        F.struct(own.alias("look_up"), F.lit(1).alias("rank")),
        F.struct(shorter.alias("look_up"), F.lit(2).alias("rank")),
    )
    keyed = best_per_code(dimension.select("*", F.inline(entries)), scope)
    return keep_facts(facts, keyed, {**{s: s for s in scope}, code: "look_up"})


def best_per_code(listed: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Of rows listed under several ``look_up`` codes keep the lowest ``rank`` per code."""
    listed = listed.where(F.col("look_up").isNotNull())
    rest = [c for c in listed.columns if c not in ("look_up", "rank", *scope)]
    best = listed.groupBy(*scope, "look_up").agg(F.min(F.struct("rank", *rest)).alias("best"))
    return best.select(*scope, "look_up", "best.*").drop("rank")
