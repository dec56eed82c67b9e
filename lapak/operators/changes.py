"""Tables that change: report upsert with a change log, replace-by-date, store versions.

Plain Parquet has no row update, so each operator returns new frames; the caller writes a new
version or overwrites the touched partitions, never the path being read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joining import absent_from, keep_facts

# Business keys: the whole grain of each report, so one new row meets at most one old row.
ACCUMULATION_KEY = (
    "dataareaid", "axcode", "order_create_date", "itemid", "umbrellabrand", "subbrand", "world",
    "category", "subcategory",
)
PROMO_KEY = ("dataareaid", "axcode", "order_create_date", "promocode", "remarks")
TWO_DIGIT_WORDS = ("cust_paid_peritem", "hpp_total")


class Upsert(NamedTuple):
    merged: DataFrame
    inserts: DataFrame
    log: DataFrame


def _is_changed(old: Column, new: Column) -> Column:
    """A new value that is missing never counts as a change."""
    return new.isNotNull() & ~old.eqNullSafe(new)


def round_report(df: DataFrame) -> DataFrame:
    """Money of a report to two digits, missing floor space to 0."""
    out = {
        c: F.bround(F.col(c), 2)
        for c in df.columns
        if any(w in c for w in TWO_DIGIT_WORDS)
        and isinstance(df.schema[c].dataType, (T.DecimalType, T.DoubleType))
    }
    if "sqm" in df.columns:
        out["sqm"] = F.coalesce(F.col("sqm"), F.lit(0).cast(df.schema["sqm"].dataType))
    return df.withColumns(out)


def one_per_key(load: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: of several the greatest by its other columns, in their order."""
    others = [F.col(f"`{c}`") for c in load.columns if c not in key]
    if not others:
        return load.distinct()
    best = load.groupBy(*[F.col(f"`{k}`") for k in key]).agg(F.max(F.struct(*others)).alias("__best"))
    return best.select(*[F.col(f"`{k}`") for k in key], "__best.*").select(*[F.col(f"`{c}`") for c in load.columns])


def upsert(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    table: str,
    ident: str = "id",
    stamp: Column | None = None,
) -> Upsert:
    """Set-based update-or-insert.

    ``merged`` is the existing table with changed values replaced, ``inserts`` the rows whose
    key is new (their id is given by the target table), ``log`` one row per updated row with the
    changed values as JSON. Applying the same load again changes nothing. A key that the load
    repeats counts once (``one_per_key``).
    """
    stamp = F.current_timestamp() if stamp is None else stamp
    new = one_per_key(new, key)
    values = [c for c in new.columns if c not in key and c != ident and c in existing.columns]
    load = new.select(
        *[F.col(k).alias(f"__k_{k}") for k in key],
        *[F.col(c).cast(existing.schema[c].dataType).alias(f"__new_{c}") for c in values],
    )
    paired = keep_facts(existing, load, {k: f"__k_{k}" for k in key}, null_safe=True)
    changed = {c: _is_changed(F.col(c), F.col(f"__new_{c}")) for c in values}
    merged = paired.select(
        *[
            F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in values else F.col(c)
            for c in existing.columns
        ]
    )
    pairs = [F.when(changed[c], F.col(f"__new_{c}").cast("string")) for c in values]
    names = F.array(*[F.lit(c) for c in values])
    changes = F.map_filter(
        F.map_from_arrays(names, F.array(*pairs)), lambda _, v: v.isNotNull()
    )
    log = (
        paired.select(F.col(ident), changes.alias("changed"))
        .where(F.size("changed") > 0)
        .select(
            ident,
            F.lit(table).alias("table_name"),
            F.lit("update").alias("operation"),
            F.to_json("changed").alias("changes"),
            stamp.alias("timestamp"),
        )
    )
    return Upsert(merged, absent_from(new, existing, list(key), null_safe=True), log)


def replace_by_date(
    existing: DataFrame, arrived: DataFrame, date: str, scope: Sequence[str] = ()
) -> DataFrame:
    """A re-delivered date replaces the rows of that date; other dates stay.

    The rule is the calendar day, also where ``date`` is a timestamp. ``scope`` names what a delivery
    is complete for (brand, marketplace): rows of another scope on the same day stay. NULL is a
    scope of its own; existing rows without a date stay.
    """
    day = "__day"

    def day_of(df: DataFrame) -> Column:
        timed = isinstance(df.schema[date].dataType, (T.TimestampType, T.TimestampNTZType))
        return (F.to_date(date) if timed else F.col(date)).alias(day)

    days = arrived.select(*scope, day_of(arrived)).where(F.col(day).isNotNull()).distinct()
    kept = absent_from(existing.select("*", day_of(existing)), days, [*scope, day], null_safe=True)
    return kept.drop(day).unionByName(arrived, allowMissingColumns=True)


STORE_VERSION = ("start_date", "end_date", "create_date", "update_date", "current_status")


def store_versions(
    existing: DataFrame, new: DataFrame, as_of: Column, code: str = "store_code"
) -> DataFrame:
    """Next version of the store dimension.

    A store with any changed attribute gets its current row closed and one new current row; a
    new store gets a current row; an unchanged store, an older version and a store missing from
    the load stay as they are. Missing equals missing. New rows take keys above the largest.
    """
    attributes = [c for c in new.columns if c in existing.columns and c not in (code, *STORE_VERSION)]
    load = new.select(
        F.col(code).alias("__code"), *[F.col(c).cast(existing.schema[c].dataType).alias(f"__new_{c}") for c in attributes]
    )
    current = existing.where("current_status = 'current'")
    older = existing.where(~F.col("current_status").eqNullSafe("current"))
    paired = current.join(load, current[code] == load["__code"], "full")
    is_new = F.col(code).isNull()
    loaded = F.col("__code").isNotNull()
    differs = F.lit(False)
    for c in attributes:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__new_{c}"))
    changed = ~is_new & loaded & differs

    def typed(column: Column, name: str) -> Column:
        return column.cast(existing.schema[name].dataType).alias(name)

    missing = F.lit(None)

    def kept(closing: Column) -> Column:
        own = {
            "end_date": F.when(closing, as_of).otherwise(F.col("end_date")),
            "update_date": F.when(closing, as_of).otherwise(F.col("update_date")),
            "current_status": F.when(closing, F.lit("previous")).otherwise(F.col("current_status")),
        }
        return F.struct(*[typed(own.get(c, F.col(c)), c) for c in existing.columns])

    def opened() -> Column:
        fixed = {
            code: F.col("__code"), "start_date": as_of, "end_date": missing,
            "create_date": as_of, "update_date": as_of, "current_status": F.lit("current"),
            "store_key": missing,
        }
        return F.struct(
            *[
                typed(fixed[c] if c in fixed else F.col(f"__new_{c}") if c in attributes else missing, c)
                for c in existing.columns
            ]
        )

    rows = F.array_compact(
        F.array(F.when(~is_new, kept(changed)), F.when(is_new | changed, opened()))
    )
    versions = paired.select(F.inline(rows)).unionByName(older)
    return _with_store_keys(versions, existing) if "store_key" in existing.columns else versions


def _with_store_keys(versions: DataFrame, existing: DataFrame) -> DataFrame:
    """Give rows without a key the next free numbers, in store code order."""
    from .dedup import number_rows

    fresh = versions.where("store_key IS NULL").drop("store_key")
    order = ["store_code", *[c for c in fresh.columns if c != "store_code"]]
    # One value, an aggregate of the table.
    last = existing.agg(F.max("store_key")).first()[0] or 0
    keyed = number_rows(fresh, order, name="__n").withColumn(
        "store_key", (F.col("__n") + F.lit(last)).cast(existing.schema["store_key"].dataType)
    ).select(*existing.columns)
    return versions.where("store_key IS NOT NULL").unionByName(keyed)
