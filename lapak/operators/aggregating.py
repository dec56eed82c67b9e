"""Grouped sums, pivots, accumulations and control totals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import snake
from ..functions.values import all_present, sum0
from .joining import keep_facts


def group_sum(df: DataFrame, keys: Sequence[str], *measures: str, **aggregates: Column) -> DataFrame:
    """Sums (0 for all-NULL groups) and named aggregates; rows with a NULL key are left out."""
    columns = [sum0(m).alias(m) for m in measures] + [c.alias(n) for n, c in aggregates.items()]
    return df.where(all_present(keys)).groupBy(*keys).agg(*columns)


def pivot_sum(
    df: DataFrame, keys: Sequence[str], pivot: str, value: str, values: Sequence[str]
) -> DataFrame:
    """One summed column per listed value, 0 where there is none.

    Conditional sums need one shuffle; ``pivot`` would aggregate twice.
    """
    return df.where(all_present(keys)).groupBy(*keys).agg(
        *[sum0(F.when(F.col(pivot) == v, F.col(value))).alias(snake(v)) for v in values]
    )


def melt(df: DataFrame, ids: Sequence[str], name: str, value: str) -> DataFrame:
    """Every non-id column to a (name, value) row."""
    return df.unpivot(list(ids), [c for c in df.columns if c not in ids], name, value)


def header_totals(df: DataFrame, keys: Sequence[str], *measures: str) -> DataFrame:
    """One row per header; continuation lines (a NULL header field) are left out."""
    return group_sum(df, keys, *measures)


def split_sums(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], condition: Column, suffix: str
) -> DataFrame:
    """Sums over all rows and over the rows meeting ``condition``, in one pass."""
    chosen = F.coalesce(condition, F.lit(False))
    partial = {f"{m}{suffix}": sum0(F.when(chosen, F.col(m))) for m in measures}
    return group_sum(df, keys, *measures, **partial)


def running_total(
    df: DataFrame, keys: Sequence[str], period: str, measures: Mapping[str, str]
) -> DataFrame:
    """Cumulative measures over an ordered period.

    Grouped to one row per key and period first, so the window holds at most one row per
    period (twelve for a year of months).
    """
    grouped = group_sum(df, [*keys, period], *measures)
    window = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return grouped.withColumns({new: F.sum(m).over(window) for m, new in measures.items()})


def target_levels(
    targets: DataFrame, keys: Sequence[str], month: str = "month", value: str = "target"
) -> DataFrame:
    """Daily targets with their monthly and whole-project sums."""
    monthly = targets.groupBy(month, *keys).agg(sum0(value).alias("target_monthly"))
    project = monthly.groupBy(*keys).agg(sum0("target_monthly").alias("target_project"))
    return keep_facts(keep_facts(targets, project, list(keys)), monthly, [month, *keys])


def control_total(
    before: DataFrame, before_column: str, after: DataFrame, after_column: str, name: str, digits: int = 2
) -> DataFrame:
    """One row telling whether a measure has the same total before and after a step.

    Both sides go through one aggregate.
    """
    rows = two_sided(before.select(F.col(before_column).alias("amount_before")), after.select(F.col(after_column).alias("amount_after")))
    totals = rows.agg(*[F.bround(sum0(c), digits).cast("double").alias(c) for c in ("amount_before", "amount_after")])
    return totals.select(
        F.lit(name).alias("check_name"),
        "amount_before",
        "amount_after",
        (F.col("amount_before") == F.col("amount_after")).alias("is_matched"),
    )


def observed_write(df: DataFrame, name: str, measures: Mapping[str, Column], write: Callable[[DataFrame], None]) -> dict[str, Any]:
    """Aggregates over exactly the rows that ``write`` writes, collected by the write itself.

    The rows are counted as they go by in the tasks that write them, so a control total costs no
    second scan. ``write`` must write what it is given in one job without a shuffle of its own: then
    only results of tasks that were committed count, also where one had to be repeated.
    """
    observation = Observation(name)
    write(df.observe(observation, *[c.alias(n) for n, c in measures.items()]))
    return observation.get


def compared_totals(spark: SparkSession, rows: Sequence[tuple[str, Any, Any]]) -> DataFrame:
    """check_name, amount_before, amount_after, is_matched of totals that are known already; NULL never matches."""
    shown = [(n, *[None if v is None else float(v) for v in (a, b)]) for n, a, b in rows]
    totals = spark.createDataFrame(shown, "check_name string, amount_before double, amount_after double")
    return totals.withColumn("is_matched", F.coalesce(F.col("amount_before") == F.col("amount_after"), F.lit(False)))


def two_sided(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of both frames, the other's columns NULL; shared columns are filled by both."""
    return before.unionByName(after, allowMissingColumns=True)


def processing_log(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Rows, quantity and paid value by channel with a processing stamp."""
    stamp = F.current_timestamp() if stamp is None else stamp
    logged = group_sum(
        df, ["channel"], "quantity", "cust_paid_peritem", row=F.count(F.lit(1))
    )
    return logged.withColumns(
        {
            "date_process": F.date_format(stamp, "yyyy-MM-dd"),
            "time_process": F.date_format(stamp, "HH:mm:ss"),
        }
    )
