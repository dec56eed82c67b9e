"""Business calendar: each date with its counterpart last month and last year.

A calendar holds one row per date, so its side of a join is broadcast: its size does not grow
with the sales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_name, day_score, month_number, week_label
from .joining import keep_facts


def calendar_pattern(pattern: DataFrame) -> DataFrame:
    """Pattern rows with an id of all three dates; a missing counterpart is an empty part."""
    dates = ["pattern_date", "pattern_lm", "pattern_last_year"]
    text = [F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit("")) for d in dates]
    ident = F.concat(text[0], F.lit("/"), text[1], F.lit("/"), text[2])
    return pattern.select(ident.alias("id"), *dates)


def date_dimension(pattern: DataFrame) -> DataFrame:
    """Weekday, weight of the day and weight of its whole month, per pattern date."""
    days = pattern.select(
        "id",
        "pattern_date",
        day_name("pattern_date").alias("day_name"),
        day_score("pattern_date").alias("day_score"),
        F.dayofmonth("pattern_date").alias("day"),
        week_label("pattern_date").alias("week"),
        month_number("pattern_date").alias("month"),
    )
    period = F.trunc("pattern_date", "month")
    months = days.groupBy(period.alias("__period")).agg(F.sum("day_score").alias("month_score"))
    return keep_facts(
        days.withColumn("__period", period), months, ["__period"], null_safe=True, bounded=True
    ).drop("__period")


def shift_dates(sales: DataFrame, pattern: DataFrame, date: str, pattern_date: str) -> DataFrame:
    """Sales keyed by the calendar row whose ``pattern_date`` column they fall on.

    Sales outside the calendar are left out; one sale counts for every row naming its date.
    """
    rows = pattern.select("id", F.col(pattern_date).alias("__date"))
    joined = sales.join(F.broadcast(rows), F.col(date) == F.col("__date"), "inner")
    return joined.drop("__date")
