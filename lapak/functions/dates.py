"""Date parsing, business-calendar expressions and rebuild periods."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_col, first_match

# Offset of the business time zone and weight of each weekday.
LOCAL_OFFSET_HOURS = 7
DAY_SCORES = {"Saturday": 2.0, "Sunday": 2.0, "Friday": 1.5}
OTHER_DAY_SCORE = 1.0


def parse_timestamp(column: Column | str, *formats: str) -> Column:
    """First format that fits; text that fits none becomes NULL."""
    column = as_col(column)
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)) for f in formats])


def parse_date(column: Column | str, *formats: str) -> Column:
    return F.to_date(parse_timestamp(column, *formats))


def local_time(column: Column | str, hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """UTC timestamp shifted to business time."""
    return as_col(column) + F.expr(f"INTERVAL {int(hours)} HOURS")


def week_of_month(day: Column) -> Column:
    """Days 1-7 are week 1, 8-14 week 2, and so on."""
    return (F.floor((day - 1) / 7) + 1).cast("int")


def week_label(column: Column | str) -> Column:
    return F.concat(F.lit("Week "), week_of_month(F.dayofmonth(as_col(column))).cast("string"))


def project_day(column: Column | str, start: dt.date) -> Column:
    """Day number counted from the start of a campaign that may cross months."""
    return F.datediff(as_col(column), F.lit(start)) + 1


def day_name(column: Column | str) -> Column:
    return F.date_format(as_col(column), "EEEE")


def month_name(column: Column | str) -> Column:
    return F.date_format(as_col(column), "MMMM")


def month_number(column: Column | str) -> Column:
    return F.date_format(as_col(column), "MM")


def day_score(column: Column | str) -> Column:
    name = day_name(column)
    return first_match(
        [(name == day, F.lit(score)) for day, score in DAY_SCORES.items()], F.lit(OTHER_DAY_SCORE)
    )


def gap_days(later: Column | str, earlier: Column | str) -> Column:
    return F.abs(F.datediff(as_col(later), as_col(earlier)))


def in_month(column: Column | str, month: dt.date) -> Column:
    """Range predicate on a date column, which can be pushed into the scan."""
    first = month.replace(day=1)
    after = (first + dt.timedelta(days=32)).replace(day=1)
    return (as_col(column) >= F.lit(first)) & (as_col(column) < F.lit(after))


def previous_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def next_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def rebuild_months(as_of: dt.date, late_until: int = 5) -> list[dt.date]:
    """Months to rebuild: the previous one on day 1, both until ``late_until``, then this one."""
    this, last = as_of.replace(day=1), previous_month(as_of)
    if as_of.day == 1:
        return [last]
    return [last, this] if as_of.day <= late_until else [this]


def drop_months(as_of: dt.date, present: set[str]) -> list[str]:
    """``yyyy-MM`` periods of a raw drop that may still change; on day 31 only the current one."""
    wanted = [as_of.replace(day=1)]
    if as_of.day < 31:
        wanted.append(previous_month(as_of))
    return [f"{m:%Y-%m}" for m in wanted if f"{m:%Y-%m}" in present]


def reference_date(as_of: dt.date) -> dt.date:
    """Reports run one day behind."""
    return as_of - dt.timedelta(days=1)
