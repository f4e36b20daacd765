"""Calendar expressions. Dates and times are zone-free throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = str | dt.date


def as_date(value: DateLike) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(value)


def date_lit(value: DateLike) -> Column:
    return F.lit(as_date(value))


def instant(value: DateLike) -> Column:
    """Midnight at the start of a day, in the type of the stored timestamps, so that filters reach the scan."""
    return F.lit(f"{as_date(value).isoformat()} 00:00:00").cast("timestamp_ntz")


def month_start(value: DateLike) -> dt.date:
    return as_date(value).replace(day=1)


def shift_months(value: DateLike, months: int) -> dt.date:
    day = month_start(value)
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def day_after(value: DateLike) -> dt.date:
    return as_date(value) + dt.timedelta(days=1)


def days_before(value: DateLike, days: int) -> dt.date:
    return as_date(value) - dt.timedelta(days=days)


def month_of(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two month starts; negative when `later` is the earlier one."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def age_on(birth: Column, as_of: DateLike) -> Column:
    """Completed years on a day."""
    return F.timestamp_diff("YEAR", birth, date_lit(as_of)).cast("int")
