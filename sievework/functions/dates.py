"""Dates and periods in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_bounds(day: Column) -> tuple[Column, Column]:
    """First and last Unix second of an ISO day."""
    start = F.unix_timestamp(F.to_timestamp(day, "yyyy-MM-dd"))
    return start, start + 86_399


def _dated(moment: Column, rest: str) -> Column:
    """The year of a moment, four digits from 0 to 9999 and bare elsewhere, where a pattern would put signs and zeros, before the rest."""
    y = F.year(moment)
    bare = F.when(y.between(0, 9999), F.lpad(y.cast("string"), 4, "0")).otherwise(y.cast("string"))
    return F.concat(bare, F.date_format(moment, rest))


def month_of(seconds: Column) -> Column:
    return _dated(F.timestamp_seconds(seconds), "-MM")


def iso_day(seconds: Column) -> Column:
    return _dated(F.timestamp_seconds(seconds), "-MM-dd")


def period_start(day: Column, reset_day: int) -> Column:
    """The last reset day on or before a day; a reset day past a month's end is that month's last day."""

    def reset_in(month: Column) -> Column:
        return F.date_add(F.trunc(month, "month"), F.least(F.lit(reset_day), F.day(F.last_day(month))) - 1)

    here = reset_in(day)
    return F.when(day >= here, here).otherwise(reset_in(F.add_months(F.trunc(day, "month"), -1)))


def is_fresh(checked: Column, today: Column, days: int) -> Column:
    """Whether an ISO day is at most ``days`` old; what cannot be read is stale."""
    return F.coalesce(F.datediff(today, F.try_to_timestamp(checked, F.lit("yyyy-MM-dd")).cast("date")) <= days, F.lit(False))


def decade(year: Column) -> Column:
    return F.floor(year / 10) * 10


def year_span(first: Column, last: Column) -> Column:
    """``1950`` or ``1950-1955``."""
    return F.when(last.isNull() | (last == first), first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))
