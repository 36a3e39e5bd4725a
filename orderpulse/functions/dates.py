"""Day arithmetic and day filters that reach the scan."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

LOOKBACK_DAYS = 31


def parse_day(text: str | None) -> date:
    """`YYYY-MM-DD`, or yesterday when nothing is given."""
    return date.fromisoformat(text) if text else date.today() - timedelta(days=1)


def trailing_bounds(as_of: date, lookback_days: int = LOOKBACK_DAYS) -> tuple[date, date]:
    """First and last day of the baseline: the days before `as_of`, that day excluded."""
    return as_of - timedelta(days=lookback_days), as_of - timedelta(days=1)


def in_days(moment: Column, first: date | None, last: date | None) -> Column:
    """True for moments on the days first..last; without one of them that side is open.

    A half-open range on the bare column, so that it works for date and timestamp columns
    alike and is pushed to the file reader or prunes partitions.
    """
    after = F.lit(True) if first is None else moment >= F.lit(first)
    return after if last is None else after & (moment < F.lit(last + timedelta(days=1)))


def in_day_parts(year: Column, month: Column, day: Column, first: date, last: date) -> Column:
    """The same for tables partitioned by year, month and day."""
    return F.make_date(year, month, day).between(F.lit(first), F.lit(last))


def utc_day(moment: Column) -> Column:
    """The UTC day of a moment, whatever the session's time zone."""
    return F.to_date(F.to_utc_timestamp(moment, F.current_timezone()))


def date_parts(moment: Column) -> list[Column]:
    return [F.year(moment).alias("year"), F.month(moment).alias("month"), F.day(moment).alias("day")]
