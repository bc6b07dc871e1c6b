"""Timestamps without time zone, month arithmetic and small date helpers."""

from __future__ import annotations

import calendar
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(ts: datetime) -> Column:
    """Literal of the column type of the data.

    A zoned literal would make Spark cast the column in a comparison, and the
    filter would no longer reach the file scan.
    """
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def add_months(ts: datetime, months: int) -> datetime:
    """Month arithmetic that clamps to the month end and keeps the time."""
    index = ts.year * 12 + ts.month - 1 + months
    year, month = divmod(index, 12)
    day = min(ts.day, calendar.monthrange(year, month + 1)[1])
    return ts.replace(year=year, month=month + 1, day=day)


def month_starts(last: datetime, count: int) -> list[datetime]:
    """``count`` month starts up to and including the month of ``last``, ascending."""
    first = last.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    return [add_months(first, -i) for i in reversed(range(count))]


def sunday_zero_weekday(ts: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(ts) - 1


def bucket(unit: str, ts: Column) -> Column:
    """Start date of the day, week (Monday) or month of ``ts``."""
    return F.to_date(F.date_trunc(unit, ts))
