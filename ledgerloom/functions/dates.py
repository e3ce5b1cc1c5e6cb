"""Calendar helpers.  The as-of date of a run is a plain ISO string."""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(as_of: str) -> str:
    """First day of the month of an ISO date, as ISO text (plan-time constant)."""
    return date.fromisoformat(as_of).replace(day=1).isoformat()


def month_end(as_of: str) -> str:
    """Last day of the month of an ISO date, as ISO text (plan-time constant)."""
    day = date.fromisoformat(as_of)
    return day.replace(day=calendar.monthrange(day.year, day.month)[1]).isoformat()


def as_date(value: str) -> Column:
    """Typed date literal, so comparisons stay date-to-date and push down."""
    return F.lit(date.fromisoformat(value))


def month_start_col(column: Column | str) -> Column:
    """First day of the month of a date column."""
    return F.trunc(column, "month")


def month_end_col(column: Column | str) -> Column:
    """Last day of the month of a date column."""
    return F.last_day(column)


def date_text(column: Column | str, pattern: str) -> Column:
    """Date as text in a pattern such as ``dd/MM/yyyy``."""
    return F.date_format(column, pattern)


def within(column: str, low: str, high: str) -> Column:
    """Closed date interval on a column."""
    return F.col(column).between(as_date(low), as_date(high))
