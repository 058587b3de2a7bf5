"""Date arithmetic that counts calendar boundaries, and trailing-window predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_of_date(as_of: dt.date | str | Column | None) -> Column:
    """The reporting day: a literal, a column, or today when omitted."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def month_boundaries(start: Column, end: Column) -> Column:
    """Calendar months crossed; Jan 31 to Feb 1 is 1, where Spark's datediff(MONTH) says 0."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def month_number(day: Column) -> Column:
    """Running number of a calendar month, so that differences are month boundaries."""
    return F.year(day) * 12 + F.month(day)


def second_boundaries(start: Column, end: Column) -> Column:
    """Clock seconds crossed; 00.9 to 01.1 is 1, where timestampdiff(SECOND) says 0."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def in_last_days(day: Column, as_of: Column, days: int) -> Column:
    """Lower bound only, inclusive: later days count as well."""
    return day >= F.date_sub(as_of, days)


def in_last_months(day: Column, as_of: Column, months: int, whole_months: bool = False) -> Column:
    """Trailing months from the same day of month, or ``months`` whole calendar months."""
    if whole_months:
        return day >= F.trunc(F.add_months(as_of, 1 - months), "MM")
    return day >= F.add_months(as_of, -months)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


# Weekday names, Monday first.
_WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def weekday_name(moment: Column) -> Column:
    return F.get(F.array(*(F.lit(name) for name in _WEEKDAYS)), F.weekday(moment))
