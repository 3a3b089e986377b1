"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def previous_month(month: Column) -> Column:
    return F.add_months(month, -1)


def replay_date(day: Column, year: int) -> Column:
    """Same month and day in another year; Feb 29 falls back to Feb 28.

    The last day of the target month bounds the day number, because
    ``make_date`` raises on an impossible date in ANSI mode.
    """
    first = F.make_date(F.lit(year), F.month(day), F.lit(1))
    return F.make_date(
        F.lit(year), F.month(day), F.least(F.dayofmonth(day), F.dayofmonth(F.last_day(first)))
    )


def replay_day(today: dt.date, year: int) -> dt.date:
    """The same rule for the one date a scheduled run starts from."""
    if (today.month, today.day) == (2, 29):
        next_day = dt.date(year, 2, 28) + dt.timedelta(days=1)
        return next_day if next_day.month == 2 else dt.date(year, 2, 28)
    return today.replace(year=year)


def day_range(start: dt.date, end: dt.date) -> list[dt.date]:
    """Every day of an inclusive range; an inverted range is an error."""
    if end < start:
        raise ValueError(f"end {end} is before start {start}")
    return [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]


def calendar_attributes(day: Column) -> list[Column]:
    """Year, month, quarter and day columns of a report calendar."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month_no"),
        F.date_format(day, "MMMM").alias("month"),
        F.quarter(day).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(day).cast("string")).alias("quarter"),
        F.dayofmonth(day).alias("day"),
    ]
