"""Calendar arithmetic on columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(stamp: str | Column) -> Column:
    return F.to_date(stamp)


def month_start(day: str | Column) -> Column:
    return F.trunc(day, "month")


def days_in_month(day: str | Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def as_date(day: dt.date | Column) -> Column:
    """A run date given as a Python date, or as a column such as a scalar subquery."""
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def months_before(day: dt.date | Column, months: int) -> Column:
    """First day of the month that lies ``months`` before the month of ``day``."""
    return F.add_months(month_start(as_date(day)), -months)


def iso_date_text(day: str | Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def run_stamp(day: dt.date | Column) -> Column:
    return as_date(day).cast("timestamp_ntz")
