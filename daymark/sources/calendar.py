"""Calendar rows: one per day, with ISO week and month length."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.dates import days_in_month
from daymark.functions.predicates import etl_window


def date_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day of ``[first, last]``."""
    week = F.trunc("date", "week")
    return spark.range(1, numPartitions=1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("date")
    ).select(
        "date",
        week.alias("start_iso_week_date"),
        F.date_add(week, 6).alias("end_iso_week_date"),
        days_in_month("date").cast("smallint").alias("month_days_no"),
    )


def run_calendar(calendar: DataFrame, etl_date: dt.date) -> DataFrame:
    """Calendar rows of the run window: at most the days of two months."""
    return whole_calendar(calendar).filter(etl_window("calendar_date", etl_date))


def whole_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        F.col("date").alias("calendar_date"),
        "start_iso_week_date",
        "end_iso_week_date",
        F.col("month_days_no").alias("num_of_day_in_month"),
    )
