"""Rolling 30- and 7-day users and metered readers per account."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.dates import as_date, months_before
from daymark.functions.predicates import etl_window, lookback_window
from daymark.operators.joins import full_join_tested
from daymark.operators.rolling import rolling_members
from daymark.plans.events import KEYS, run_dimension, run_rolling_activity, stamped
from daymark.schemas import COUNT_USER_ROLLING_DAYS, enforce_schema
from daymark.sources.tables import scan_metering


def lookback_metering(
    inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    return scan_metering(inputs.metering, vocabulary).filter(
        lookback_window("computation_date", etl_date)
    )


def run_rolling_readers(
    inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    return rolling_members(
        lookback_metering(inputs, etl_date, vocabulary),
        ["account_id"],
        "usage_resource",
        months_before(etl_date, 1),
        as_date(etl_date),
        {"l30_count_reader": 30, "l7_count_reader": 7},
    ).withColumnRenamed("calendar_date", "computation_date")


def count_user_rolling_days(
    inputs: Inputs,
    dimension: DataFrame,
    etl_date: dt.date,
    vocabulary: Vocabulary,
    facts: DataFrame | None = None,
    activity: DataFrame | None = None,
    readers: DataFrame | None = None,
) -> DataFrame:
    """Metered readers join the account's activity, not the account itself.

    An account that is metered but has no events therefore gives two rows: its
    dimension row without readers, and a row of its own without attributes.

    Stored ``facts`` replace the raw events; ``activity`` and ``readers`` are the rolling
    figures themselves, where they have been carried forward from day to day.
    """
    if activity is None:
        activity = run_rolling_activity(inputs, ["account_id"], etl_date, vocabulary, facts=facts)
    if readers is None:
        readers = run_rolling_readers(inputs, etl_date, vocabulary)
    activity = activity.withColumn("has_activity", F.lit(True))
    accounts = run_dimension(dimension, etl_date).join(activity, KEYS, "left")
    rows = (
        full_join_tested(accounts, readers, KEYS, F.col("has_activity"), "readers")
        .withColumns({k: F.coalesce(k, f"readers_{k}") for k in KEYS})
        .filter(F.col("account_id").isNotNull() & etl_window("computation_date", etl_date))
    )
    return enforce_schema(stamped(rows, etl_date), COUNT_USER_ROLLING_DAYS)
