"""Account dimension: every live account on every day, with its plan and edition."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.dates import as_date, months_before, run_stamp
from daymark.functions.predicates import (
    account_type,
    any_metric,
    edition,
    etl_window,
    has_positive_usage,
)
from daymark.operators.aggregates import all_plan_metrics, plan_metric_counts
from daymark.operators.joins import densify, with_not_in
from daymark.plans.history import History, history_of, seen_accounts
from daymark.schemas import ACCOUNT_TYPE_EDITION_DAILY, enforce_schema
from daymark.sources.calendar import run_calendar
from daymark.sources.tables import (
    scan_account_details,
    scan_product,
    scan_suspended_accounts,
)


def live_accounts(
    inputs: Inputs, vocabulary: Vocabulary, seen: DataFrame | None = None
) -> DataFrame:
    """Seen accounts without the suspended ones, unless they have revenue rows."""
    if seen is None:
        seen = seen_accounts(inputs, vocabulary)
    suspended = scan_suspended_accounts(inputs.account_details, vocabulary)
    seen = with_not_in(seen, suspended, "account_id", "allowed")
    return seen.filter(F.col("billed") | F.col("allowed")).drop("billed", "allowed")


def plan_days(
    inputs: Inputs, vocabulary: Vocabulary, days: Column | None = None
) -> DataFrame:
    """Plan-metric counts of the rows with positive monthly usage."""
    metrics = scan_product(inputs.daily_account_metrics, vocabulary).filter(
        any_metric(all_plan_metrics(vocabulary))
        & has_positive_usage("daily_usage")
    )
    if days is not None:
        metrics = metrics.filter(days)
    return plan_metric_counts(metrics, vocabulary)


def account_type_edition_daily(
    inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary, history: History | None = None
) -> DataFrame:
    """Accounts by day. ``history`` is taken from all rows unless it is at hand."""
    history = history or history_of(inputs, vocabulary)
    keys = ["calendar_date", "account_id"]
    accounts = (
        live_accounts(inputs, vocabulary, history.seen_accounts)
        .join(scan_account_details(inputs.account_details), "account_id")
        .join(history.join_dates, "account_id", "left")
    )
    panel = densify(
        accounts,
        run_calendar(inputs.calendar, etl_date),
        months_before(etl_date, 1),
        as_date(etl_date),
    )
    plans = plan_days(inputs, vocabulary, etl_window("computation_date", etl_date))
    rows = panel.join(
        plans.withColumnRenamed("computation_date", "calendar_date"), keys, "left"
    ).select(
        F.col("calendar_date").alias("computation_date"),
        "account_id",
        "start_iso_week_date",
        "end_iso_week_date",
        "num_of_day_in_month",
        "join_date",
        "last_login_date",
        "payer_account_id",
        "company_name",
        "internal",
        account_type().alias("account_type"),
        edition().alias("edition"),
        run_stamp(etl_date).alias("dw_create_date"),
        run_stamp(etl_date).alias("dw_update_date"),
    )
    return enforce_schema(rows, ACCOUNT_TYPE_EDITION_DAILY)
