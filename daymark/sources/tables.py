"""Narrow scans of the source tables; filters and columns reach the Parquet reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.config import Vocabulary
from daymark.functions.predicates import is_reader_usage, is_suspended
from daymark.operators.skew import split_join


def scan_raw_events(raw_events: DataFrame) -> DataFrame:
    return raw_events.select(
        "event_day", "account_id", "user_id", "event_name", "user_data", "region"
    )


def scan_external_events(
    raw_events: DataFrame, account_details: DataFrame, vocabulary: Vocabulary
) -> DataFrame:
    """Events of accounts that belong to external customers.

    An account with a large share of the events is split over several tasks.
    """
    external = scan_external_accounts(account_details, vocabulary)
    return split_join(scan_raw_events(raw_events), external, "account_id", "left_semi")


def scan_external_accounts(account_details: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    external = account_details.filter(F.col("internal") == vocabulary.external)
    return external.select("account_id")


def scan_account_details(account_details: DataFrame) -> DataFrame:
    return account_details.select("account_id", "payer_account_id", "company_name", "internal")


def scan_suspended_accounts(
    account_details: DataFrame, vocabulary: Vocabulary, with_fraud: bool = True
) -> DataFrame:
    return account_details.filter(is_suspended(vocabulary, with_fraud)).select("account_id")


def scan_product(metrics: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows of one product from either business-metrics table."""
    return metrics.filter(F.col("product_code") == vocabulary.product_code)


def scan_metering(metering: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Reader usage: one row per metered request, with its day."""
    return metering.filter(is_reader_usage(vocabulary)).select(
        F.to_date("request_day").alias("computation_date"), "account_id", "usage_resource"
    )
