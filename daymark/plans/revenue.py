"""Daily revenue and usage per account, in exact decimals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.predicates import etl_window
from daymark.operators.aggregates import (
    provisioned_authors,
    provisioned_readers,
    revenue_columns,
)
from daymark.plans.events import KEYS, run_dimension, stamped
from daymark.schemas import REVENUE_DAILY, enforce_schema
from daymark.sources.tables import scan_metering, scan_product


def revenue_sums(
    business_metrics: DataFrame, keys: list[str], vocabulary: Vocabulary, days: Column | None = None
) -> DataFrame:
    metrics = scan_product(business_metrics, vocabulary)
    if days is not None:
        metrics = metrics.filter(days)
    return metrics.groupBy(*keys).agg(
        *[c.alias(name) for name, c in revenue_columns(vocabulary).items()]
    )


def revenue_daily(
    inputs: Inputs, dimension: DataFrame, etl_date: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    window = etl_window("computation_date", etl_date)
    sums = revenue_sums(inputs.business_metrics, KEYS, vocabulary, window)
    readers = provisioned_readers(scan_metering(inputs.metering, vocabulary).filter(window))
    rows = (
        run_dimension(dimension, etl_date)
        .join(sums, KEYS, "left")
        .join(readers, KEYS, "left")
        .withColumn("count_provisioned_author", provisioned_authors())
        .withColumn("count_provisioned_reader_interactive_sessions", F.lit(None))
    )
    return enforce_schema(stamped(rows, etl_date), REVENUE_DAILY)
