"""Row predicates and classifications over the source vocabulary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymark.config import Vocabulary
from daymark.functions.dates import as_date, day_of, month_start, months_before


def etl_window(day: str | Column, etl_date: dt.date | Column) -> Column:
    """From the first day of the month before the run date up to the run date."""
    return _since(day, etl_date, 1)


def etl_window_month(day: str | Column, etl_date: dt.date | Column) -> Column:
    """The run window with its lower bound put on the month of the day."""
    value = F.col(day) if isinstance(day, str) else day
    return (month_start(value) >= months_before(etl_date, 1)) & (value <= as_date(etl_date))


def lookback_window(day: str | Column, etl_date: dt.date | Column) -> Column:
    """One month more than the run window, to feed the 30-day windows."""
    return _since(day, etl_date, 2)


def _since(day: str | Column, etl_date: dt.date | Column, months: int) -> Column:
    value = F.col(day) if isinstance(day, str) else day
    return value.between(months_before(etl_date, months), as_date(etl_date))


def is_event(*names: str, column: str = "event_name") -> Column:
    return F.col(column) == names[0] if len(names) == 1 else F.col(column).isin(*names)


def is_reader_view(vocabulary: Vocabulary, ignore_case: bool = True) -> Column:
    """A dashboard view whose text carries the reader role."""
    text = F.col("user_data")
    role = text.ilike if ignore_case else text.like
    return is_event(vocabulary.dashboard_view) & role(vocabulary.reader_pattern)


def json_text(text: str | Column, key: str) -> Column:
    return F.get_json_object(text, f"$.{key}")


def text_digest(text: str | Column) -> Column:
    """128 bits that stand for a text; a NULL text has an (empty) digest of its own."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(bytearray()))


def is_suspended(vocabulary: Vocabulary, with_fraud: bool = True) -> Column:
    """Suspended by status or, if asked, by the ending of the fraud status."""
    tests = [F.col("account_status_code") == vocabulary.suspended_status]
    if with_fraud:
        fraud = F.col("fraud_enforcement_status")
        tests += [fraud.like(pattern) for pattern in vocabulary.fraud_patterns]
    return reduce(or_, tests)


def has_positive_usage(usage: str) -> Column:
    """Usage over the month, rounded up, is positive exactly when a day's usage is.

    Written on the stored column, the test reaches the Parquet reader.
    """
    return F.col(usage) > 0


def is_reader_usage(vocabulary: Vocabulary) -> Column:
    return (F.col("product_code") == vocabulary.product_code) & F.col("usage_type").like(
        vocabulary.reader_usage_pattern
    )


def any_metric(names: Iterable[str]) -> Column:
    return is_event(*names, column="metrics_name")


def account_type() -> Column:
    """Plan class of an account on a day, from its counts of plan metrics."""
    free, trial, paid = (F.col(c) > 0 for c in ("free_tier", "free_trial", "paid"))
    no_trial, no_paid = F.col("free_trial") == 0, F.col("paid") == 0
    trial_start = F.add_months(month_start("week_end_date"), -2)
    joined = F.col("join_date")
    return (
        F.when(free & no_trial & no_paid & (joined < trial_start), "free")
        .when(free & trial & no_paid, "trial")
        .when(free & no_trial & no_paid & (joined >= trial_start), "free in trial")
        .when(free & trial & paid, "paid in trial")
        .when(no_trial & paid, "paid")
    )


def edition() -> Column:
    return F.when(F.col("total_ent").cast("int") > 0, "enterprise").when(
        F.col("total_std").cast("int") > 0, "standard"
    )


def active_flag(count: str | Column) -> Column:
    """True for a positive count; no events at all (NULL) is False."""
    value = F.col(count) if isinstance(count, str) else count
    return F.coalesce(value > 0, F.lit(False))


def event_day() -> Column:
    return day_of("event_day")
