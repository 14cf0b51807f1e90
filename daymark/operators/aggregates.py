"""Aggregations: activity counters, plan-metric counts, revenue sums, first logins.

Distinct users are never counted by widening each row to one copy per count. Rows
are first reduced to one per day, account and user, which spreads even a single
dominant account over all tasks, and those are then counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Vocabulary
from daymark.functions.dates import day_of, days_in_month
from daymark.functions.predicates import (
    any_metric,
    is_event,
    is_reader_view,
    json_text,
    text_digest,
)
from daymark.operators.joins import semi_join_delete


def count_distinct_if(condition: Column, value: str) -> Column:
    return F.count_distinct(F.when(condition, F.col(value)))


def composite_distinct(*columns: str) -> Column:
    """Distinct concatenations, without a separator; a NULL part is not counted."""
    return F.count_distinct(F.concat(*columns))


def with_event_facts(events: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Read the JSON text once per row, and only for the events that need it."""
    v = vocabulary
    text = F.col("user_data")
    return events.withColumns(
        {
            "computation_date": day_of("event_day"),
            "is_reader": is_reader_view(v),
            "source_type": F.when(
                is_event(v.source_created), json_text(text, v.source_type_key)
            ),
            "is_spice": F.when(
                is_event(v.dataset_prepared),
                (json_text(text, v.accelerated_key) == "true") & ~text.like(v.sample_pattern),
            ),
        }
    )


def event_counters(vocabulary: Vocabulary) -> dict[str, Column]:
    """Row conditions of the plain counters, by output column."""
    v = vocabulary
    counters = {"count_login_event": is_event(v.login)}
    counters |= {name: is_event(*events) for name, events in v.event_counters.items()}
    counters["count_spice"] = F.col("is_spice")
    counters |= {
        name: F.col("source_type").isin(*types) for name, types in v.source_counters.items()
    }
    return counters


def user_conditions(vocabulary: Vocabulary) -> dict[str, Column]:
    """Row conditions whose distinct users are counted, by output column."""
    v = vocabulary
    conditions = {"count_active_readers": F.col("is_reader"), "login_users": is_event(v.login)}
    conditions |= {name: is_event(*events) for name, events in v.user_counters.items()}
    return conditions


def user_activity(
    events: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """Counters and flags per key and user, from raw events.

    A flag has the name of the output that counts its users.
    """
    rows = with_event_facts(events, vocabulary)
    return rows.groupBy(*keys, "user_id").agg(*_activity_sums(vocabulary))


def _activity_sums(vocabulary: Vocabulary) -> list[Column]:
    counters, users = event_counters(vocabulary), user_conditions(vocabulary)
    return [
        *[F.count_if(c).alias(name) for name, c in counters.items()],
        *[F.max(F.coalesce(c, F.lit(False))).alias(name) for name, c in users.items()],
    ]


def activity_facts(
    events: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """The same per key, user and digest of a login text, with the last login.

    Everything the tables say about activity can be merged from these rows: sums, flags,
    first and last logins, and how many different login texts there are under any coarser
    key. A digest of 16 bytes stands for a text, events other than logins have none, and
    the rows of one very busy user are spread by their digests.
    """
    login = is_event(vocabulary.login)
    rows = with_event_facts(events, vocabulary).withColumn(
        "text_digest", F.when(login, text_digest("user_data"))
    )
    last = F.max(F.when(login, F.col("event_day"))).alias("last_login_date")
    return rows.groupBy(*keys, "user_id", "text_digest").agg(*_activity_sums(vocabulary), last)


def merge_user_activity(
    per_user: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """User rows of finer keys brought together under ``keys``."""
    counters, users = event_counters(vocabulary), user_conditions(vocabulary)
    return per_user.groupBy(*keys, "user_id").agg(
        *[F.sum(name).alias(name) for name in counters],
        *[F.max(name).alias(name) for name in users],
    )


def activity_of_users(
    per_user: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """All activity metrics per key, from rows that are unique per key and user."""
    counters, users = event_counters(vocabulary), user_conditions(vocabulary)
    known = F.col("user_id").isNotNull()
    return (
        per_user.groupBy(*keys)
        .agg(
            *[F.sum(name).alias(name) for name in counters],
            *[F.count_if(F.col(name) & known).alias(name) for name in users],
        )
        .withColumn(
            "count_active_authors", F.col("login_users") - F.col("count_active_readers")
        )
        .withColumn("dataset_created", reduce(add, map(F.col, vocabulary.dataset_parts)))
        .drop("login_users")
    )


def daily_activity(
    events: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """All activity metrics per key; ``keys`` may add the region to day and account."""
    return activity_of_users(user_activity(events, keys, vocabulary), keys, vocabulary)


def first_logins(
    events: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """First login day of every user, over all history."""
    return (
        events.filter(is_event(vocabulary.login))
        .groupBy(*keys, "user_id")
        .agg(F.min(day_of("event_day")).alias("first_login_date"))
    )


def reader_view_days(
    events: DataFrame, keys: Sequence[str], vocabulary: Vocabulary
) -> DataFrame:
    """Days on which a user viewed a dashboard as a reader."""
    return (
        events.filter(is_reader_view(vocabulary))
        .select(*keys, "user_id", day_of("event_day").alias("first_login_date"))
        .distinct()
    )


def new_authors(
    events: DataFrame,
    keys: Sequence[str],
    vocabulary: Vocabulary,
    window: Column | None = None,
    firsts: DataFrame | None = None,
    views: DataFrame | None = None,
) -> DataFrame:
    """Users whose first login is that day and who did not view as a reader then.

    ``firsts`` are the first logins over all history and ``views`` the reader days,
    if they are at hand. ``window`` limits the days of interest (on
    ``first_login_date``); it is applied after that minimum, and reaches the scan of
    the reader views.
    """
    if firsts is None:
        firsts = first_logins(events, keys, vocabulary)
    if window is not None:
        firsts = firsts.filter(window)
    if views is None:
        views = reader_view_days(events, keys, vocabulary)
    authors = semi_join_delete(firsts, views, [*keys, "user_id", "first_login_date"])
    return authors.groupBy("first_login_date", *keys).agg(
        F.count("user_id").alias("count_new_authors")
    )


def plan_metric_counts(daily_metrics: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows of each plan metric per day, week and account."""
    return daily_metrics.groupBy(
        "computation_date",
        F.col("start_iso_week_date").alias("week_start_date"),
        F.col("end_iso_week_date").alias("week_end_date"),
        "account_id",
    ).agg(
        *[
            F.count_if(any_metric(names)).alias(column)
            for column, names in vocabulary.plan_metrics.items()
        ]
    )


def all_plan_metrics(vocabulary: Vocabulary) -> list[str]:
    return [name for names in vocabulary.plan_metrics.values() for name in names]


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of ``value`` where the condition holds and of 0 elsewhere.

    Rows that fail the condition are not added at all, which matters for exact
    decimals. The sum is NULL only if every row meets the condition with a NULL.
    """
    held = F.coalesce(condition, F.lit(False))
    total = F.sum(F.when(condition, value))
    return F.when(F.bool_and(held), total).otherwise(F.coalesce(total, F.lit(0)))


def net_of_share(names: Iterable[str]) -> Column:
    """Gross revenue of some metrics, less the estimated negative share."""
    net = F.col("gross_revenue") * (1 - F.col("estimated_negative_revenue_share"))
    return sum_where(any_metric(names), net)


def usage_as_count(name: str) -> Column:
    """Daily usage fraction of a metric times the days of its month.

    The day is a grouping key, so the days of its month multiply the sum. As a
    two-digit decimal they leave the scale of the product untouched.
    """
    usage = sum_where(any_metric([name]), F.col("usage"))
    return usage * days_in_month("computation_date").cast("decimal(2,0)")


def usage_as_count_by_date(name: str, rule_change: str) -> Column:
    """Usage to count, by hours before the rule change and by days from it on."""
    changed = F.lit(rule_change).cast("date")
    earlier = any_metric([name]) & (F.col("computation_date") < changed)
    hours = F.lit(24.0).cast("decimal(3,1)")
    return F.when(F.col("computation_date") >= changed, usage_as_count(name)).otherwise(
        sum_where(earlier, F.col("usage") / hours)
    )


def revenue_columns(vocabulary: Vocabulary) -> dict[str, Column]:
    """Aggregates of the revenue table, by output column; the day is a grouping key."""
    v = vocabulary
    overall = any_metric([v.overall_metric])
    sessions = sum_where(any_metric([v.reader_metric]), F.col("usage"))
    reports = F.sum(F.when(any_metric([v.report_session_metric]), F.col("usage")))
    net = F.col("gross_revenue") + F.col("discounts") + F.col("crf")
    columns = {
        "gross_revenue": sum_where(overall, F.col("gross_revenue")),
        "revenue": net_of_share([v.overall_metric]),
    }
    columns |= {name: net_of_share(names) for name, names in v.revenue_streams.items()}
    paid = "count_provisioned_paid_authors_with_{}_subscription"
    counts = {
        paid.format("annual"): v.annual_author_metric,
        paid.format("monthly"): v.monthly_author_metric,
        "spice_gb": v.spice_metric,
    }
    columns |= {name: usage_as_count(metric) for name, metric in counts.items()}
    dated = {
        "count_provisioned_free_users": v.free_user_metric,
        "count_provisioned_trial_users": v.trial_user_metric,
    }
    columns |= {
        name: usage_as_count_by_date(metric, v.usage_rule_change)
        for name, metric in dated.items()
    }
    return columns | {
        "count_provisioned_reader_seesions": sessions,
        "count_provisioned_reader_email_sessions": reports,
        "count_provisioned_reader_interactive_sessions": sessions - reports,
        "net_revenue": sum_where(overall, net),
    }


AUTHOR_PARTS = (
    "count_provisioned_paid_authors_with_annual_subscription",
    "count_provisioned_paid_authors_with_monthly_subscription",
    "count_provisioned_free_users",
    "count_provisioned_trial_users",
)


def provisioned_authors() -> Column:
    return reduce(add, map(F.col, AUTHOR_PARTS))


def provisioned_readers(metering_days: DataFrame) -> DataFrame:
    """Different metered resources per day and account."""
    return metering_days.groupBy("computation_date", "account_id").agg(
        F.count_distinct("usage_resource").alias("provisioned_readers")
    )
