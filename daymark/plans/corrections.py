"""History corrections as pure functions: a table in, the corrected table out.

``TableStore.correct`` writes the result as a new version under the correction's name, so
one that may not be applied twice can be called again; nothing overwrites what it reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.dates import day_of, run_stamp
from daymark.functions.predicates import account_type, is_event
from daymark.operators.aggregates import new_authors
from daymark.operators.joins import semi_join_delete
from daymark.plans.account_dimension import plan_days
from daymark.plans.events import KEYS, REGION_KEYS
from daymark.plans.history import join_dates
from daymark.plans.revenue import revenue_sums
from daymark.sources.tables import scan_product, scan_suspended_accounts

_NEW = "_new_"


def restate(
    target: DataFrame, source: DataFrame, keys: list[str], updates: dict[str, Column | str]
) -> DataFrame:
    """Set columns on the rows of ``target`` that ``source`` matches.

    An update is a source column name, or an expression over target columns. Two
    source rows for one key have no defined outcome, so they fail the query.
    """
    taken = [c for c in updates.values() if isinstance(c, str)]
    unique = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_matches"),
        *[F.first(c).alias(_NEW + c) for c in dict.fromkeys(taken)],
    )
    joined = target.join(unique, keys, "left")
    clash = F.concat(F.lit("more than one source row for "), F.to_json(F.struct(*keys)))
    matched = F.when(F.col("_matches") > 1, F.raise_error(clash).cast("boolean")).otherwise(
        F.col("_matches").isNotNull()
    )
    # In a filter, the check holds whichever columns are read later.
    joined = joined.filter(matched.isNotNull())
    columns = []
    for field in target.schema:
        value = F.col(field.name)
        if field.name in updates:
            new = updates[field.name]
            new = F.col(_NEW + new) if isinstance(new, str) else new
            value = F.when(matched, new.cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return joined.select(*columns)


def purge_suspended(
    dimension: DataFrame,
    account_details: DataFrame,
    vocabulary: Vocabulary,
    with_fraud: bool = True,
) -> DataFrame:
    """Drop the accounts that are suspended; fact tables are left alone."""
    suspended = scan_suspended_accounts(account_details, vocabulary, with_fraud)
    return semi_join_delete(dimension, suspended, ["account_id"])


def backfill_revenue(
    revenue: DataFrame, business_metrics: DataFrame, vocabulary: Vocabulary
) -> DataFrame:
    """Restate three sums and clear the interactive sessions, over all history."""
    sums = revenue_sums(business_metrics, [*KEYS, "payer_account_id"], vocabulary)
    names = ["net_revenue", "gross_revenue", "revenue"]
    updates: dict[str, Column | str] = {name: name for name in names}
    updates["count_provisioned_reader_interactive_sessions"] = F.lit(None)
    return restate(revenue, sums, KEYS, updates)


def _analysis_counts(raw_events: DataFrame, keys: list[str], vocabulary: Vocabulary) -> DataFrame:
    created = is_event(*vocabulary.event_counters["count_analysis_created"])
    days = raw_events.withColumn("computation_date", day_of("event_day"))
    return days.groupBy(*keys).agg(
        F.sum(F.when(created, 1).otherwise(0)).alias("count_analysis_created")
    )


def backfill_analysis_count(
    events: DataFrame, raw_events: DataFrame, vocabulary: Vocabulary
) -> DataFrame:
    counts = _analysis_counts(raw_events, KEYS, vocabulary)
    return restate(events, counts, KEYS, {"count_analysis_created": "count_analysis_created"})


def backfill_analysis_count_regional(
    events: DataFrame, raw_events: DataFrame, vocabulary: Vocabulary, as_of: dt.date
) -> DataFrame:
    counts = _analysis_counts(raw_events, REGION_KEYS, vocabulary)
    updates = {
        "count_analysis_created": "count_analysis_created",
        "dw_update_date": run_stamp(as_of),
    }
    return restate(events, counts, REGION_KEYS, updates)


def account_universe(inputs: Inputs, vocabulary: Vocabulary) -> DataFrame:
    """Accounts of all three sources, suspended ones included."""
    tables = [
        inputs.raw_events,
        scan_product(inputs.business_metrics, vocabulary),
        scan_product(inputs.daily_account_metrics, vocabulary),
    ]
    first, second, third = (t.select("account_id") for t in tables)
    return first.union(second).union(third).distinct()


def backfill_account_type(
    dimension: DataFrame, inputs: Inputs, vocabulary: Vocabulary, as_of: dt.date
) -> DataFrame:
    """Restate the plan class of all history.

    Every day of an account of the universe counts as restated, with or without a
    plan metric. Matching the table's own rows does this without building the
    panel of all days and accounts again.
    """
    details = inputs.account_details.select("account_id").distinct()
    accounts = (
        account_universe(inputs, vocabulary)
        .join(details, "account_id", "left_semi")
        .join(join_dates(inputs, vocabulary), "account_id", "left")
    )
    days = inputs.calendar.select(F.col("date").alias("computation_date")).distinct()
    restated = (
        dimension.select(*KEYS)
        .distinct()
        .join(days, "computation_date", "left_semi")
        .join(accounts, "account_id")
        .join(plan_days(inputs, vocabulary), KEYS, "left")
        .select(*KEYS, account_type().alias("account_type"))
    )
    updates = {"account_type": "account_type", "dw_update_date": run_stamp(as_of)}
    return restate(dimension, restated, KEYS, updates)


def backfill_new_authors(
    events: DataFrame, raw_events: DataFrame, vocabulary: Vocabulary, as_of: dt.date
) -> DataFrame:
    authors = _authors(raw_events, ["account_id"], vocabulary)
    updates = {"count_new_authors": "count_new_authors", "dw_update_date": run_stamp(as_of)}
    return restate(events, authors, KEYS, updates)


def backfill_new_authors_regional(
    events: DataFrame, raw_events: DataFrame, vocabulary: Vocabulary, as_of: dt.date
) -> DataFrame:
    """As above by region; matched rows also lose their readers from the authors.

    Not idempotent: applied twice, the readers are taken off twice.
    """
    authors = _authors(raw_events, ["account_id", "region"], vocabulary)
    updates = {
        "count_new_authors": "count_new_authors",
        "dw_update_date": run_stamp(as_of),
        **_authors_less_readers(),
    }
    return restate(events, authors, REGION_KEYS, updates)


def adjust_rolling_authors(rolling: DataFrame, as_of: dt.date) -> DataFrame:
    """Take the readers off the authors on every row. Not idempotent."""
    return rolling.withColumns({**_authors_less_readers(), "dw_update_date": run_stamp(as_of)})


def _authors(raw_events: DataFrame, keys: list[str], vocabulary: Vocabulary) -> DataFrame:
    return new_authors(raw_events, keys, vocabulary).withColumnRenamed(
        "first_login_date", "computation_date"
    )


def _authors_less_readers() -> dict[str, Column]:
    return {
        f"{p}_count_active_authors": F.col(f"{p}_count_active_authors")
        - F.col(f"{p}_count_active_reader")
        for p in ("l30", "l7")
    }
