"""Daily activity per account, and per account and region."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.dates import as_date, months_before, run_stamp
from daymark.functions.predicates import (
    active_flag,
    etl_window,
    event_day,
    is_event,
    is_reader_view,
    lookback_window,
)
from daymark.operators.aggregates import (
    activity_facts,
    activity_of_users,
    daily_activity,
    merge_user_activity,
    new_authors,
    user_activity,
)
from daymark.operators.joins import full_join_tested
from daymark.operators.rolling import (
    activity_member_days,
    rolling_activity,
    rolling_of_member_days,
)
from daymark.plans.history import History
from daymark.schemas import (
    ACTIVITY_COLUMNS,
    EVENTS_DAILY,
    EVENTS_REGIONAL_DAILY,
    enforce_schema,
)
from daymark.sources.tables import scan_raw_events

KEYS = ["computation_date", "account_id"]
REGION_KEYS = [*KEYS, "region"]


def run_dimension(dimension: DataFrame, etl_date: dt.date) -> DataFrame:
    return dimension.filter(etl_window("computation_date", etl_date)).drop(
        "dw_create_date", "dw_update_date"
    )


def stamped(df: DataFrame, etl_date: dt.date) -> DataFrame:
    stamp = run_stamp(etl_date)
    return df.withColumns({"dw_create_date": stamp, "dw_update_date": stamp})


def lookback_user_days(
    inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    """Activity per day, account, region and user, for the months a run looks at.

    Written once per run, it spares both activity tables their scans of raw events.
    """
    events = scan_raw_events(inputs.raw_events).filter(lookback_window(event_day(), etl_date))
    return user_activity(events, REGION_KEYS, vocabulary)


def lookback_facts(
    inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    """The one reduction of raw events that a run stores, for the months it looks at.

    Activity per user, first and last logins and the login texts of the rolling counts
    are all merged from it.
    """
    events = scan_raw_events(inputs.raw_events).filter(lookback_window(event_day(), etl_date))
    return activity_facts(events, REGION_KEYS, vocabulary)


def user_days_of(facts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``lookback_user_days`` from stored facts."""
    return merge_user_activity(facts, REGION_KEYS, vocabulary)


def member_days_of(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Logins with their texts, and reader views, per day and user, from stored facts."""
    kinds = _kinds_of_activity(facts, [*keys, "text_digest"]).drop("tuples")
    return activity_member_days(kinds, keys)


def run_activity(
    inputs: Inputs,
    keys: list[str],
    etl_date: dt.date,
    vocabulary: Vocabulary,
    user_days: DataFrame | None = None,
) -> DataFrame:
    if user_days is None:
        events = scan_raw_events(inputs.raw_events).filter(etl_window(event_day(), etl_date))
        return daily_activity(events, keys, vocabulary)
    users = user_days.filter(etl_window("computation_date", etl_date))
    if keys != REGION_KEYS:
        users = merge_user_activity(users, keys, vocabulary)
    return activity_of_users(users, keys, vocabulary)


def first_login_days(user_days: DataFrame, keys: list[str]) -> DataFrame:
    return (
        user_days.filter("login_users")
        .groupBy(*keys, "user_id")
        .agg(F.min("computation_date").alias("first_login_date"))
    )


def run_new_authors(
    inputs: Inputs,
    keys: list[str],
    etl_date: dt.date,
    vocabulary: Vocabulary,
    firsts: DataFrame | None = None,
    user_days: DataFrame | None = None,
) -> DataFrame:
    views = None
    if user_days is not None:
        day = F.col("computation_date").alias("first_login_date")
        views = user_days.filter("count_active_readers").select(*keys, "user_id", day).distinct()
    window = etl_window("first_login_date", etl_date)
    return new_authors(
        inputs.raw_events, keys, vocabulary, window, firsts, views
    ).withColumnRenamed("first_login_date", "computation_date")


def lookback_activity(
    inputs: Inputs, keys: list[str], etl_date: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    """Logins and reader views that can reach a day of the run window."""
    login = is_event(vocabulary.login)
    return (
        scan_raw_events(inputs.raw_events)
        .filter(lookback_window(event_day(), etl_date) & (login | is_reader_view(vocabulary)))
        .select(
            *keys,
            "user_id",
            "user_data",
            login.alias("is_login"),
            event_day().alias("computation_date"),
        )
    )


def run_rolling_activity(
    inputs: Inputs,
    keys: list[str],
    etl_date: dt.date,
    vocabulary: Vocabulary,
    user_days: DataFrame | None = None,
    facts: DataFrame | None = None,
) -> DataFrame:
    """Rolling activity of the run window.

    Stored ``facts`` replace the raw events for any key, ``user_days`` where the key is
    account and region; these hold no login texts, so their login totals are zero.
    """
    span = months_before(etl_date, 1), as_date(etl_date)
    if facts is not None:
        rolling = rolling_of_member_days(member_days_of(facts, keys), keys, *span)
    elif user_days is None:
        activity = lookback_activity(inputs, keys, etl_date, vocabulary)
        rolling = rolling_activity(activity, keys, *span)
    else:
        rolling = rolling_of_member_days(_kinds_of_activity(user_days, keys), keys, *span)
    return rolling.withColumnRenamed("calendar_date", "computation_date")


def _kinds_of_activity(user_days: DataFrame, keys: list[str]) -> DataFrame:
    """One row per user and day that logged in, and one that viewed as a reader."""
    kinds = F.array(
        F.when(F.col("login_users"), True), F.when(F.col("count_active_readers"), False)
    )
    return user_days.select(
        *keys,
        "user_id",
        "computation_date",
        F.explode(F.array_compact(kinds)).alias("is_login"),
        F.lit(None).cast("bigint").alias("tuples"),
    )


def events_daily(
    inputs: Inputs,
    dimension: DataFrame,
    etl_date: dt.date,
    vocabulary: Vocabulary,
    history: History | None = None,
    user_days: DataFrame | None = None,
) -> DataFrame:
    """Activity per day and account.

    ``history`` and ``user_days`` are what a run has stored already; without them
    everything is taken from the raw events.
    """
    firsts = history.first_logins if history else None
    activity = run_activity(inputs, KEYS, etl_date, vocabulary, user_days)
    authors = run_new_authors(
        inputs, ["account_id"], etl_date, vocabulary, firsts, user_days
    )
    facts = activity.join(authors, KEYS, "left")
    rows = (
        run_dimension(dimension, etl_date)
        .join(facts, KEYS, "left")
        .withColumn("active_account", active_flag("count_login_event"))
    )
    return enforce_schema(stamped(rows, etl_date), EVENTS_DAILY)


def events_regional_daily(
    inputs: Inputs,
    dimension: DataFrame,
    etl_date: dt.date,
    vocabulary: Vocabulary,
    history: History | None = None,
    user_days: DataFrame | None = None,
    rolling: DataFrame | None = None,
) -> DataFrame:
    """Dimension rows fan out to the regions active in their 30 days.

    Activity in another region, and new authors without a matching activity row,
    stay as rows of their own without account attributes. ``rolling`` are the rolling
    figures where they have been carried forward from day to day.

    The figures of a day, account and region are brought together first, so the wide
    dimension rows meet them in one join.
    """
    accounts = run_dimension(dimension, etl_date).withColumn("in_dimension", F.lit(True))
    places = ["account_id", "region"]
    if rolling is None:
        rolling = run_rolling_activity(inputs, places, etl_date, vocabulary, user_days)
    rolling = _without_unplaced_week(rolling).withColumn("in_rolling", F.lit(True))
    activity = run_activity(inputs, REGION_KEYS, etl_date, vocabulary, user_days).withColumn(
        "in_activity", F.lit(True)
    )
    firsts = history.first_regional_logins if history else None
    authors = run_new_authors(inputs, places, etl_date, vocabulary, firsts, user_days).withColumn(
        "in_authors", F.lit(True)
    )

    facts = _merge_keys(
        full_join_tested(activity, authors, REGION_KEYS, F.lit(True), "authors"),
        REGION_KEYS,
        "authors",
    )
    # Authors without activity match nothing.
    figures = _merge_keys(
        full_join_tested(facts, rolling, REGION_KEYS, F.col("in_activity"), "rolling"),
        REGION_KEYS,
        "rolling",
    )
    rows = _merge_keys(
        full_join_tested(figures, accounts, KEYS, F.col("in_rolling"), "dimension"),
        KEYS,
        "dimension",
    )
    rows = (
        _unplaced_apart(rows)
        .filter(F.col("account_id").isNotNull() & etl_window("computation_date", etl_date))
        .withColumn("region", F.coalesce("region", F.lit(vocabulary.unknown_region)))
        .withColumn("active_account", active_flag("count_login_event"))
    )
    return enforce_schema(stamped(rows, etl_date), EVENTS_REGIONAL_DAILY)


def _unplaced_apart(rows: DataFrame) -> DataFrame:
    """Without a dimension row, activity and its new authors are rows of their own, and
    rolling figures are dropped."""
    placed, active = F.col("in_dimension").isNotNull(), F.col("in_activity").isNotNull()
    counted = F.col("in_authors").isNotNull()
    parts = (
        F.when(placed, F.array(F.lit("all")))
        .when(active & counted, F.array(F.lit("activity"), F.lit("authors")))
        .when(active, F.array(F.lit("activity")))
        .when(counted, F.array(F.lit("authors")))
    )
    part = F.col("_part")
    kept = {"count_new_authors": F.when(part != "activity", F.col("count_new_authors"))}
    for name in rows.columns:
        if name in ACTIVITY_COLUMNS:
            kept[name] = F.when(part != "authors", F.col(name))
        elif name.startswith(("l30_", "l7_")):
            kept[name] = F.when(part == "all", F.col(name))
    return rows.withColumn("_part", F.explode(parts)).withColumns(kept)


def _without_unplaced_week(rolling: DataFrame) -> DataFrame:
    """Rows without a region have no 7-day figures: those are matched by region."""
    week = [c for c in rolling.columns if c.startswith("l7_")]
    return rolling.withColumns(
        {c: F.when(F.col("region").isNotNull(), F.col(c)) for c in week}
    )


def _merge_keys(df: DataFrame, keys: list[str], side: str) -> DataFrame:
    return df.withColumns({k: F.coalesce(k, f"{side}_{k}") for k in keys}).drop(
        *[f"{side}_{k}" for k in keys]
    )
