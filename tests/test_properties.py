"""Equivalences that must hold for any data, and the plans behind them."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conftest import ETL, local_frame
from daymark.functions.dates import as_date
from daymark.operators.rolling import rolling_activity, rolling_members
from daymark.plans.account_dimension import account_type_edition_daily
from daymark.plans.events import events_daily, events_regional_daily, run_activity
from daymark.plans.revenue import revenue_daily
from daymark.plans.rolling import count_user_rolling_days
from daymark.sources.calendar import date_spine
from verification.inputs import VOCABULARY, inputs

FIRST, LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
DAYS = st.integers(-45, 40).map(lambda n: FIRST + dt.timedelta(days=n))
NAMES = st.sampled_from(["a", "b", None])
ROWS = st.lists(
    st.tuples(NAMES, st.sampled_from(["u", "v", "w", None]), st.booleans(), DAYS, NAMES),
    max_size=40,
)
DDL = (
    "account_id string, user_id string, is_login boolean, computation_date date, "
    "user_data string"
)
def days_reached(day: Column, width: int | Column, first: Column, last: Column) -> Column:
    """The days of ``[first, last]`` whose window of ``width`` days contains ``day``.

    Empty when there is none (``sequence`` alone would count backwards).
    """
    start = F.greatest(day, first)
    end = F.least(F.date_add(day, width - 1), last)
    return F.when(
        start <= end, F.sequence(start, end, F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


def range_join(
    calendar: DataFrame,
    rows: DataFrame,
    day: str,
    width: int,
    first: dt.date | Column,
    last: dt.date | Column,
    how: str = "left",
) -> DataFrame:
    """Calendar days joined to the rows of the ``width`` days that end on them.

    A row is copied to the days it reaches and meets the calendar by equality,
    instead of every row being compared with every day. ``first``/``last`` bound
    the calendar; with ``how='left'`` a day without rows is kept once.
    """
    bounds = [F.lit(b).cast("date") if isinstance(b, dt.date) else b for b in (first, last)]
    calendar = calendar.filter(F.col("calendar_date").between(*bounds))
    reached = rows.withColumn(
        "calendar_date", F.explode(days_reached(F.col(day), width, *bounds))
    )
    matched = reached.join(F.broadcast(calendar), "calendar_date").select(
        *calendar.columns, *rows.columns
    )
    if how == "inner":
        return matched
    seen = rows.select(day).distinct().select(
        F.explode(days_reached(F.col(day), width, *bounds)).alias("calendar_date")
    )
    empty = calendar.join(seen.distinct(), "calendar_date", "left_anti")
    return matched.unionByName(empty, allowMissingColumns=True)


SLOW = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def windows(rows, width):
    """Brute force: every calendar day against every row."""
    found = defaultdict(list)
    for n in range((LAST - FIRST).days + 1):
        end = FIRST + dt.timedelta(days=n)
        for row in rows:
            if end - dt.timedelta(days=width - 1) <= row[3] <= end:
                found[end, row[0]].append(row)
    return found


@SLOW
@given(ROWS)
def test_rolling_activity_equals_brute_force(spark, rows):
    df = rolling_activity(
        local_frame(spark, rows, DDL), ["account_id"], as_date(FIRST), as_date(LAST)
    )
    actual = {(r.calendar_date, r.account_id): r for r in df.collect()}
    for prefix, width in (("l30", 30), ("l7", 7)):
        expected = windows(rows, width)
        present = {
            k for k, r in actual.items() if r[f"{prefix}_period_first_event_date"] is not None
        }
        assert present == set(expected)
        for key, group in expected.items():
            logins = [r for r in group if r[2]]
            readers = {r[1] for r in group if not r[2]} - {None}
            got = actual[key]
            assert got[f"{prefix}_period_first_event_date"] == min(r[3] for r in group)
            assert got[f"{prefix}_period_last_event_date"] == max(r[3] for r in group)
            assert got[f"{prefix}_count_active_reader"] == len(readers)
            users = {r[1] for r in logins} - {None}
            assert got[f"{prefix}_count_active_authors"] == len(users) - len(readers)
            assert got[f"{prefix}_total_login_event"] == len(set(logins))
            if key[1] is not None:
                assert got[f"{prefix}_count_active_accounts"] == int(bool(logins))
    if actual:
        assert set(actual) == set(windows(rows, 30))


@SLOW
@given(ROWS)
def test_rolling_members_equal_the_range_join(spark, rows):
    df = local_frame(spark, rows, DDL)
    fast = rolling_members(
        df, ["account_id"], "user_id", as_date(FIRST), as_date(LAST), {"n30": 30, "n7": 7}
    )
    spine = date_spine(spark, FIRST, LAST).select(F.col("date").alias("calendar_date"))
    for name, width in (("n30", 30), ("n7", 7)):
        slow = (
            range_join(spine, df, "computation_date", width, FIRST, LAST, how="inner")
            .groupBy("calendar_date", "account_id")
            .agg(F.count_distinct("user_id").alias(name))
        )
        kept = fast.filter(F.col(name).isNotNull()).select("calendar_date", "account_id", name)
        assert sorted(map(str, kept.collect())) == sorted(map(str, slow.collect()))


@SLOW
@given(ROWS, st.sampled_from([1, 7, 30]))
def test_left_range_join_keeps_every_day(spark, rows, width):
    spine = date_spine(spark, FIRST, LAST).select(F.col("date").alias("calendar_date"))
    df = local_frame(spark, rows, DDL).select("account_id", "computation_date")
    joined = range_join(spine, df, "computation_date", width, FIRST, LAST).collect()
    expected = []
    for n in range((LAST - FIRST).days + 1):
        end = FIRST + dt.timedelta(days=n)
        hits = [
            (end, r[0], r[3]) for r in rows if end - dt.timedelta(days=width - 1) <= r[3] <= end
        ]
        expected += hits or [(end, None, None)]
    assert sorted(map(str, map(tuple, joined))) == sorted(map(str, expected))


SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The source tables as files of their own, so plans end in their scans."""
    import dataclasses

    tables, base = inputs(spark, SF), tmp_path_factory.mktemp("tables")
    frames = {}
    for field in dataclasses.fields(tables):
        path = str(base / field.name)
        getattr(tables, field.name).write.parquet(path)
        frames[field.name] = spark.read.parquet(path)
    stored = type(tables)(**frames)
    dimension = account_type_edition_daily(stored, ETL, VOCABULARY)
    dimension.write.partitionBy("computation_date").parquet(str(base / "dimension"))
    return stored, spark.read.parquet(str(base / "dimension"))


@pytest.mark.parametrize(
    "job", [events_daily, events_regional_daily, revenue_daily, count_user_rolling_days]
)
def test_jobs_join_by_keys_and_prune_days(stored, job):
    tables, dimension = stored
    plan = plan_of(job(tables, dimension, ETL, VOCABULARY))
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert slow not in plan
    assert "PartitionFilters: [isnotnull(computation_date" in plan


def test_dimension_is_planned_without_a_cross_join(stored):
    plan = plan_of(account_type_edition_daily(stored[0], ETL, VOCABULARY))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_event_window_and_columns_reach_the_scan(stored):
    activity = run_activity(stored[0], ["computation_date", "account_id"], ETL, VOCABULARY)
    plan = plan_of(activity)
    assert "GreaterThanOrEqual(event_day,2023-12-01T00:00" in plan
    assert "region" not in plan
    assert "Expand" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
