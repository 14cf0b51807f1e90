"""Literal rows for every behaviour that is easy to lose."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import (
    ETL,
    READER,
    account,
    day,
    event,
    login,
    metered,
    plan,
    revenue,
    view,
)
from daymark.functions.predicates import is_reader_view
from daymark.operators.joins import null_aware_anti_join, semi_join_delete
from daymark.operators.ordering import top_k
from daymark.operators.quality import check_unique_key, reconcile_reports
from daymark.plans import boards, corrections
from daymark.plans.account_dimension import account_type_edition_daily, live_accounts
from daymark.plans.events import events_daily, events_regional_daily
from daymark.plans.revenue import revenue_daily
from daymark.plans.rolling import count_user_rolling_days


def rows_on(df, on, *columns, **match):
    kept = df.filter(F.col("computation_date") == F.lit(day(on)))
    for name, value in match.items():
        kept = kept.filter(F.col(name).eqNullSafe(F.lit(value)))
    return sorted((tuple(r) for r in kept.select(*columns).collect()), key=str)


def jobs(inputs, words, build, etl=ETL):
    return build(inputs, account_type_edition_daily(inputs, etl, words), etl, words)


def test_reader_without_login_gives_negative_authors(make, words):
    inputs = make(raw_events=[view("2024-01-10", "a", "u")], account_details=[account("a")])
    df = jobs(inputs, words, events_daily)
    assert rows_on(df, "2024-01-10", "count_active_authors", "active_account") == [(-1, False)]


def test_fact_table_keeps_dimension_accounts_only_but_regional_keeps_all(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u"), login("2024-01-10", "ghost", "u")],
        account_details=[account("a")],
    )
    daily = jobs(inputs, words, events_daily)
    assert rows_on(daily, "2024-01-10", "account_id") == [("a",)]
    regional = jobs(inputs, words, events_regional_daily)
    ghost = rows_on(
        regional, "2024-01-10", "region", "company_name", "count_login_event", account_id="ghost"
    )
    # The activity row cannot take the new authors, so they stay on a row of their own.
    assert ghost == [("r1", None, 1), ("r1", None, None)]
    assert check_unique_key(regional, ["computation_date", "account_id", "region"]).count() == 1


def test_account_fans_out_to_its_regions_and_others_stay_alone(make, words):
    inputs = make(
        raw_events=[
            login("2024-01-10", "a", "u", region="r1"),
            login("2024-01-12", "a", "u", region="r2"),
            event("2024-01-12", "a", "u", "AnalysisCreated", region="r3"),
        ],
        account_details=[account("a")],
    )
    df = jobs(inputs, words, events_regional_daily)
    columns = ["region", "company_name", "active_account", "l30_count_active_accounts"]
    assert rows_on(df, "2024-01-12", *columns) == [
        ("r1", "company a", False, 1),
        ("r2", "company a", True, 1),
        ("r3", None, False, None),
    ]
    assert rows_on(df, "2024-01-05", *columns) == [("Unknown", "company a", False, None)]


def test_metered_account_without_events_appears_twice(make, words):
    inputs = make(
        account_details=[account("a")],
        business_metrics=[revenue("2024-01-01", "a", "QS-Overall")],
        metering=[metered("2024-01-10", "a", "x"), metered("2024-01-11", "a", "x")],
    )
    df = jobs(inputs, words, count_user_rolling_days)
    assert rows_on(df, "2024-01-11", "account_id", "company_name", "l30_count_reader") == [
        ("a", "company a", None),
        ("a", None, 1),
    ]
    doubled = check_unique_key(df, ["computation_date", "account_id"])
    assert doubled.count() == 21  # 10 to 30 January


def test_same_login_twice_is_one_tuple_but_two_events(make, words):
    inputs = make(
        raw_events=[
            login("2024-01-10", "a", "u"),
            login("2024-01-10", "a", "u"),
            login("2024-01-10", "a", "u", text="{}"),
            login("2024-01-10", "a", "u", text=None),
        ],
        account_details=[account("a")],
    )
    rolling = jobs(inputs, words, count_user_rolling_days)
    assert rows_on(rolling, "2024-01-10", "l30_total_login_event") == [(3,)]
    daily = jobs(inputs, words, events_daily)
    assert rows_on(daily, "2024-01-10", "count_login_event") == [(4,)]


def test_active_account_is_zero_or_one(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u"), view("2024-01-10", "b", "v")],
        account_details=[account("a"), account("b")],
    )
    df = jobs(inputs, words, count_user_rolling_days)
    columns = ["account_id", "l30_count_active_accounts", "l7_count_active_accounts"]
    assert rows_on(df, "2024-01-20", *columns) == [("a", 1, None), ("b", 0, None)]


def test_lookback_misses_one_day_before_first_of_march(make, words):
    etl = dt.date(2019, 4, 10)
    inputs = make(
        day("2019-01-01"),
        day("2019-04-30"),
        raw_events=[login("2019-01-31", "a", "u"), login("2019-02-01", "b", "u")],
        account_details=[account("a"), account("b")],
    )
    df = jobs(inputs, words, count_user_rolling_days, etl)
    found = rows_on(df, "2019-03-01", "account_id", "l30_count_active_authors")
    assert found == [("a", None), ("b", 1)]


@pytest.mark.parametrize(
    "listed, kept", [(["a", None], set()), (["a"], {"b"}), ([], {"a", "b", None})]
)
def test_not_in_with_null(spark, listed, kept):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    excluded = spark.createDataFrame([(x,) for x in listed], "k string")
    assert {r.k for r in null_aware_anti_join(rows, excluded, "k").collect()} == kept


def test_delete_in_keeps_null_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    doomed = spark.createDataFrame([("a",), (None,)], "k string")
    assert {r.k for r in semi_join_delete(rows, doomed, ["k"]).collect()} == {"b", None}


def test_suspended_accounts_come_back_with_revenue(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", x, "u") for x in "abcde"],
        account_details=[
            account("a"),
            account("b", status="Suspended"),
            account("c", status="Suspended"),
            account("d", fraud="Account Terminated"),
            account("e", fraud="Suspended once"),
        ],
        business_metrics=[revenue("2024-01-01", "c", "QS-Overall")],
    )
    assert {r.account_id for r in live_accounts(inputs, words).collect()} == {"a", "c", "e"}


def test_null_suspended_account_empties_the_events_branch(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u")],
        account_details=[account("a"), account("c"), account(None, status="Suspended")],
        business_metrics=[revenue("2024-01-01", "c", "QS-Overall")],
    )
    assert {r.account_id for r in live_accounts(inputs, words).collect()} == {"c"}


def test_revenue_nulls_and_zeros(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "b", "u")],
        account_details=[account("a"), account("b")],
        business_metrics=[
            revenue("2024-01-10", "a", "QS-ReaderOverall", usage=5),
            revenue("2024-01-10", "a", "FreeTier", usage=2),
            (day("2024-01-10"), "a", "p", "P", "SPICE", None, None, None, None, None),
        ],
    )
    df = jobs(inputs, words, revenue_daily)
    columns = [
        "count_provisioned_reader_seesions",
        "count_provisioned_reader_email_sessions",
        "count_provisioned_reader_interactive_sessions",
        "count_provisioned_author",
        "gross_revenue",
        "spice_gb",
    ]
    assert rows_on(df, "2024-01-10", *columns, account_id="a") == [
        (Decimal(5), None, None, Decimal(62), Decimal(0), Decimal(0))
    ]
    assert rows_on(df, "2024-01-10", *columns, account_id="b") == [(None,) * 6]


def test_sum_is_null_only_if_all_rows_match_with_null(make, words):
    empty = (day("2024-01-10"), "a", "p", "P", "QS-Overall", None, None, None, None, None)
    inputs = make(account_details=[account("a")], business_metrics=[empty])
    df = jobs(inputs, words, revenue_daily)
    found = rows_on(df, "2024-01-10", "gross_revenue", "net_revenue", "spice_revenue")
    assert found == [(None, None, Decimal(0))]


def test_usage_rule_changes_in_february_2017(make, words):
    etl = dt.date(2017, 2, 3)
    inputs = make(
        day("2017-01-01"),
        day("2017-02-28"),
        account_details=[account("a")],
        business_metrics=[
            revenue("2017-01-31", "a", "FreeTier", usage=48),
            revenue("2017-02-01", "a", "FreeTier", usage=2),
        ],
    )
    df = jobs(inputs, words, revenue_daily, etl)
    for on, count in (("2017-01-31", 2), ("2017-02-01", 56)):
        assert rows_on(df, on, "count_provisioned_free_users") == [(Decimal(count),)]


def test_figures_meet_before_the_dimension_so_its_rows_are_dealt_once(make, words):
    df = jobs(make(), words, events_regional_daily)
    text = df._sc._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )
    exchanges = [x for x in text.split("\n\n") if re.match(r"\(\d+\) Exchange\n", x)]
    assert exchanges
    # Only the dimension itself is dealt, not what has been joined to it.
    assert not [x for x in exchanges if "company_name" in x and "l30_count_active_reader" in x]


def test_repeated_dimension_rows_take_authors_and_leave_unplaced_rows_single(make, words):
    inputs = make(
        raw_events=[
            login("2024-01-10", "a", "u"),
            event("2024-01-10", "a", "u", "UserInvite", region="r2"),
            login("2024-01-10", "a", "v", region=None),
            login("2024-01-10", "ghost", "w"),
        ],
        account_details=[account("a"), account("a")],
    )
    regional = jobs(inputs, words, events_regional_daily)
    columns = "company_name", "count_login_event", "count_new_authors"
    placed = rows_on(regional, "2024-01-10", *columns, account_id="a", region="r1")
    assert placed == [("company a", 1, 1)] * 2
    assert rows_on(regional, "2024-01-10", *columns, account_id="a", region="r2") == [(None, 0, None)]
    unknown = rows_on(regional, "2024-01-10", *columns, account_id="a", region="Unknown")
    assert unknown == [("company a", None, None)] * 2 + [(None, 1, None), (None, None, 1)]
    ghost = rows_on(regional, "2024-01-10", *columns, account_id="ghost")
    assert ghost == [(None, 1, None), (None, None, 1)]


def test_first_login_by_region_and_overall(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u", "r1"), login("2024-01-12", "a", "u", "r2")],
        account_details=[account("a")],
    )
    daily = jobs(inputs, words, events_daily)
    assert rows_on(daily, "2024-01-12", "count_new_authors") == [(None,)]
    regional = jobs(inputs, words, events_regional_daily)
    found = rows_on(regional, "2024-01-12", "region", "count_new_authors")
    assert found == [("r1", None), ("r2", 1)]


def test_reader_on_the_first_login_day_is_no_new_author(make, words):
    inputs = make(
        raw_events=[
            login("2024-01-10", "a", "u"),
            view("2024-01-10T09:00", "a", "u"),
            login("2024-01-10", "a", "v"),
            view("2024-01-11", "a", "v"),
        ],
        account_details=[account("a")],
    )
    df = jobs(inputs, words, events_daily)
    assert rows_on(df, "2024-01-10", "count_new_authors") == [(1,)]


def test_role_in_lower_case(make, words):
    inputs = make(raw_events=[view("2024-01-10", "a", "u", text=READER.lower())])
    assert inputs.raw_events.filter(is_reader_view(words)).count() == 1
    assert inputs.raw_events.filter(is_reader_view(words, ignore_case=False)).count() == 0


def test_windows_include_both_ends(make, words):
    inputs = make(
        raw_events=[view("2024-01-01", "a", "u"), view("2024-01-01", "a", "v")],
        account_details=[account("a")],
    )
    df = jobs(inputs, words, count_user_rolling_days)
    columns = ["l30_count_active_reader", "l7_count_active_reader"]
    assert rows_on(df, "2024-01-07", *columns) == [(2, 2)]
    assert rows_on(df, "2024-01-08", *columns) == [(2, None)]
    assert rows_on(df, "2024-01-30", *columns) == [(2, None)]


def board_of(make, words, as_of="2024-01-30", end="2024-01-28", **tables):
    inputs = make(
        regions=[("IAD",), ("XXX",)], reporting_dates=[(day(end),)],
        account_details=[account("a"), account("b")], **tables,
    )
    return [r.asDict() for r in boards.regional_board(inputs, words, day(as_of)).collect()]


def test_board_reader_window_has_29_days_and_ends_a_day_early(make, words):
    # Two days before the run is 28 January; 29 days before that is 30 December.
    users = {
        "2023-12-29": "out",
        "2023-12-30": "first",
        "2024-01-27": "last",
        "2024-01-28": "day",
    }
    [row] = board_of(
        make, words, raw_events=[view(on, "a", u, region="IAD") for on, u in users.items()]
    )
    assert row["Active Readers"] == 1
    assert row["30 day Active Readers"] == 2  # first and last
    assert row["30-day Active Authors"] == 0


def test_board_fans_out_over_first_days(make, words):
    first_days = {"a": "2024-01-28", "b": "2024-01-29"}
    seen = [(name, "IAD", "external", day(on)) for name, on in first_days.items()]
    rows = board_of(make, words, account_daily=seen)
    assert [r["New Accounts"] for r in rows] == [1, 1]


def test_series_counts_duplicates_once_and_needs_a_login_that_day(make, words):
    inputs = make(
        raw_events=[
            view("2024-01-20", "a", "u"),
            view("2024-01-20T10:00", "a", "u"),
            login("2024-01-20", "a", "v"),
        ],
        account_details=[account("a")],
        reporting_dates=[(day("2024-01-25"),)],
    )
    df = boards.rolling_activity_series(inputs, words, day("2024-01-20"), day("2024-01-21"))
    assert [tuple(r) for r in df.collect()] == [
        ("2024-01-21", None, None, 1, None, None, 0),
        ("2024-01-20", 1, 1, 1, 1, 1, 1),
    ]


def test_purge_leaves_fact_rows_and_restatement_is_not_idempotent(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u"), view("2024-01-10", "a", "v")],
        account_details=[account("a")],
    )
    gone = make(account_details=[account("a", status="Suspended")])
    dimension = account_type_edition_daily(inputs, ETL, words)
    assert corrections.purge_suspended(dimension, gone.account_details, words).count() == 0
    rolling = count_user_rolling_days(inputs, dimension, ETL, words)
    once = corrections.adjust_rolling_authors(rolling, ETL)
    twice = corrections.adjust_rolling_authors(once, ETL)
    got = [rows_on(t, "2024-01-10", "l30_count_active_authors") for t in (rolling, once, twice)]
    assert got == [[(0,)], [(-1,)], [(-2,)]]


def test_regional_restatement_touches_matched_rows_only(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u"), login("2024-01-11", "a", "u")],
        account_details=[account("a")],
    )
    table = jobs(inputs, words, events_regional_daily).withColumn(
        "l30_count_active_reader", F.lit(1).cast("bigint")
    )
    df = corrections.backfill_new_authors_regional(
        table, inputs.raw_events, words, dt.date(2024, 2, 1)
    )
    columns = ["l30_count_active_authors", "dw_update_date"]
    assert rows_on(df, "2024-01-10", *columns) == [(0, dt.datetime(2024, 2, 1))]
    assert rows_on(df, "2024-01-11", *columns) == [(1, dt.datetime(2024, 1, 30))]


def test_two_payers_on_one_day_fail_the_revenue_restatement(make, words):
    inputs = make(
        account_details=[account("a")],
        business_metrics=[
            revenue("2024-01-10", "a", "QS-Overall", 1, payer="p"),
            revenue("2024-01-10", "a", "QS-Overall", 1, payer="q"),
        ],
    )
    table = jobs(inputs, words, revenue_daily)
    with pytest.raises(Exception, match="more than one source row"):
        corrections.backfill_revenue(table, inputs.business_metrics, words).collect()


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([("c", 1), ("a", 1), ("b", None), ("d", 2)], "k string, v int")
    assert [r.k for r in top_k(df, "v", ["k"], 3).collect()] == ["d", "a", "c"]
    assert [r.k for r in top_k(df, "v", ["k"], 2, nulls_first=True).collect()] == ["b", "d"]


@pytest.mark.parametrize(
    "metrics, joined, expected",
    [
        (["FreeTier"], "2023-10-31", ("free", None)),
        (["FreeTier"], "2023-11-01", ("free in trial", None)),
        (["FreeTier", "FreeTrial", "TotalStandard"], "2023-11-01", ("trial", "standard")),
        (["FreeTier", "FreeTrial", "PaidStandard"], "2023-11-01", ("paid in trial", None)),
        (
            ["PaidEnterprise", "TotalEnterprise", "TotalStandard"],
            "2023-11-01",
            ("paid", "enterprise"),
        ),
        (["FreeTrial"], "2023-11-01", (None, None)),
    ],
)
def test_account_type_truth_table(make, words, metrics, joined, expected):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u")],
        account_details=[account("a")],
        daily_account_metrics=[
            plan(joined, "a", "Other"),
            *[plan("2024-01-10", "a", m) for m in metrics],
            plan("2024-01-10", "a", "PaidStandard", usage="0"),
        ],
    )
    df = account_type_edition_daily(inputs, ETL, words)
    assert rows_on(df, "2024-01-10", "account_type", "edition") == [expected]
    assert rows_on(df, "2024-01-11", "account_type", "join_date") == [(None, day(joined))]


def test_reconcile_verdicts(spark):
    left = spark.createDataFrame([(1, 100, None), (2, 5, 1), (3, 1, 1)], "k int, a int, b int")
    right = spark.createDataFrame([(1, 101, None), (2, 5, 9)], "k int, a int, b int")
    verdicts = {
        (r.k, r.metric): r.verdict
        for r in reconcile_reports(left, right, ["k"], ["a", "b"]).collect()
    }
    assert verdicts == {
        (1, "a"): "almost matched",
        (1, "b"): "matched",
        (2, "a"): "matched",
        (2, "b"): "not matched",
        (3, "a"): "not matched",
        (3, "b"): "not matched",
    }
