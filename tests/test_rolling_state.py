"""Rolling figures carried forward: late rows, replays, and steps against the full run."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from conftest import local_frame
from daymark.functions.dates import as_date
from daymark.operators.rolling import rolling_of_member_days
from daymark.plans.rolling_state import (
    advanced_state,
    carried_activity,
    carry_forward,
    keep_state,
    state_of,
)

DDL = "account_id string, user_id string, is_login boolean, computation_date date, tuples bigint"
START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def member_days(spark, n):
    draw = random.Random(11)
    rows = {}
    for _ in range(n):
        login = draw.random() < 0.6
        key = (draw.choice(["a", "b", None]), draw.choice(["u", "v", "w", None]), login, day(draw.randrange(-40, 8)))
        rows[key] = (*key, draw.randrange(1, 4) if login else 0)
    return local_frame(spark, list(rows.values()), DDL)


def full(rows, first, last):
    return rolling_of_member_days(rows, ["account_id"], as_date(first), as_date(last))


def same(found, expected):
    found = found.withColumnRenamed("computation_date", "calendar_date")
    left, right = (sorted(map(str, x.select(expected.columns).collect())) for x in (found, expected))
    assert left == right and left


@pytest.fixture
def carried(spark):
    return carried_activity("account_id")


def test_steps_give_what_the_full_run_gives(spark, tmp_path, carried):
    rows, base = member_days(spark, 60), str(tmp_path)
    keep_state(state_of(rows, carried, day(-1)), base)
    same(carry_forward(spark, base, rows, carried, day(0), day(4)), full(rows, day(0), day(4)))


def test_late_rows_are_refused_or_replayed(spark, tmp_path, carried):
    rows, base = member_days(spark, 40), str(tmp_path)
    keep_state(state_of(rows, carried, day(-1)), base)
    carry_forward(spark, base, rows, carried, day(0), day(2))
    late = local_frame(spark, [("a", "late", True, day(1), 1)], DDL)
    state = state_of(rows, carried, day(2))
    with pytest.raises(Exception, match="taken in are rows of 2024-01-04 to 2024-01-04, not 2024-01-02"):
        advanced_state(state, late, carried, day(3)).rows.collect()
    with pytest.raises(ValueError, match="covers 2024-01-03 already"):
        advanced_state(state, late, carried, day(1))
    with_late = rows.unionByName(late)
    same(carry_forward(spark, base, with_late, carried, day(1), day(3)), full(with_late, day(1), day(3)))


def test_an_account_leaves_after_its_last_window(spark, carried):
    rows = local_frame(spark, [("a", "u", True, day(0), 2)], DDL)
    state = state_of(rows, carried, day(0))
    for n, left in ((29, 2), (30, 0)):
        later = advanced_state(state, rows.limit(0), carried, day(n))
        assert later.rows.count() == left
