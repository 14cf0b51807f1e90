"""A history by month: late, withdrawn and corrected rows, advances, and runs that stop."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import ETL, login, plan, revenue, view
from daymark.plans.history import HISTORY_TABLES, brought_up_to_date, history_before
from daymark.plans.segments import SegmentedHistory

UNTIL = dt.date(2023, 11, 20)
EVENTS = [
    login("2022-12-30 10:00:00", "a", "u"),
    login("2023-02-03 10:00:00", "a", "u", region="r2"),
    view("2023-02-04 10:00:00", "b", "v"),
    login("2023-11-19 10:00:00", "a", "w"),
    login("2023-11-25 10:00:00", "c", "x"),
    login("2024-01-05 10:00:00", "a", "w"),
]
REVENUE = [revenue("2023-03-01", "d", "m"), revenue("2023-12-02", "e", "m")]
PLANS = [plan("2023-01-05", "a", "m"), plan("2023-11-22", "a", "m"), plan("2023-11-21", "c", "m")]


def shown(history):
    return {
        name: sorted(map(repr, (sorted(r.asDict().items()) for r in getattr(history, name).collect())))
        for name in HISTORY_TABLES
    }


def source(make, events=EVENTS):
    return make(raw_events=events, business_metrics=REVENUE, daily_account_metrics=PLANS)


def test_build_and_advance_equal_a_scan_of_all_rows(spark, tmp_path, make, words):
    rows = source(make)
    kept = SegmentedHistory(spark, str(tmp_path), words)
    with pytest.raises(ValueError, match="no version"):
        kept.history()
    kept.build(rows, dt.date(2022, 12, 31))
    for until in (UNTIL, UNTIL, dt.date(2023, 11, 26), dt.date(2024, 2, 1)):
        kept.advance(rows, until)
        assert kept.history().until == until
        assert shown(kept.history()) == shown(history_before(rows, until, words))
    with pytest.raises(ValueError, match="ends before"):
        kept.advance(rows, UNTIL)


def test_changed_days_read_their_month_alone(spark, tmp_path, make, words):
    kept = SegmentedHistory(spark, str(tmp_path), words)
    kept.build(source(make), UNTIL)
    before = shown(kept.history())
    # Withdrawn: the login in r2 of 3 February. Late: two logins. The other months of what
    # is given here have no rows at all, so they cannot have been read again.
    late = [login("2023-02-01 09:00:00", "a", "w"), login("2023-02-27 09:00:00", "n", "z"), EVENTS[2]]
    february = make(raw_events=late)
    assert kept.restate(february, [dt.date(2023, 2, d) for d in (1, 3, 27)]) == 2
    after = source(make, [EVENTS[0], *late, *EVENTS[3:]])
    assert shown(kept.history()) == shown(history_before(after, UNTIL, words)) != before
    assert shown(kept.history(version=1)) == before
    now, expected = (
        shown(brought_up_to_date(h, after, ETL, words))
        for h in (kept.history(), history_before(after, dt.date(2023, 12, 1), words))
    )
    assert now == expected
    with pytest.raises(ValueError, match="2023-11-20 is not in the history"):
        kept.restate(after, [UNTIL])


def test_a_month_that_has_become_empty_and_an_empty_source(spark, tmp_path, make, words):
    kept = SegmentedHistory(spark, str(tmp_path), words)
    kept.build(make(), UNTIL)
    assert all(rows == [] for rows in shown(kept.history()).values())
    kept.restate(source(make), [dt.date(2022, 12, 1)])
    assert len(shown(kept.history())["first_logins"]) == 1
    kept.restate(make(), [dt.date(2022, 12, 30)])
    assert all(rows == [] for rows in shown(kept.history()).values())


def test_a_restatement_that_stops_changes_nothing(spark, tmp_path, make, words, monkeypatch):
    kept = SegmentedHistory(spark, str(tmp_path), words)
    kept.build(source(make), UNTIL)
    before = shown(kept.history())
    with monkeypatch.context() as patch:
        patch.setattr(SegmentedHistory, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.restate(make(), [dt.date(2023, 2, 3)])
    assert kept.version() == 1 and shown(kept.history()) == before
