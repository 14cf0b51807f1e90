"""A whole run, with and without a kept history."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import ETL
from daymark.plans.daily_run import advance_history, keep_history, run_daily
from daymark.plans.history import brought_up_to_date
from daymark.schemas import TABLES
from verification.inputs import VOCABULARY
from verification.registry import context


def test_run_with_kept_history_equals_a_run_over_all_rows(spark, tmp_path):
    c = context(spark, "/root/testdata/sf0.001")
    kept = keep_history(c.inputs, ETL, VOCABULARY, str(tmp_path / "history"))
    tables = run_daily(c.inputs, ETL, VOCABULARY, str(tmp_path / "tables"), kept)
    plain = run_daily(c.inputs, ETL, VOCABULARY, str(tmp_path / "plain"))
    assert set(tables) == set(TABLES)
    for name, table in tables.items():
        assert table.columns == TABLES[name].fieldNames()
        assert table.exceptAll(plain[name]).count() == 0
        assert table.count() == plain[name].count() > 0


def test_old_and_advanced_histories_lose_no_row(spark, tmp_path, make):
    """One account is active only between the end of the history and the run window."""
    t = lambda *d: dt.datetime(*d)
    events = [
        (t(2023, 8, 1), "a", "u", VOCABULARY.login, None, "R"),
        (t(2023, 10, 7), "b", "v", VOCABULARY.login, None, "R"),
        (t(2024, 1, 3), "a", "u", VOCABULARY.login, None, "S"),
    ]
    inputs = make(raw_events=events)
    old = keep_history(inputs, dt.date(2023, 10, 20), VOCABULARY, str(tmp_path / "old"))
    assert old.until == dt.date(2023, 9, 1)
    later = advance_history(old, inputs, dt.date(2023, 11, 5), VOCABULARY, str(tmp_path / "later"))
    everything = keep_history(inputs, dt.date(2024, 5, 1), VOCABULARY, str(tmp_path / "all"))
    for kept in (old, later):
        now = brought_up_to_date(kept, inputs, ETL, VOCABULARY)
        for name in ("first_logins", "first_regional_logins", "seen_accounts"):
            expected = {tuple(r) for r in getattr(everything, name).collect()}
            found = getattr(now, name).select(getattr(everything, name).columns)
            assert {tuple(r) for r in found.collect()} == expected
    with pytest.raises(ValueError, match="inside the window"):
        brought_up_to_date(everything, inputs, ETL, VOCABULARY)
    with pytest.raises(ValueError, match="ends before"):
        advance_history(later, inputs, dt.date(2023, 10, 1), VOCABULARY, str(tmp_path / "x"))
