"""Windows as bits: counts on long axes against days counted one by one, and the plan."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import ETL, account, local_frame, login, view
from daymark.operators.presence import merged, presence, runs, window_counts
from daymark.plans import boards
from daymark.plans.presence_boards import BoardDates, board_presence, regional_board, rolling_activity_series

START = dt.date(2023, 11, 1)


def test_runs_cover_an_axis_once():
    axis = runs("m", START, START + dt.timedelta(days=99), 30)
    days = [d for run in axis for d in run.days()]
    assert days == [START + dt.timedelta(days=i) for i in range(100)] and len(axis) == 3
    assert max(run.window(run.first, 30) for run in axis) < 1 << 63
    assert runs("m", START, START - dt.timedelta(days=1), 30) == []
    with pytest.raises(ValueError, match="reaches back"):
        runs("m", START, START, 64)


def test_windows_of_a_long_axis(spark):
    rng = random.Random(4)
    last = START + dt.timedelta(days=120)
    rows = [(START + dt.timedelta(days=rng.randrange(-80, 160)), rng.choice("abcdefgh"), rng.random() < 0.7) for _ in range(150)]
    rows += [(None, "a", True), (START, None, True), (last, "z", True), (START - dt.timedelta(days=29), "y", True)]
    df = local_frame(spark, rows, "day date, member string, counts boolean")
    axis = runs("m", START, last, 30)
    widths = {"long": 30, "week": 7, "day": 1}
    names = [run.name for run in axis]
    by_kind = df.groupBy("member", "counts").agg(*[presence("day", run, F.col("counts")) for run in axis])
    found = window_counts(merged(by_kind, ["member"], names), axis, widths, F.col("member").isNotNull(), "end")
    expected = []
    for i in range(121):
        end = START + dt.timedelta(days=i)
        seen = [
            len({m for d, m, c in rows if m and c and d and 0 <= (end - d).days < width})
            for width in widths.values()
        ]
        expected.append((end, *seen))
    assert sorted(tuple(r) for r in found.collect()) == expected
    none = window_counts(by_kind.limit(0), axis, widths, F.col("member").isNotNull(), "end")
    assert all(tuple(r)[1:] == (0, 0, 0) for r in none.collect()) and none.count() == 121


def test_boards_from_one_stored_pass_equal_those_by_days(spark, tmp_path, make, words):
    rng = random.Random(5)
    first, reporting = dt.date(2023, 11, 10), dt.date(2024, 1, 20)
    events = []
    for _ in range(400):
        on = dt.datetime(2023, 9, 1) + dt.timedelta(hours=rng.randrange(160 * 24))
        who = rng.choice(["a", "b", "c", "d"]), rng.choice(["u", "v", "w", "x", None])
        events.append(rng.choice([login, view])(on.isoformat(" "), *who, rng.choice(["r1", "r2", "r3"])))
    tables = make(
        raw_events=events,
        account_details=[account("a"), account("b"), account("c", internal="internal"), account("d")],
        regions=[("r1",), ("r2",), ("r3",)],
        reporting_dates=[(reporting,)],
        account_daily=[("a", "r1", "external", reporting), ("b", "r1", "external", START)],
    )
    vocabulary = type(words)(product_code="P", board_regions=("r1", "r2"))
    dates = BoardDates(first, ETL, reporting)
    board_presence(tables, vocabulary, dates).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    assert len(dates.views) > 1

    def shown(df):
        return df.columns, sorted(map(str, (tuple(r) for r in df.collect())))

    series = boards.rolling_activity_series(tables, vocabulary, first, ETL)
    assert shown(rolling_activity_series(tables, vocabulary, dates, rows)) == shown(series)
    board = boards.regional_board(tables, vocabulary, ETL)
    assert shown(regional_board(tables, vocabulary, dates, rows)) == shown(board)
    plan = rolling_activity_series(tables, vocabulary, dates, rows)._jdf.queryExecution().executedPlan().toString()
    # Neither a row per day nor a row per window is made before the last aggregation.
    assert "Window" not in plan and plan.count("Generate inline") <= 3 * 2
