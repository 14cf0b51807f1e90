"""Both dashboards from bits of presence: events are read once, for both, and never copied.

``board_presence`` keeps one row per region, external account and user: the days with a login
and those with a reader view as masks, and the day of the first login. Its size does not grow
with the number of days; stored, it serves both boards. All windows of the boards are bit
tests on it, where ``plans/boards.py`` counts days. Dates are arguments here, the reporting
day too, since the bits of a window are fixed when the query is built.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.predicates import is_event, is_reader_view
from daymark.operators.presence import Run, merged, presence, runs, window_counts
from daymark.operators.rolling import LONG
from daymark.operators.skew import split_join
from daymark.plans.boards import (
    board_rows,
    new_regional_accounts,
    new_regional_authors,
    series_axis,
    series_rows,
)
from daymark.sources.tables import scan_external_accounts, scan_raw_events

_DAY = "computation_date"
#: Days of the series, up to the reporting day, with figures of accounts and authors.
SERIES_DAYS = 14


@dataclass(frozen=True)
class BoardDates:
    """``[first, as_of]`` is the axis of the series; ``reporting`` the day of the logins."""

    first: dt.date
    as_of: dt.date
    reporting: dt.date

    @property
    def reader_day(self) -> dt.date:
        return self.as_of - dt.timedelta(days=2)

    @cached_property
    def logins(self) -> list[Run]:
        start = self.reporting - dt.timedelta(days=SERIES_DAYS - 1)
        return runs("logins", start, self.reporting, LONG)

    @cached_property
    def views(self) -> list[Run]:
        # The board needs the reader day and the day before.
        start = min(self.first, self.reader_day - dt.timedelta(days=1))
        return runs("views", start, self.as_of, LONG)


def _in_window(axis: list[Run], end: dt.date, width: int) -> Column:
    """Whether a mask has a day in the ``width`` days up to ``end``."""
    (run,) = [r for r in axis if r.first <= end <= r.last]
    return F.col(run.name).bitwiseAND(F.lit(run.window(end, width))) != 0


def board_presence(inputs: Inputs, vocabulary: Vocabulary, dates: BoardDates) -> DataFrame:
    """Masks of login and view days and the first login, of all that either board counts."""
    login, view = is_event(vocabulary.login), is_reader_view(vocabulary, ignore_case=False)
    oldest = dates.views[0].first - dt.timedelta(days=LONG - 1)
    recent = F.to_date("event_day").between(F.lit(oldest), F.lit(dates.as_of))
    events = scan_raw_events(inputs.raw_events).filter(login | (view & recent))
    kinds = events.select(
        "region",
        "account_id",
        "user_id",
        F.to_date("event_day").alias(_DAY),
        login.alias("is_login"),
        view.alias("is_view"),
    )
    rows = kinds.groupBy("region", "account_id", "user_id").agg(
        *[presence(_DAY, run, F.col("is_login")) for run in dates.logins],
        *[presence(_DAY, run, F.col("is_view")) for run in dates.views],
        F.min(F.when(F.col("is_login"), F.col(_DAY))).alias("first_login"),
    )
    external = scan_external_accounts(inputs.account_details, vocabulary)
    often_in = inputs.raw_events
    return split_join(rows, external, "account_id", "left_semi", often_in=often_in)


def rolling_activity_series(
    inputs: Inputs, vocabulary: Vocabulary, dates: BoardDates, rows: DataFrame | None = None
) -> DataFrame:
    """What ``boards.rolling_activity_series`` gives; ``rows`` is the stored presence."""
    if rows is None:
        rows = board_presence(inputs, vocabulary, dates)

    def figures(member: str, axis: list[Run], what: str) -> DataFrame:
        widths = {f"active {what} (30 days)": LONG, f"daily active {what}": 1}
        members = merged(rows, [member], [run.name for run in axis])
        return window_counts(members, axis, widths, F.col(member).isNotNull(), "calendar_date")

    accounts = figures("account_id", dates.logins, "accounts")
    # External accounts are not NULL, so a day with a login has an account.
    stats = accounts.filter(F.col("daily active accounts") > 0).join(
        figures("user_id", dates.logins, "authors"), "calendar_date"
    )
    axis = series_axis(inputs.calendar, dates.first, dates.as_of)
    return series_rows(axis, figures("user_id", dates.views, "readers"), stats)


def regional_board(
    inputs: Inputs, vocabulary: Vocabulary, dates: BoardDates, rows: DataFrame | None = None
) -> DataFrame:
    """What ``boards.regional_board`` gives; ``rows`` is the stored presence."""
    if rows is None:
        rows = board_presence(inputs, vocabulary, dates)

    def figures(member: str, axis: list[Run], **windows: Column) -> DataFrame:
        members = merged(rows, ["region", member], [run.name for run in axis])
        known = F.col(member).isNotNull()
        counts = [F.count_if(known & test).alias(name) for name, test in windows.items()]
        return members.groupBy("region").agg(*counts)

    on_day = _in_window(dates.logins, dates.reporting, 1)
    within = _in_window(dates.logins, dates.reporting, LONG)
    before = dates.reader_day - dt.timedelta(days=1)
    end = F.lit(dates.reporting)
    firsts = rows.filter(F.col("first_login").isNotNull()).select(
        "region", "account_id", "user_id", F.col("first_login").alias(_DAY), F.lit(True).alias("is_login")
    )
    parts = [
        new_regional_accounts(inputs, vocabulary, end),
        new_regional_authors(firsts, inputs, end),
        figures("account_id", dates.logins, day_accounts=on_day, accounts=within),
        figures("user_id", dates.logins, day_authors=on_day, authors=within),
        figures(
            "user_id",
            dates.views,
            daily_readers=_in_window(dates.views, dates.reader_day, 1),
            thirty_readers=_in_window(dates.views, before, LONG - 1),
        ),
    ]
    return board_rows(inputs, vocabulary, parts)
