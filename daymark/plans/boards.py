"""Two dashboards derived again from raw events, independent of the daily tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.dates import as_date, day_of, iso_date_text
from daymark.functions.predicates import is_event, is_reader_view
from daymark.operators.aggregates import composite_distinct
from daymark.operators.rolling import LONG, rolling_members
from daymark.operators.skew import split_join
from daymark.sources.tables import scan_external_accounts, scan_raw_events

_DAY = "computation_date"


def reporting_day(reporting_dates: DataFrame) -> Column:
    """The single reporting date, as a scalar subquery."""
    return reporting_dates.select("dbr_start_date").scalar()


def external_activity(inputs: Inputs, vocabulary: Vocabulary) -> DataFrame:
    """Days with a login or a reader view per region, external account and user.

    Events are reduced before they meet the accounts, whose frequent ones are split over
    tasks. Stored once, these rows serve both boards, and no board reads events again.
    """
    login, view = is_event(vocabulary.login), is_reader_view(vocabulary, ignore_case=False)
    events = scan_raw_events(inputs.raw_events).filter(login | view)
    days = events.groupBy("region", "account_id", "user_id", day_of("event_day").alias(_DAY)).agg(
        F.max(login).alias("is_login"), F.max(view).alias("is_view")
    )
    external = scan_external_accounts(inputs.account_details, vocabulary)
    events = inputs.raw_events
    return split_join(days, external, "account_id", "left_semi", often_in=events)


def window_and_day_members(
    rows: DataFrame, member: str, first: Column, last: Column, names: tuple[str, str]
) -> DataFrame:
    """Distinct members of all rows per day: over 30 days, and on the day itself.

    The daily figure is NULL for a day without rows.
    """
    return rolling_members(rows, [], member, first, last, {names[0]: LONG, names[1]: 1})


def rolling_activity_series(
    inputs: Inputs,
    vocabulary: Vocabulary,
    first: dt.date,
    as_of: dt.date,
    days: DataFrame | None = None,
) -> DataFrame:
    """Accounts, authors and readers per day, over 30 days and on the day.

    ``[first, as_of]`` is the date axis. Account and author figures exist for the
    14 days up to the reporting date that have a login, and are NULL elsewhere. ``days``
    is the stored ``external_activity``.
    """
    if days is None:
        days = external_activity(inputs, vocabulary)
    end = reporting_day(inputs.reporting_dates)
    logins = days.filter(F.col("is_login") & F.col(_DAY).between(F.date_sub(end, 45), end))
    axis = series_axis(inputs.calendar, first, as_of)
    start = F.date_sub(end, 13)
    accounts = window_and_day_members(
        logins, "account_id", start, end, ("active accounts (30 days)", "daily active accounts")
    )
    authors = window_and_day_members(
        logins, "user_id", start, end, ("active authors (30 days)", "daily active authors")
    )
    stats = accounts.join(authors, "calendar_date").filter(
        F.col("daily active accounts").isNotNull()
    )
    views = days.filter(
        F.col("is_view")
        & F.col(_DAY).between(F.date_sub(as_date(first), LONG - 1), as_date(as_of))
    )
    readers = window_and_day_members(
        views,
        "user_id",
        as_date(first),
        as_date(as_of),
        ("active readers (30 days)", "daily active readers"),
    )
    return series_rows(axis, readers, stats)


def series_axis(calendar: DataFrame, first: dt.date, as_of: dt.date) -> DataFrame:
    """The days of the calendar in ``[first, as_of]``."""
    days = calendar.filter(F.col("date").between(as_date(first), as_date(as_of)))
    return days.select(F.col("date").alias("calendar_date")).distinct()


def series_rows(axis: DataFrame, readers: DataFrame, stats: DataFrame) -> DataFrame:
    """The series, from its figures per ``calendar_date``."""
    return (
        axis.join(readers, "calendar_date", "left")
        .join(stats, "calendar_date", "left")
        .orderBy(F.desc("calendar_date"))
        .select(
            iso_date_text("calendar_date").alias("date"),
            F.col("active accounts (30 days)"),
            F.col("active authors (30 days)"),
            F.coalesce("active readers (30 days)", F.lit(0)).alias("active readers (30 days)"),
            F.col("daily active accounts"),
            F.col("daily active authors"),
            F.coalesce("daily active readers", F.lit(0)).alias("daily active readers"),
        )
    )


def members_by_region(
    rows: DataFrame, member: str, day: Column, names: tuple[str, str]
) -> DataFrame:
    """Distinct members per region: on the day, and over all the rows given."""
    last = rows.groupBy("region", member).agg(F.max(F.col(_DAY) == day).alias("on_day"))
    known = F.col(member).isNotNull()
    return last.groupBy("region").agg(
        F.count_if(F.col("on_day") & known).alias(names[0]), F.count(member).alias(names[1])
    )


def new_regional_accounts(inputs: Inputs, vocabulary: Vocabulary, end: Column) -> DataFrame:
    """Accounts whose first day in a region is not before the reporting date.

    One row per region and first day, so a region can have several.
    """
    firsts = (
        inputs.account_daily.filter(F.col("internal") == vocabulary.external)
        .groupBy("account_id", "region")
        .agg(F.min(_DAY).alias(_DAY))
        .filter(F.col(_DAY) >= end)
    )
    return (
        firsts.groupBy("region", _DAY)
        .agg(F.count("account_id").alias("new_accounts"))
        .drop(_DAY)
    )


def new_regional_authors(days: DataFrame, inputs: Inputs, end: Column) -> DataFrame:
    """Users whose first login in a region falls on the reporting date.

    ``days`` are all days of external activity, since a first login needs all of them.
    """
    details = inputs.account_details.select("account_id", "internal")
    firsts = (
        days.filter("is_login")
        .groupBy("account_id", "user_id", "region")
        .agg(F.min(_DAY).alias(_DAY))
        .filter(F.col(_DAY) == end)
    )
    # The same pair is counted once, so the users of one account may be dealt over tasks.
    return (
        split_join(firsts, details, "account_id", often_in=inputs.raw_events)
        .groupBy("region", "internal")
        .agg(composite_distinct("account_id", "user_id").alias("new_authors"))
        .drop("internal")
    )


def regional_board(
    inputs: Inputs, vocabulary: Vocabulary, as_of: dt.date, days: DataFrame | None = None
) -> DataFrame:
    """New and active accounts, authors and readers of the listed regions.

    Authors and accounts end on the reporting date and span 30 days. Readers end
    two days before ``as_of``; their long figure covers the 29 days before that. ``days``
    is the stored ``external_activity``.
    """
    if days is None:
        days = external_activity(inputs, vocabulary)
    end = reporting_day(inputs.reporting_dates)
    logins = days.filter(F.col("is_login") & F.col(_DAY).between(F.date_sub(end, 29), end))
    reader_day = F.date_sub(as_date(as_of), 2)
    views = days.filter(
        F.col("is_view") & F.col(_DAY).between(F.date_sub(reader_day, 29), reader_day)
    )
    earlier = F.col(_DAY) < reader_day
    viewers = views.groupBy("region", "user_id").agg(
        F.max(~earlier).alias("on_day"), F.max(earlier).alias("before")
    )
    known = F.col("user_id").isNotNull()
    readers = viewers.groupBy("region").agg(
        F.count_if(F.col("on_day") & known).alias("daily_readers"),
        F.count_if(F.col("before") & known).alias("thirty_readers"),
    )
    accounts = members_by_region(logins, "account_id", end, ("day_accounts", "accounts"))
    authors = members_by_region(logins, "user_id", end, ("day_authors", "authors"))
    new = [new_regional_accounts(inputs, vocabulary, end), new_regional_authors(days, inputs, end)]
    return board_rows(inputs, vocabulary, [*new, accounts, authors, readers])


def board_rows(inputs: Inputs, vocabulary: Vocabulary, parts: Sequence[DataFrame]) -> DataFrame:
    """The board, from its figures per region."""
    board = (
        inputs.regions.filter(F.col("region_code").isin(*vocabulary.board_regions))
        .select(F.col("region_code").alias("region"))
    )
    for part in parts:
        board = board.join(part, "region", "left")
    # Titles of the board.
    titles = {
        "New Accounts": "new_accounts",
        "New Authors": "new_authors",
        "Active Accounts": "day_accounts",
        "Active Authors": "day_authors",
        "Active Readers": "daily_readers",
        "30-day Active Accounts": "accounts",
        "30-day Active Authors": "authors",
        "30 day Active Readers": "thirty_readers",
    }
    return board.select(
        F.col("region").alias("Region"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(title) for title, c in titles.items()],
    ).orderBy("Region")
