"""All-history facts kept as small tables, so that a run reads only recent rows.

Three figures need every row ever loaded: a user's first login, an account's last
login, and an account's first metric day. Kept per user or account up to a day,
they replace the scan of all older rows. A history knows the day it ends before
(``until``), and is brought up to date from that very day, so it may be of any age:
the result is exactly that of a scan of all rows. Rows that arrive later for days
before ``until`` are not seen by a history kept as a whole; ``plans/segments.py`` keeps one
by month, which takes them in.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.functions.predicates import is_event, lookback_window
from daymark.sources.tables import scan_product

USER = ["account_id", "region", "user_id"]


def user_facts(
    inputs: Inputs, vocabulary: Vocabulary, by: Sequence[Column] = ()
) -> DataFrame:
    """First login day and last login of every user and region, from one pass over events.

    Users without a login are there too: their accounts have been seen. With ``by``, there
    is one row for each value of these columns as well.
    """
    login = F.when(is_event(vocabulary.login), F.col("event_day"))
    return inputs.raw_events.groupBy(*by, *USER).agg(
        F.to_date(F.min(login)).alias("first_login_date"), F.max(login).alias("last_login_date")
    )


def user_facts_of(facts: DataFrame) -> DataFrame:
    """The same from stored activity facts, without another look at the events."""
    return facts.groupBy(*USER).agg(
        F.min(F.when(F.col("login_users"), F.col("computation_date"))).alias("first_login_date"),
        F.max("last_login_date").alias("last_login_date"),
    )


def seen_accounts(
    inputs: Inputs, vocabulary: Vocabulary, users: DataFrame | None = None
) -> DataFrame:
    """Accounts with events or revenue.

    Gives the last login, and whether the account has revenue rows.
    """
    if users is None:
        users = user_facts(inputs, vocabulary)
    return seen_of(users, scan_product(inputs.business_metrics, vocabulary))


def seen_of(users: DataFrame, billed: DataFrame) -> DataFrame:
    """Accounts of ``users`` and of the ``billed`` rows, as in ``seen_accounts``."""
    events = users.select("account_id", "last_login_date", F.lit(False).alias("billed"))
    revenue = billed.select(
        "account_id",
        F.lit(None).cast("timestamp_ntz").alias("last_login_date"),
        F.lit(True).alias("billed"),
    )
    return (
        events.union(revenue)
        .groupBy("account_id")
        .agg(F.max("last_login_date").alias("last_login_date"), F.max("billed").alias("billed"))
    )


def join_dates(
    inputs: Inputs, vocabulary: Vocabulary, by: Sequence[Column] = ()
) -> DataFrame:
    """First metric day of every account, over all history (and for each value of ``by``)."""
    return (
        scan_product(inputs.daily_account_metrics, vocabulary)
        .groupBy(*by, "account_id")
        .agg(F.min("computation_date").alias("join_date"))
    )


@dataclass(frozen=True)
class History:
    """One row per user, user and region, account, and account.

    ``until`` is the first day whose rows are not in it; None if nothing was cut off.
    """

    first_logins: DataFrame
    first_regional_logins: DataFrame
    seen_accounts: DataFrame
    join_dates: DataFrame
    until: dt.date | None = None


def history_of(
    inputs: Inputs,
    vocabulary: Vocabulary,
    users: DataFrame | None = None,
    until: dt.date | None = None,
) -> History:
    """The history of all rows given; ``users`` are their facts, where stored already."""
    if users is None:
        users = user_facts(inputs, vocabulary)
    return history_from(
        users, seen_accounts(inputs, vocabulary, users), join_dates(inputs, vocabulary), until
    )


def history_from(
    users: DataFrame, seen: DataFrame, joined: DataFrame, until: dt.date | None
) -> History:
    """The history that these facts make up."""
    regional = users.filter(F.col("first_login_date").isNotNull()).drop("last_login_date")
    return History(
        first_logins=regional.groupBy("account_id", "user_id").agg(
            F.min("first_login_date").alias("first_login_date")
        ),
        first_regional_logins=regional,
        seen_accounts=seen,
        join_dates=joined,
        until=until,
    )


def rows_where(inputs: Inputs, test) -> Inputs:
    """Inputs whose dated history tables keep the rows for which ``test(day)`` holds."""
    return replace(
        inputs,
        raw_events=inputs.raw_events.filter(test(F.to_date("event_day"))),
        business_metrics=inputs.business_metrics.filter(test(F.col("computation_date"))),
        daily_account_metrics=inputs.daily_account_metrics.filter(
            test(F.col("computation_date"))
        ),
    )


def window_start(etl_date: dt.date) -> dt.date:
    """The first day of the run window: a run loads its days again."""
    return (etl_date.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def rows_between(inputs: Inputs, first: dt.date | None, until: dt.date | None) -> Inputs:
    """Rows of the days from ``first`` up to, but without, ``until``."""
    if first is not None:
        inputs = rows_where(inputs, lambda day: day >= F.lit(first))
    if until is not None:
        inputs = rows_where(inputs, lambda day: day < F.lit(until))
    return inputs


def history_before(inputs: Inputs, until: dt.date, vocabulary: Vocabulary) -> History:
    return history_of(rows_between(inputs, None, until), vocabulary, until=until)


def advanced(kept: History, inputs: Inputs, until: dt.date, vocabulary: Vocabulary) -> History:
    """``kept`` with the rows of the days between its end and ``until``."""
    if until < kept.until:
        raise ValueError(f"the history ends before {kept.until}, after {until}")
    between = rows_between(inputs, kept.until, until)
    return replace(fold(kept, history_of(between, vocabulary)), until=until)


def brought_up_to_date(
    kept: History, inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary
) -> History:
    """``kept`` with all rows from its end on, for the run of ``etl_date``.

    A run loads the days of its window again, from rows that may have changed; so a
    history that reaches into the window is refused.
    """
    if kept.until > window_start(etl_date):
        raise ValueError(f"the history ends before {kept.until}, inside the window of {etl_date}")
    return fold(kept, history_of(rows_between(inputs, kept.until, None), vocabulary))


def history_with_facts(
    inputs: Inputs,
    etl_date: dt.date,
    vocabulary: Vocabulary,
    facts: DataFrame,
    kept: History | None = None,
) -> History:
    """All rows' history for the run of ``etl_date``, from ``facts`` and what they lack.

    ``facts`` hold the events of the run's lookback; raw events are read only outside of
    it, and with a ``kept`` history only from its end on. So a run reads no event twice.
    """
    if kept is not None and kept.until > window_start(etl_date):
        raise ValueError(f"the history ends before {kept.until}, inside the window of {etl_date}")
    recent = inputs if kept is None else rows_between(inputs, kept.until, None)
    day = F.to_date("event_day")
    # Days are not NULL where a table is loaded by day; an event without one is in no window.
    others = recent.raw_events.filter(
        ~F.coalesce(lookback_window(day, etl_date), F.lit(False))
    )
    if kept is not None:
        facts = facts.filter(F.col("computation_date") >= F.lit(kept.until))
    rest = user_facts(replace(recent, raw_events=others), vocabulary)
    users = fold_rows(rest, user_facts_of(facts))
    found = history_of(recent, vocabulary, users)
    return found if kept is None else fold(kept, found)


def fold(older: History, newer: History) -> History:
    """The history of both sets of rows."""
    return History(
        first_logins=fold_rows(older.first_logins, newer.first_logins),
        first_regional_logins=fold_rows(older.first_regional_logins, newer.first_regional_logins),
        seen_accounts=fold_rows(older.seen_accounts, newer.seen_accounts),
        join_dates=fold_rows(older.join_dates, newer.join_dates),
    )


# What is kept of a column where two rows meet; all other columns are keys.
_KEPT = {
    "first_login_date": F.min,
    "join_date": F.min,
    "last_login_date": F.max,
    "billed": F.max,
}


def fold_rows(*parts: DataFrame) -> DataFrame:
    """One row per key: of equal keys, the earliest first days and the latest last ones."""
    rows = reduce(DataFrame.unionByName, parts)
    keys = [c for c in rows.columns if c not in _KEPT]
    return rows.groupBy(*keys).agg(
        *[_KEPT[c](c).alias(c) for c in rows.columns if c in _KEPT]
    )


HISTORY_TABLES = tuple(f.name for f in fields(History) if f.name != "until")
