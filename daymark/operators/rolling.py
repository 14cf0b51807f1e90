"""Rolling distinct counts by differences, without a range join and without copies per day.

A member (user, metered resource, account) that is active on days ``d1 < d2 < ...``
is in the window of ``w`` days ending on ``c`` exactly when its *latest* active day
up to ``c`` lies fewer than ``w`` days back. So each active day stands for the
member until the next active day or for ``w`` days, whichever is shorter; that
length is its ``span``. It becomes two rows: one more member on its day, one less
after its span. They are summed per key and day before anything is ordered, so a
very active account never meets in one task; what is left is one row per key and day
of change, and a running sum over the at most ``reach`` more days than the axis has gives
every window.

All widths share these rows. A member whose span is longer than a width leaves the
shorter window by the frame (a running sum that ends ``w`` days earlier), not by a row.
Totals of a window and its first and last day come from the same frames: each reads
one end of a window, so no frame is summed again from day to day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.dates import as_date
from daymark.functions.predicates import text_digest

LONG, SHORT = 30, 7


def member_spans(
    member_days: DataFrame, group: Sequence[str], day: str = "computation_date", reach: int = LONG
) -> DataFrame:
    """Add ``span`` to rows that are unique per group, member and day.

    A group here is one member, so it holds at most one row per day of lookback.
    """
    order = Window.partitionBy(*group).orderBy(day)
    gap = F.datediff(F.lead(day).over(order), F.col(day))
    return member_days.withColumn("span", F.least(F.coalesce(gap, F.lit(reach)), F.lit(reach)))


def changes(
    spans: DataFrame,
    keys: Sequence[str],
    widths: Sequence[int],
    members: dict[str, Column],
    totals: dict[str, Column],
    day: str = "computation_date",
) -> DataFrame:
    """What changes per key and day, from two rows per member and active day.

    ``members`` are the tests of the rows whose members are counted, ``totals`` the values
    to add up. ``active_day`` is the day itself where rows are active on it, else NULL.
    """
    comes, span, reach = F.col("_comes"), F.col("span"), max(widths)
    sums = [
        F.max(F.when(comes, F.col(day))).alias("active_day"),
        *[F.sum(F.when(comes, value)).alias(name) for name, value in totals.items()],
    ]
    for name, test in members.items():
        sums.append(F.max(F.when(comes & test, F.col(day))).alias(f"{name}_day"))
        counted = test & F.col("_counted")
        for width in widths:
            going = ~comes if width == reach else ~comes & (span <= width)
            change = F.when(comes, F.lit(1)).when(going, F.lit(-1)).otherwise(F.lit(0))
            sums.append(F.sum(F.when(counted, change).otherwise(0)).alias(f"{name}_{width}"))
            if width < reach:
                late = F.count_if(counted & comes & (span > width))
                sums.append(late.alias(f"{name}_{width}_late"))
    at = F.when(comes, F.col(day)).otherwise(F.date_add(day, span)).alias("_at")
    return (
        spans.withColumn("_comes", F.explode(F.array(F.lit(True), F.lit(False))))
        .groupBy(*keys, at)
        .agg(*sums)
    )


def on_calendar(
    changed: DataFrame, keys: Sequence[str], first: Column, last: Column
) -> DataFrame:
    """Rows of change, and between them the days of ``[first, last]`` without one.

    ``next_active_day`` is added to the rows of active days.
    """
    order = Window.partitionBy(*(keys or [F.lit(0)]))
    ahead, back = order.orderBy("_at"), order.orderBy(F.desc("_at"))
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    changed = changed.withColumns(
        {
            "_until": F.date_sub(F.lead("_at").over(ahead), 1),
            "next_active_day": F.min("active_day").over(later),
        }
    ).filter(F.col("_at") <= last)
    start, end = F.greatest(F.date_add("_at", 1), first), F.least(F.col("_until"), last)
    between = F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))
    days = F.concat(F.array("_at"), F.coalesce(between, F.array().cast("array<date>")))
    names = [c for c in changed.columns if c not in (*keys, "_at", "_until")]
    return changed.select(*keys, *names, F.posexplode(days).alias("_copy", "calendar_date")).select(
        *keys,
        "calendar_date",
        *[F.when(F.col("_copy") == 0, F.col(c)).alias(c) for c in names],
    )


def rolling_figures(
    rows: DataFrame,
    keys: Sequence[str],
    member: Sequence[str],
    first: Column,
    last: Column,
    widths: Sequence[int],
    members: dict[str, Column],
    totals: dict[str, Column] | None = None,
    day: str = "computation_date",
) -> DataFrame:
    """Figures of every window that ends on a calendar day and holds a row, by key.

    ``rows`` are unique per key, ``member`` and day; a member is counted where the first
    column of ``member`` is not NULL. For a width ``w`` there are ``first_w`` and ``last_w``
    (days with rows), ``<name>_w`` per member test and total, and ``<name>_seen_w``, whether
    a row passes the test. They are NULL where that window is empty.
    """
    totals, reach = totals or {}, max(widths)
    rows = rows.filter(F.col(day).between(F.date_sub(first, reach - 1), last))
    spans = member_spans(rows, [*keys, *member], day, reach)
    spans = spans.withColumn("_counted", F.col(member[0]).isNotNull())
    dense = on_calendar(changes(spans, keys, widths, members, totals, day), keys, first, last)

    dense = dense.withColumn("_no", F.unix_date("calendar_date"))
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_no")
    so_far = order.rangeBetween(Window.unboundedPreceding, 0)
    figures = {"_last": F.max("active_day").over(so_far), "_least": F.min("active_day").over(so_far)}
    for name in members:
        figures[f"_{name}_last"] = F.max(f"{name}_day").over(so_far)
    for width in widths:
        gone = order.rangeBetween(Window.unboundedPreceding, -width)

        def now(column: str) -> Column:
            return F.coalesce(F.sum(column).over(so_far), F.lit(0))

        def before(column: str, gone=gone) -> Column:
            return F.coalesce(F.sum(column).over(gone), F.lit(0))

        for name in totals:
            figures[f"{name}_{width}"] = now(name) - before(name)
        for name in members:
            left = before(f"{name}_{width}_late") if width < reach else F.lit(0)
            figures[f"{name}_{width}"] = now(f"{name}_{width}") - left
        # The first day of the window follows the last active day before it.
        past = F.max(F.struct("active_day", "next_active_day")).over(gone)
        figures[f"_past_{width}"] = past
    found = dense.select(
        "calendar_date", *keys, *[value.alias(name) for name, value in figures.items()]
    ).filter(F.col("calendar_date").between(first, last))

    result = []
    for width in widths:
        start = F.date_sub("calendar_date", width - 1)
        inside = F.col("_last") >= start
        past = F.col(f"_past_{width}")
        result += [
            F.when(inside, F.coalesce(past["next_active_day"], F.col("_least"))).alias(f"first_{width}"),
            F.when(inside, F.col("_last")).alias(f"last_{width}"),
        ]
        result += [
            F.when(inside, F.col(f"{name}_{width}")).alias(f"{name}_{width}")
            for name in (*members, *totals)
        ]
        for name in members:
            seen = F.coalesce(F.col(f"_{name}_last") >= start, F.lit(False))
            result.append(F.when(inside, seen).alias(f"{name}_seen_{width}"))
    return found.select("calendar_date", *keys, *result).filter(F.col(f"last_{reach}").isNotNull())


def rolling_members(
    rows: DataFrame,
    keys: Sequence[str],
    member: str,
    first: Column,
    last: Column,
    outputs: dict[str, int],
    day: str = "computation_date",
) -> DataFrame:
    """Distinct members per calendar day and key, one output column per width.

    A column is NULL where its own window holds no row at all.
    """
    days = rows.select(*keys, member, day).distinct()
    widths = list(dict.fromkeys(outputs.values()))
    found = rolling_figures(days, keys, [member], first, last, widths, {"n": F.lit(True)}, day=day)
    return found.select(
        "calendar_date", *keys, *[F.col(f"n_{w}").alias(name) for name, w in outputs.items()]
    )


def activity_member_days(activity: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Logins and reader views, one row per key, user, kind and day.

    ``tuples`` counts the different texts of the logins, as rows deduplicated over all
    their columns would. Only digests of the texts are shuffled; ``activity`` has
    ``text_digest``, or ``user_data`` to take it from.
    """
    if "text_digest" not in activity.columns:
        digest = F.when(F.col("is_login"), text_digest("user_data"))
        activity = activity.withColumn("text_digest", digest)
    return activity.groupBy(*keys, "user_id", "is_login", "computation_date").agg(
        F.count_distinct("text_digest").alias("tuples")
    )


def rolling_activity(
    activity: DataFrame, keys: Sequence[str], first: Column, last: Column
) -> DataFrame:
    """30- and 7-day activity per calendar day and key, in one pass.

    ``activity`` has the keys, ``user_id``, ``is_login``, ``computation_date`` and
    ``user_data`` or its ``text_digest``. The columns of a width are NULL where its window is empty.
    """
    return rolling_of_member_days(activity_member_days(activity, keys), keys, first, last)


def rolling_of_member_days(
    days: DataFrame, keys: Sequence[str], first: Column, last: Column
) -> DataFrame:
    """The same, from rows that are unique per key, user, kind and day."""
    login = F.col("is_login")
    found = rolling_figures(
        days,
        keys,
        ["user_id", "is_login"],
        first,
        last,
        [LONG, SHORT],
        {"login": login, "view": ~login},
        {"texts": F.when(login, F.col("tuples"))},
    )
    return found.select("calendar_date", *keys, *activity_columns())


def activity_columns() -> list[Column]:
    """The columns of the activity tables, from figures of ``login``, ``view`` and ``texts``."""
    columns = []
    for prefix, width in (("l30", LONG), ("l7", SHORT)):
        columns += [
            F.col(f"first_{width}").alias(f"{prefix}_period_first_event_date"),
            F.col(f"last_{width}").alias(f"{prefix}_period_last_event_date"),
            F.col(f"view_{width}").alias(f"{prefix}_count_active_reader"),
            F.col(f"texts_{width}").alias(f"{prefix}_total_login_event"),
            F.col(f"login_seen_{width}").cast("bigint").alias(f"{prefix}_count_active_accounts"),
            (F.col(f"login_{width}") - F.col(f"view_{width}")).alias(f"{prefix}_count_active_authors"),
        ]
    return columns


def range_counts(
    calendar: DataFrame,
    rows: DataFrame,
    member: str,
    day: str,
    width: int,
    first: dt.date | Column,
    last: dt.date | Column,
    how: str = "left",
) -> DataFrame:
    """Rows and distinct members of the ``width`` days that end on each calendar day.

    What a range join with the calendar would be aggregated to, without that join: rows
    are counted by member and day first. With ``how='inner'`` days without rows are left out.
    """
    bounds = [as_date(b) for b in (first, last)]
    axis = calendar.filter(F.col("calendar_date").between(*bounds)).select("calendar_date")
    days = rows.groupBy(member, day).agg(F.count(F.lit(1)).alias("n"))
    figures = rolling_figures(
        days, [], [member], *bounds, [width], {"member": F.lit(True)}, {"row": F.col("n")}, day
    )
    found = figures.select(
        "calendar_date",
        F.col(f"row_{width}").alias("row_count"),
        F.col(f"member_{width}").alias("member_count"),
    )
    return axis.join(found, "calendar_date", how).select(
        "calendar_date",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("row_count", "member_count")],
    )
