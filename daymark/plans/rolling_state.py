"""Rolling figures carried forward from day to day.

In the windows that end on a day D, a member counts by its latest active day up to D, and
of the days themselves only what they add up to matters. So the state of D holds one row per
member that was active in the last ``LONG`` days, with that latest day, and one row per key,
kind and day with its totals. Both say by themselves when they leave a window: a member
after its latest day plus the width, a total after its day plus the width. The figures of D
are therefore one aggregation of the state of D, by the age of its rows.

A step reads a state and the rows of one new day and writes the next state. Its work grows
with the members of a month, not with the events of three. Rows of other days, such as late
ones, fail the step; states are kept per day, so late rows are taken in by going back to
the state before their day and taking the steps again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.dates import as_date
from daymark.operators.rolling import LONG, SHORT, activity_columns

DAY = "computation_date"
ONE_DAY = dt.timedelta(days=1)
WIDTHS = (LONG, SHORT)


@dataclass(frozen=True)
class Carried:
    """What is carried: rows unique per key, member and day, and what is counted of them.

    The first column of ``member`` is NULL in the rows of totals, the others are kinds.
    ``tests`` choose the members of each count; ``totals`` are added up per day.
    ``columns`` are the final columns, from figures named like those of ``rolling_figures``.
    """

    keys: tuple[str, ...]
    member: tuple[str, ...]
    tests: dict[str, Column]
    totals: dict[str, str]
    columns: Callable[[], list[Column]]


def carried_activity(*keys: str) -> Carried:
    """Logins and reader views of users, as ``member_days_of`` gives them."""
    login = F.col("is_login")
    tests = {"login": login, "view": ~login}
    return Carried(keys, ("user_id", "is_login"), tests, {"texts": "tuples"}, activity_columns)


def carried_readers() -> Carried:
    """Metered readers per account, from distinct days of resources."""

    def columns() -> list[Column]:
        return [
            F.col(f"n_{LONG}").alias("l30_count_reader"),
            F.col(f"n_{SHORT}").alias("l7_count_reader"),
        ]

    return Carried(("account_id",), ("usage_resource",), {"n": F.lit(True)}, {}, columns)


@dataclass(frozen=True)
class RollingState:
    """Rows of members and of totals, up to and with the day ``through``."""

    rows: DataFrame
    through: dt.date


def state_of(rows: DataFrame, carried: Carried, through: dt.date) -> RollingState:
    """The state of ``through``, from rows of days, or of an older state and days since."""
    last = as_date(through)
    recent = rows.filter(F.col(DAY).between(F.date_sub(last, LONG - 1), last))
    name, kinds, totals = carried.member[0], carried.member[1:], carried.totals.values()
    members = (
        recent.filter(F.col(name).isNotNull())
        .groupBy(*carried.keys, *carried.member)
        .agg(F.max(DAY).alias(DAY))
    )
    days = (
        recent.groupBy(*carried.keys, *kinds, DAY)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in totals])
        .drop("_n")
    )

    def null(column: str) -> Column:
        return F.lit(None).cast(rows.schema[column].dataType).alias(column)

    # A member's row adds nothing: the totals of its day are in the row of the day.
    both = members.select("*", *map(null, totals)).unionByName(days.select("*", null(name)))
    return RollingState(both, through)


def _only(rows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """``rows``, where a row of any other day fails the step instead of being lost."""
    day = F.col(DAY)
    message = F.concat(F.lit(f"taken in are rows of {first} to {last}, not "), day.cast("string"))
    refused = F.raise_error(message).cast("boolean")
    return rows.filter(F.when(day.between(F.lit(first), F.lit(last)), F.lit(True)).otherwise(refused))


def advanced_state(
    state: RollingState, new_rows: DataFrame, carried: Carried, until: dt.date
) -> RollingState:
    """The state of ``until``, from an older one and the rows of the days after it."""
    if until <= state.through:
        raise ValueError(f"the state covers {state.through} already, so not up to {until}")
    new_rows = _only(new_rows, state.through + ONE_DAY, until).select(*state.rows.columns)
    return state_of(state.rows.unionByName(new_rows), carried, until)


def figures_of(states: DataFrame, carried: Carried) -> DataFrame:
    """The figures of each day ``through`` whose state is among the rows; NULL where a window
    is empty."""
    age, member = F.datediff("through", DAY), F.col(carried.member[0]).isNotNull()
    sums = []
    for width in WIDTHS:
        inside = age < width
        day = F.when(inside & ~member, F.col(DAY))
        sums += [F.min(day).alias(f"first_{width}"), F.max(day).alias(f"last_{width}")]
        for name, test in carried.tests.items():
            sums.append(F.count_if(inside & member & test).alias(f"{name}_{width}"))
            seen = F.max(F.when(inside & ~member, test))
            sums.append(seen.alias(f"{name}_seen_{width}"))
        for name, column in carried.totals.items():
            total = F.sum(F.when(inside & ~member, F.col(column)))
            sums.append(F.coalesce(total, F.lit(0)).alias(f"{name}_{width}"))
    found = states.groupBy("through", *carried.keys).agg(*sums)
    shown = {
        c: F.when(F.col(f"last_{c.rsplit('_', 1)[1]}").isNotNull(), F.col(c))
        for c in found.columns
        if c not in ("through", *carried.keys) and not c.startswith("last_")
    }
    found = found.withColumns(shown)
    return found.select(F.col("through").alias(DAY), *carried.keys, *carried.columns())


def keep_state(state: RollingState, base: str) -> RollingState:
    """Write a state under its day, and read it back."""
    state.rows.write.mode("overwrite").parquet(f"{base}/through={state.through}")
    return kept_state(state.rows.sparkSession, base, state.through)


def kept_state(spark: SparkSession, base: str, through: dt.date) -> RollingState:
    return RollingState(spark.read.parquet(f"{base}/through={through}"), through)


def carry_forward(
    spark: SparkSession,
    base: str,
    rows: DataFrame,
    carried: Carried,
    since: dt.date,
    until: dt.date,
) -> DataFrame:
    """Daily steps from the state kept of the day before ``since``, and their figures.

    ``rows`` hold at least the days from ``since`` to ``until``; a step reads those of its
    day. A run that stops is taken up after the last state. Steps that are taken again
    replace their states: that is how late rows are taken in.
    """
    state, day = kept_state(spark, base, since - ONE_DAY), since
    while day <= until:
        today = rows.filter(F.col(DAY) == F.lit(day))
        state = keep_state(advanced_state(state, today, carried, day), base)
        day += ONE_DAY
    days = F.col("through").cast("date")
    states = spark.read.parquet(base).withColumn("through", days)
    return figures_of(states.filter(days.between(F.lit(since), F.lit(until))), carried)
