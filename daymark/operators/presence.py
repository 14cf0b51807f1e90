"""Days of presence as bits: one number per member answers every window of every width.

Bit ``i`` of a mask says that the member was there ``i`` days before the mask's end. A member
is in a window exactly when the mask and the window's bits have one in common, so counts for
any number of windows come from one row per member, without a copy of it per day or window.
Masks of one member are merged by OR: of a member's regions, of an account's users.

A mask reaches back 63 days. A longer axis is cut into runs of days, each with a mask of its
own that ends on the run's last day and reaches back far enough for the run's first window.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a mask; the sign bit of a long is left alone.
REACH = 63


@dataclass(frozen=True)
class Run:
    """Days ``first`` to ``last`` of an axis, whose windows one mask can answer."""

    name: str
    first: dt.date
    last: dt.date

    def days(self) -> Iterator[dt.date]:
        for i in range((self.last - self.first).days + 1):
            yield self.first + dt.timedelta(days=i)

    def window(self, end: dt.date, width: int) -> int:
        """The bits of the ``width`` days up to ``end``."""
        return ((1 << width) - 1) << (self.last - end).days


def runs(name: str, first: dt.date, last: dt.date, widest: int) -> list[Run]:
    """The axis from ``first`` to ``last`` in as few runs as windows of ``widest`` days allow."""
    length = REACH - widest + 1
    if length < 1:
        raise ValueError(f"a window of {widest} days; a mask reaches back {REACH}")
    found = []
    while first <= last:
        end = min(last, first + dt.timedelta(days=length - 1))
        found.append(Run(f"{name}_{len(found)}", first, end))
        first = end + dt.timedelta(days=1)
    return found


def presence(day: str, run: Run, when: Column) -> Column:
    """Aggregate: the mask of the days on which ``when`` holds; 0 where there are none."""
    age = F.datediff(F.lit(run.last), F.col(day))
    bit = F.when(when & age.between(0, REACH - 1), F.call_function("shiftleft", F.lit(1).cast("long"), age))
    return F.coalesce(F.bit_or(bit), F.lit(0).cast("long")).alias(run.name)


def merged(rows: DataFrame, keys: Sequence[str], masks: Sequence[str]) -> DataFrame:
    """One row per ``keys`` with the OR of each mask."""
    return rows.groupBy(*keys).agg(*[F.bit_or(m).alias(m) for m in masks])


def window_counts(
    members: DataFrame, axis: Sequence[Run], widths: Mapping[str, int], known: Column, day: str
) -> DataFrame:
    """Per day of the axis, the members with a day in each window that ends there.

    ``members`` has one row per member; those that are not ``known`` are not counted. One
    aggregation gives one row, which is then turned into one row per day.
    """
    found = [(run, end) for run in axis for end in run.days()]
    counts = [
        F.count_if(known & (F.col(run.name).bitwiseAND(F.lit(run.window(end, width))) != 0)).alias(f"n{i}_{j}")
        for i, (run, end) in enumerate(found)
        for j, width in enumerate(widths.values())
    ]
    rows = [
        F.struct(F.lit(end).alias(day), *[F.col(f"n{i}_{j}").alias(n) for j, n in enumerate(widths)])
        for i, (_, end) in enumerate(found)
    ]
    return members.agg(*counts).select(F.inline(F.array(*rows)))
