"""A history kept by month, in a tree: late and corrected days rebuild one month of it.

First and last days can be merged but not taken back: when a row of an old day is withdrawn,
a history kept as a whole no longer knows what was there without it. Here the facts of each
month (first and last logins per user and region, billed accounts, first metric days) are
segments of their own. Segments of a year are merged into one, those of all years into the
root, from which a run reads its history. A day that has changed means reading the raw rows
of its month, the months of its year and the years, whatever the length of the history.

Under a base folder, ``data/folder=<name>/level=<level>/facts=<table>/period=<first day>``
holds segments, and ``log`` which folders make up a version. Folders are written first, and
a version is one small file appended to the log, so a run that stops changes nothing and
older versions stay readable. One writer at a time is assumed. The log is read by the
driver: one row per segment and table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.config import Inputs, Vocabulary
from daymark.plans.history import (
    History,
    fold_rows,
    history_from,
    join_dates,
    rows_between,
    rows_where,
    seen_of,
    user_facts,
)
from daymark.sources.tables import scan_product

#: The facts of a segment; ``period`` is its first day.
FACTS = {
    "users": "account_id string, region string, user_id string, "
    "first_login_date date, last_login_date timestamp_ntz, period date",
    "billed": "account_id string, billed boolean, period date",
    "joined": "account_id string, join_date date, period date",
}
#: The one segment of the root begins here, so that it looks like the others.
ROOT = dt.date(1970, 1, 1)
#: From the leaves up: the first day of the segment that a day (of a segment) belongs to.
LEVELS: dict[str, Callable[[Column], Column]] = {
    "month": lambda day: F.trunc(day, "month"),
    "year": lambda day: F.trunc(day, "year"),
    "all": lambda day: F.when(day.isNotNull(), F.lit(ROOT)),
}
_LOG = (
    T.StructType()
    .add("version", "long")
    .add("until", "date")
    .add("level", "string")
    .add("facts", "string")
    .add("period", "date")
    .add("folder", "string")
)
Part = tuple[str, str, dt.date, str]


def month_facts(inputs: Inputs, vocabulary: Vocabulary) -> dict[str, DataFrame]:
    """The facts of every month of ``inputs``, each table read once. Rows without a day are
    in no month."""
    month = LEVELS["month"]
    of_day = month(F.col("computation_date")).alias("period")
    billed = scan_product(inputs.business_metrics, vocabulary).groupBy(of_day, "account_id")
    found = {
        "users": user_facts(inputs, vocabulary, [month(F.to_date("event_day")).alias("period")]),
        "billed": billed.agg(F.lit(True).alias("billed")),
        "joined": join_dates(inputs, vocabulary, [of_day]),
    }
    return {name: df.filter(F.col("period").isNotNull()) for name, df in found.items()}


def first_of_month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def first_of_year(day: dt.date) -> dt.date:
    return day.replace(month=1, day=1)


def _within(periods: Iterable[dt.date]) -> Callable[[Column], Column]:
    """Whether a day is in one of these months; as ranges, which reach the scan."""

    def test(day: Column) -> Column:
        found = F.lit(False)
        for first in sorted(set(periods)):
            after = first_of_month(first + dt.timedelta(days=31))
            found |= (day >= F.lit(first)) & (day < F.lit(after))
        return found

    return test


@dataclass(frozen=True)
class SegmentedHistory:
    """The history under ``base``, in the version that was published last."""

    spark: SparkSession
    base: str
    vocabulary: Vocabulary

    def _log(self) -> list[T.Row]:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.base}/log").collect()
        except AnalysisException as error:
            # The log does not exist before the first version.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def version(self) -> int:
        """The number of the last version; 0 before the first."""
        return max((row.version for row in self._log()), default=0)

    def _state(self, version: int | None = None) -> tuple[dt.date, list[Part]]:
        log = self._log()
        number = max((r.version for r in log), default=0) if version is None else version
        rows = [r for r in log if r.version == number]
        if not rows:
            raise ValueError(f"no version {number} of a history in {self.base}")
        return rows[0].until, [(r.level, r.facts, r.period, r.folder) for r in rows if r.level]

    def history(self, version: int | None = None) -> History:
        """The history of all rows before the day it ends before, from the root."""
        until, parts = self._state(version)
        root = {
            name: self._read([p for p in parts if p[0] == "all"], name).drop("period")
            for name in FACTS
        }
        return history_from(
            root["users"], seen_of(root["users"], root["billed"]), root["joined"], until
        )

    def build(self, inputs: Inputs, until: dt.date) -> int:
        """Start from all rows before ``until``, in one pass over them."""
        rows = rows_between(inputs, None, until)
        return self._publish(until, self._climb(month_facts(rows, self.vocabulary), [], None))

    def advance(self, inputs: Inputs, until: dt.date) -> int:
        """Take in the rows from the present end up to, but without, ``until``."""
        end, parts = self._state()
        if until < end:
            raise ValueError(f"the history ends before {end}, after {until}")
        new = month_facts(rows_between(inputs, end, until), self.vocabulary)
        # The month in which the history ended may be there in part.
        begun = [p for p in parts if p[0] == "month" and p[2] == first_of_month(end)]
        merged = {name: fold_rows(self._read(begun, name), new[name]) for name in FACTS}
        months = []
        month = first_of_month(end)
        while month < until:
            months.append(month)
            month = first_of_month(month + dt.timedelta(days=31))
        return self._publish(until, self._climb(merged, parts, months))

    def restate(self, inputs: Inputs, days: Sequence[dt.date]) -> int:
        """Make up for rows that were added, changed or withdrawn on ``days``.

        Of ``inputs``, only the months of these days are read.
        """
        until, parts = self._state()
        outside = [day for day in days if day >= until]
        if outside:
            raise ValueError(f"{min(outside)} is not in the history, which ends before {until}")
        months = sorted({first_of_month(day) for day in days})
        if not months:
            return self.version()
        rows = rows_where(rows_between(inputs, None, until), _within(months))
        return self._publish(until, self._climb(month_facts(rows, self.vocabulary), parts, months))

    def _climb(
        self,
        facts: dict[str, DataFrame],
        parts: Sequence[Part],
        months: Sequence[dt.date] | None,
    ) -> list[Part]:
        """Replace ``months`` (None: all) by ``facts``, and what lies above them."""
        changed = {
            "month": months,
            "year": months and sorted({first_of_year(m) for m in months}),
            "all": months and [ROOT],
        }
        kept = [] if months is None else list(parts)
        below: list[Part] = []
        for level, first_day in LEVELS.items():
            periods = changed[level]
            if level != "month":
                # All segments below, also those that have not changed.
                facts = {
                    name: fold_rows(
                        self._read(self._under(level, below, periods), name).withColumn(
                            "period", first_day(F.col("period"))
                        )
                    )
                    for name in FACTS
                }
            kept = [p for p in kept if p[0] != level or p[2] not in (periods or ())]
            kept += self._write(level, facts)
            below = [p for p in kept if p[0] == level]
        return kept

    @staticmethod
    def _under(
        level: str, below: Sequence[Part], periods: Sequence[dt.date] | None
    ) -> list[Part]:
        if level == "all" or periods is None:
            return list(below)
        return [p for p in below if first_of_year(p[2]) in periods]

    def _write(self, level: str, facts: dict[str, DataFrame]) -> list[Part]:
        folder = f"f-{uuid.uuid4().hex}"
        parts = []
        for name, df in facts.items():
            path = f"{self.base}/data/folder={folder}/level={level}/facts={name}"
            schema = T.StructType.fromDDL(FACTS[name])
            rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
            rows.hint("rebalance", F.col("period")).write.partitionBy("period").parquet(path)
            written = self.spark.read.schema(schema).parquet(path)
            periods = written.select("period").distinct().collect()
            parts += [(level, name, row["period"], folder) for row in periods]
        return parts

    def _read(self, parts: Sequence[Part], name: str) -> DataFrame:
        schema = T.StructType.fromDDL(FACTS[name])
        root = f"{self.base}/data"
        paths = [
            f"{root}/folder={folder}/level={level}/facts={facts}/period={period}"
            for level, facts, period, folder in sorted(parts)
            if facts == name
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.option("basePath", root).schema(schema).parquet(*paths)
        return rows.select(*schema.fieldNames())

    def _publish(self, until: dt.date, parts: Sequence[Part]) -> int:
        number = self.version() + 1
        listed = [(number, until, *p) for p in parts] or [(number, until, *[None] * 4)]
        rows = self.spark.createDataFrame(listed, _LOG).coalesce(1)
        rows.write.mode("append").parquet(f"{self.base}/log")
        return number
