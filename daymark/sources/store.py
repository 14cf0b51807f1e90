"""Tables in versions: every load is staged in a folder of its own, then published at once.

Under a base folder, ``data/folder=<name>/<table>`` holds what one load has written, by day,
and ``log`` has rows (version, name, table, day, folder): which folders make up which day of
which table. Publishing appends one small file to the log, in which the new version is
listed completely; so a version is there with all its tables or not at all, older ones stay
readable, and nothing overwrites what it reads. A load that stops before that leaves a
folder that no version lists.

A load may have a ``name``. The names of all versions are the ledger: a correction or a
batch that is tried again under its name finds it there and changes nothing. One writer at
a time is assumed, as by the jobs. The log is read by the driver: one row per table, day and
folder of a version, whatever the size of the tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daymark.schemas import KEYS, TABLES
from daymark.sources.loads import DAY, clustered, positional

_LOG = (
    T.StructType()
    .add("version", "long")
    .add("name", "string")
    .add("table", "string")
    .add("day", "date")
    .add("folder", "string")
)
Part = tuple[str, dt.date, str]


@dataclass(frozen=True)
class Staged:
    """A written folder that no version lists yet."""

    table: str
    folder: str
    rows: DataFrame


@dataclass(frozen=True)
class TableStore:
    """The tables under ``base``, in the version that was published last."""

    spark: SparkSession
    base: str

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

    def names(self) -> set[str]:
        """Names of the loads that have been published."""
        return {row.name for row in self._log() if row.name is not None}

    def parts(self, version: int | None = None) -> list[Part]:
        """Table, day and folder of what a version consists of."""
        log = self._log()
        last = max((row.version for row in log), default=0) if version is None else version
        return [(r.table, r.day, r.folder) for r in log if r.version == last and r.table]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as the last or an older version has it."""
        found = sorted((day, folder) for t, day, folder in self.parts(version) if t == table)
        schema = TABLES[table]
        if not found:
            return self.spark.createDataFrame([], schema)
        root = f"{self.base}/data"
        paths = [f"{root}/folder={folder}/table={table}/{DAY}={day}" for day, folder in found]
        rows = self.spark.read.option("basePath", root).schema(schema).parquet(*paths)
        return rows.select(*schema.fieldNames())

    def stage(self, table: str, rows: DataFrame, name: str | None = None) -> Staged:
        """Write rows, by position, to a folder; that of a ``name`` is written anew."""
        schema = TABLES[table]
        folder = quote(name, safe="") if name else uuid.uuid4().hex
        path = f"{self.base}/data/folder={folder}/table={table}"
        placed = clustered(positional(rows, schema), KEYS[table])
        placed.write.mode("overwrite").partitionBy(DAY).parquet(path)
        written = self.spark.read.schema(schema).parquet(path)
        return Staged(table, folder, written.select(*schema.fieldNames()))

    def _staged_parts(self, staged: Sequence[Staged]) -> list[Part]:
        return [
            (s.table, row[DAY], s.folder)
            for s in staged
            for row in s.rows.select(DAY).distinct().collect()
        ]

    def publish(self, parts: Sequence[Part], name: str | None = None) -> int:
        """Make ``parts`` the next version, in one file of the log."""
        number = self.version() + 1
        listed = [(number, name, *part) for part in parts] or [(number, name, None, None, None)]
        rows = self.spark.createDataFrame(listed, _LOG).coalesce(1)
        rows.write.mode("append").parquet(f"{self.base}/log")
        return number

    def append(self, table: str, rows: DataFrame, name: str) -> bool:
        """Add a batch once, however often it is tried; whether it was added now."""
        if name in self.names():
            return False
        staged = self.stage(table, rows, name)
        self.publish([*self.parts(), *self._staged_parts([staged])], name)
        return True

    def replace_days(self, staged: Sequence[Staged], first: dt.date, last: dt.date) -> int:
        """Let the days from ``first`` to ``last`` of the staged tables be what is staged; a
        day without rows becomes empty. All tables change in one version."""
        tables = {s.table for s in staged}
        new = self._staged_parts(staged)
        outside = [day for _, day, _ in new if not first <= day <= last]
        if outside:
            raise ValueError(f"staged rows of {min(outside)} are not of {first} to {last}")
        kept = [p for p in self.parts() if p[0] not in tables or not first <= p[1] <= last]
        return self.publish([*kept, *new])

    def correct(
        self, table: str, name: str, correction: Callable[[DataFrame], DataFrame]
    ) -> bool:
        """Apply a correction to a whole table once; whether it was applied now.

        The corrected table is a new folder, and its version lists the name: a correction
        that would do harm if applied twice can be called again, also after a stop."""
        if name in self.names():
            return False
        staged = self.stage(table, correction(self.read(table)), name)
        others = [p for p in self.parts() if p[0] != table]
        self.publish([*others, *self._staged_parts([staged])], name)
        return True
