"""Tables with a tree of digests, by which two versions are compared without reading both.

The rows of a version are stored by day, sorted by bucket (a hash of the key), and beside them
one small row per leaf (day, bucket): the number of rows and two sums over 64-bit hashes of whole
rows. Sums do not depend on the order of rows and count repeated ones, and those of a month
or a day are the sums of their leaves, so every level of the tree comes from the leaves.

Two versions are compared from the top down: months, the days of months that differ, the
leaves of days that differ. Of the rows, only days that differ are read again, by path, and of
their files what the reader cannot skip by bucket; rows of differing leaves are compared whole. Two different leaves are taken for equal only if the count and
both sums, over two hashes with salts of their own, agree by chance.

A version is written once, digests last; a folder without them is not a version. The leaves
that differ are listed by the driver: at most days times buckets, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.sources.loads import DAY

BUCKETS = 16
BUCKET = "digest_bucket"
#: The folder name that Spark gives to a NULL day.
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_SUM = "decimal(38,0)"
_SUMS = ("row_count", "digest_a", "digest_b")
_DIGESTS = f"{DAY} date, {BUCKET} int, row_count long, digest_a {_SUM}, digest_b {_SUM}"


def _levels() -> list[dict[str, Column]]:
    """From the top down: the columns that name a node."""
    day = F.col(DAY)
    month = F.trunc(day, "month").alias("month")
    return [{"month": month}, {"month": month, DAY: day}, {DAY: day, BUCKET: F.col(BUCKET)}]


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    # A hash skips NULLs, so which columns are NULL is hashed as well.
    parts = [p for c in columns for p in (F.col(c), F.col(c).isNull())]
    return F.xxhash64(F.lit(salt), *parts).cast(_SUM)


@dataclass(frozen=True)
class DigestedTable:
    """One version of a table under ``base``; ``keys`` place its rows in buckets."""

    spark: SparkSession
    base: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = BUCKETS

    def write(self, df: DataFrame) -> DigestedTable:
        """Store the rows, then the digests of what was stored."""
        names = self.schema.fieldNames()
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        rows = df.select(*names, bucket.cast("int").alias(BUCKET))
        (
            rows.hint("rebalance", F.col(DAY))
            .sortWithinPartitions(DAY, BUCKET, *[k for k in self.keys if k != DAY])
            .write.partitionBy(DAY)
            .parquet(f"{self.base}/rows")
        )
        leaves = self._read().groupBy(DAY, BUCKET).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(_row_hash(names, 1)).alias("digest_a"),
            F.sum(_row_hash(names, 2)).alias("digest_b"),
        )
        leaves.write.parquet(f"{self.base}/digests")
        return self

    def digests(self) -> DataFrame:
        """One row per leaf: rows and sums of hashes."""
        return self.spark.read.schema(_DIGESTS).parquet(f"{self.base}/digests")

    def rows(self, leaves: Sequence[T.Row] | None = None) -> DataFrame:
        """All rows, or those of ``leaves`` alone."""
        names = self.schema.fieldNames()
        if leaves is None:
            return self._read().select(*names)
        if not leaves:
            return self.spark.createDataFrame([], self.schema)
        wanted = self.spark.createDataFrame(
            [(r[DAY], r[BUCKET]) for r in leaves], "of_day date, of_bucket int"
        )
        rows = self._read(sorted({str(r[DAY] or _NO_DAY) for r in leaves}))
        rows = rows.filter(F.col(BUCKET).isin(sorted({r[BUCKET] for r in leaves})))
        here = F.col(DAY).eqNullSafe(F.col("of_day")) & (F.col(BUCKET) == F.col("of_bucket"))
        return rows.join(F.broadcast(wanted), here, "left_semi").select(*names)

    def _read(self, days: Sequence[str] | None = None) -> DataFrame:
        root = f"{self.base}/rows"
        # The schema lists the partition column, so its type is not guessed.
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        paths = [root] if days is None else [f"{root}/{DAY}={day}" for day in days]
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _nodes(leaves: DataFrame, level: dict[str, Column], side: str) -> DataFrame:
    sums = [F.sum(c).cast(_SUM).alias(f"{side}_{c}") for c in _SUMS]
    names = [F.col(n).alias(f"{side}_{n}") for n in level]
    return leaves.select(*level.values(), *_SUMS).groupBy(*level).agg(*sums).select(*names, *[f"{side}_{c}" for c in _SUMS])


def _pairs(names: Sequence[str], left: str, right: str) -> Column:
    """Whether both sides agree in all of ``names``; NULLs agree."""
    return reduce(and_, [F.col(f"{left}_{n}").eqNullSafe(F.col(f"{right}_{n}")) for n in names])


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Day and bucket of the leaves that differ, with the rows of either side in them.

    ``left`` and ``right`` are digests. A level is compared only below nodes that differ.
    """
    sides = {"left": left, "right": right}
    for level in _levels():
        names = list(level)
        a, b = (_nodes(leaves, level, side) for side, leaves in sides.items())
        met = a.join(b, _pairs(names, "left", "right"), "full")
        found = met.filter(~_pairs(_SUMS, "left", "right")).select(
            *[F.coalesce(f"left_{n}", f"right_{n}").alias(f"node_{n}") for n in names],
            *[F.coalesce(f"{s}_row_count", F.lit(0)).cast("long").alias(f"{s}_rows") for s in sides],
        )
        nodes = found.drop("left_rows", "right_rows")
        # The leaves below these nodes.
        for side, leaves in sides.items():
            named = leaves.select("*", *[c.alias(f"own_{n}") for n, c in level.items()])
            near = named.join(nodes, _pairs(names, "own", "node"), "left_semi")
            sides[side] = near.select(*leaves.columns)
    return found.select(*[F.col(f"node_{n}").alias(n) for n in names], "left_rows", "right_rows")


def reconcile_tables(left: DigestedTable, right: DigestedTable) -> DataFrame:
    """Rows that one version has more often than the other, with ``surplus``: how much more
    often the left one has it (less than 0: the right one).

    A changed row is in the result twice, as it was and as it is. NULLs are equal to NULLs;
    repeated rows count. Both versions need the same columns, keys and buckets.
    """
    if (left.schema.fieldNames(), tuple(left.keys), left.buckets) != (
        right.schema.fieldNames(),
        tuple(right.keys),
        right.buckets,
    ):
        raise ValueError("versions with other columns, keys or buckets cannot be compared")
    leaves = differing_leaves(left.digests(), right.digests()).collect()
    sides = [
        table.rows([r for r in leaves if r[f"{side}_rows"]]).withColumn("surplus", F.lit(sign))
        for table, side, sign in ((left, "left", 1), (right, "right", -1))
    ]
    names = left.schema.fieldNames()
    both = sides[0].unionByName(sides[1]).groupBy(*names)
    return both.agg(F.sum("surplus").alias("surplus")).filter(F.col("surplus") != 0)
