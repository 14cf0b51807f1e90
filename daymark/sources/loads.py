"""Loading a day's result into its table, by appending or by replacing its days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.schemas import enforce_schema

DAY = "computation_date"


def clone_staging(table: DataFrame, rows: int = 0) -> DataFrame:
    """An empty frame of the same columns; ``rows=1`` also takes one stray row."""
    return table.limit(rows)


def positional(staging: DataFrame, schema: T.StructType) -> DataFrame:
    """Name the columns of ``staging`` by position, then cast and check them."""
    return enforce_schema(staging.toDF(*schema.fieldNames()), schema)


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One task per day, or several for a large one, each sorted by the key.

    Days are brought together by a hash and cut to even sizes by what the shuffle has
    measured (AQE), so the rows are computed once: a range partitioning would run the
    last stage a second time to sample them.
    """
    return df.hint("rebalance", F.col(DAY)).sortWithinPartitions(*keys)


def clustered_write(
    df: DataFrame, path: str, keys: Sequence[str], mode: str = "overwrite"
) -> None:
    """Write day directories whose files are sorted by the key."""
    clustered(df, keys).write.mode(mode).partitionBy(DAY).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table written by day, in its declared column order."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def append_load(
    staging: DataFrame, path: str, schema: T.StructType, keys: Sequence[str]
) -> None:
    """Append by position. A rerun adds the same days again."""
    clustered_write(positional(staging, schema), path, keys, "append")


def replace_days_load(
    staging: DataFrame, path: str, schema: T.StructType, keys: Sequence[str]
) -> None:
    """Replace the days that ``staging`` holds and keep all others; safe to rerun."""
    (
        clustered(positional(staging, schema), keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
