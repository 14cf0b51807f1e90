"""Checks on results: declared keys are unique, two reports agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def reconcile_reports(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    tolerance: float = 0.01,
) -> DataFrame:
    """One row per key and metric: both values, their difference and a verdict.

    ``matched`` is equality (two NULLs are equal), ``almost matched`` a difference
    of at most ``tolerance`` of the larger value, anything else ``not matched``.
    """

    def stacked(df: DataFrame, value: str) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(F.lit(m).alias("metric"), F.col(m).cast("decimal(38,10)").alias(value))
                for m in metrics
            ]
        )
        return df.select(*keys, F.inline(pairs))

    a, b = F.col("left_value"), F.col("right_value")
    gap = F.abs(a - b)
    almost = gap <= F.greatest(F.abs(a), F.abs(b)) * F.lit(str(tolerance)).cast("decimal(10,6)")
    on = [*keys, "metric"]
    return (
        stacked(left, "left_value")
        .join(stacked(right, "right_value"), on, "full")
        .select(
            *on,
            "left_value",
            "right_value",
            gap.alias("difference"),
            F.when(a.eqNullSafe(b), "matched")
            .when(almost, "almost matched")
            .otherwise("not matched")
            .alias("verdict"),
        )
    )
