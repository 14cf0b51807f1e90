"""Ordered and top-k reports with an explicit place for NULL and for ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_K = 10


def newest_first(df: DataFrame, day: str = "computation_date") -> DataFrame:
    return df.orderBy(F.desc(day))


def top_k(
    df: DataFrame,
    by: str,
    ties: Sequence[str],
    k: int = TOP_K,
    nulls_first: bool = False,
) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal values are ordered by ``ties``."""
    order = F.desc_nulls_first(by) if nulls_first else F.desc_nulls_last(by)
    return df.orderBy(order, *[F.asc_nulls_last(c) for c in ties]).limit(k)
