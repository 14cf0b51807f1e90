"""Joins the reports and jobs are made of, written so that no key can run hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.operators.skew import row_salt


def with_not_in(
    rows: DataFrame, excluded: DataFrame, column: str, flag: str
) -> DataFrame:
    """Add the value of SQL ``NOT IN`` as a column that is true or false.

    It is false where SQL gives NULL: for every row if a NULL is listed, and for a
    NULL value unless nothing is listed. Spark plans ``NOT IN`` as a broadcast of
    the whole list; here the list is joined by its key, and only two of its counts
    reach every task. Rows with a NULL match nothing; they are dealt over many tasks.
    """
    values = excluded.select(F.col(column).alias("_listed"))
    null_listed, nothing_listed = (
        values.agg(test).scalar()
        for test in (F.count_if(F.col("_listed").isNull()) > 0, F.count(F.lit(1)) == 0)
    )
    listed = values.filter(F.col("_listed").isNotNull()).distinct()
    # Zero, but not a constant to the optimizer, which would take it out of the join keys.
    listed = listed.withColumn("_place", F.pmod(F.xxhash64("_listed"), F.lit(1)))
    place = F.when(F.col(column).isNull(), row_salt(rows).cast("long")).otherwise(F.lit(0).cast("long"))
    placed = rows.withColumn("_row_place", place)
    same = (placed[column] == listed["_listed"]) & (placed["_row_place"] == listed["_place"])
    joined = placed.join(listed, same, "left").drop("_place", "_row_place")
    value = (
        ~null_listed
        & F.col("_listed").isNull()
        & (F.col(column).isNotNull() | nothing_listed)
    )
    return joined.withColumn(flag, value).drop("_listed")


def null_aware_anti_join(
    rows: DataFrame, excluded: DataFrame, column: str
) -> DataFrame:
    """SQL ``NOT IN``: a NULL among the excluded values leaves no row at all."""
    return with_not_in(rows, excluded, column, "_kept").filter("_kept").drop("_kept")


def semi_join_delete(
    rows: DataFrame, doomed: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """What ``DELETE ... WHERE key IN (...)`` leaves: rows with a NULL key stay."""
    return rows.join(doomed.select(*keys), list(keys), "left_anti")


def densify(
    accounts: DataFrame, calendar: DataFrame, first: Column, last: Column
) -> DataFrame:
    """Every account on every calendar day of ``[first, last]``.

    Each row grows its own days and then meets the calendar by equality, so no
    cross join is planned. What is broadcast is one row per day of the span.
    """
    calendar = calendar.filter(F.col("calendar_date").between(first, last))
    days = accounts.withColumn(
        "calendar_date", F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    )
    return days.join(F.broadcast(calendar), "calendar_date")


def full_join_tested(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_test: Column, side: str
) -> DataFrame:
    """FULL JOIN on equal names, where ``left_test`` must also hold for a match.

    The test replaces a key that would be NULL on many left rows: those rows are
    spread by their real keys rather than sent to one task. The right keys come
    back as ``<side>_<key>``.
    """
    renamed = right.withColumnsRenamed({k: f"{side}_{k}" for k in keys})
    condition = left_test
    for key in keys:
        condition = condition & (left[key] == renamed[f"{side}_{key}"])
    return left.join(renamed, condition, "full")
