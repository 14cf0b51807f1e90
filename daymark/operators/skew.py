"""Equality joins whose frequent keys are split over several tasks.

A mergeable summary of frequent items finds the keys that hold more than one part in
``PARTS`` of the rows; there are fewer than ``PARTS`` of them, whatever the data. Their
rows are dealt over ``SALTS`` by a hash of the whole row, and the other side is copied to
the salts for just these keys; all other keys join as they are. The result is that of
the plain join for any summary, also an empty one, so nothing depends on sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is frequent above this share (1 in PARTS) of the rows.
PARTS = 32
#: Pieces of a frequent key; more than there are tasks on it, so that tasks get alike many.
SALTS = 512
#: Counters of the summary; it errs by a few rows in that many.
TRACKED = 8192
_SALT = "_salt"


def frequent_keys(rows: DataFrame, key: str, parts: int = PARTS) -> Column:
    """The keys of more than 1 in ``parts`` of the rows, as a scalar array; no NULL."""
    counted = rows.select(F.col(key).alias("_k")).agg(
        F.expr(f"approx_top_k(_k, {parts}, {TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("rows"),
    )
    often = F.filter(
        "top", lambda x: x["item"].isNotNull() & (x["count"] * parts > F.col("rows"))
    )
    return counted.select(F.transform(often, lambda x: x["item"])).scalar()


def row_salt(rows: DataFrame, salts: int = SALTS) -> Column:
    """A salt that a row keeps when its task runs again."""
    return F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")


def split_join(
    rows: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    parts: int = PARTS,
    salts: int = SALTS,
    often_in: DataFrame | None = None,
) -> DataFrame:
    """``rows.join(other, key, how)`` for joins that keep or drop rows of ``rows`` only:
    inner, left, left_semi and left_anti. Rows with a NULL key match nothing, and are dealt
    over the salts too. Where ``rows`` cost much to make, ``often_in`` is a table in which the
    same keys are frequent, such as the one they come from."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would count the copies of the other side")
    often = frequent_keys(rows if often_in is None else often_in, key, parts)
    split = F.array_contains(often, F.col(key))
    salt = F.when(split | F.col(key).isNull(), row_salt(rows, salts)).otherwise(F.lit(0))
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = F.explode(F.when(split, every).otherwise(F.array(F.lit(0))))
    salted, copied = rows.withColumn(_SALT, salt), other.withColumn(_SALT, copies)
    return salted.join(copied, [key, _SALT], how).drop(_SALT)
