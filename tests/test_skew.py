"""Joins with split keys against plain joins, and the tasks they make."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daymark.operators.joins import null_aware_anti_join
from daymark.operators.skew import frequent_keys, split_join
from verification.inputs import ETL_DATE, VOCABULARY, inputs


def keyed(spark, n):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 == 0, None)
    return spark.range(n).select(hot.otherwise((F.col("id") % 700).cast("string")).alias("k"), "id")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_joins_equal_plain_joins(spark, how):
    rows = keyed(spark, 3000)
    other = spark.range(900).select(F.when(F.col("id") < 890, F.col("id").cast("string")).otherwise("hot").alias("k"), F.col("id").alias("v"))
    expected = sorted(map(str, rows.join(other, "k", how).collect()))
    assert sorted(map(str, split_join(rows, other, "k", how).collect())) == expected
    assert sorted(map(str, split_join(rows, other.limit(0), "k", how).collect())) == sorted(
        map(str, rows.join(other.limit(0), "k", how).collect())
    )
    assert split_join(rows.limit(0), other, "k", how).count() == 0


def test_other_joins_are_refused(spark):
    rows = keyed(spark, 10)
    with pytest.raises(ValueError, match="full join"):
        split_join(rows, rows, "k", "full")


def test_only_frequent_keys_are_found(spark):
    assert keyed(spark, 30_000).limit(1).select(frequent_keys(keyed(spark, 30_000), "k")).first()[0] == ["hot"]
    assert spark.range(1).select(frequent_keys(keyed(spark, 0), "k")).first()[0] == []


def rows_per_task(spark, joined):
    """Rows after a join with broadcast off, by the task that gives them."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    settings["spark.sql.shuffle.partitions"] = "16"
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        counts = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
        return sorted(r["count"] for r in counts)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_hot_key_and_null_keys_are_spread(spark):
    rows = keyed(spark, 60_000)
    other = rows.select("k").distinct()
    tasks = rows_per_task(spark, split_join(rows, other, "k", "left"))
    assert len(tasks) == 16 and tasks[-1] < 2 * tasks[8], tasks
    plain = rows_per_task(spark, rows.join(other, "k"))
    assert plain[-1] > 5 * plain[len(plain) // 2], plain
    nulls = rows.withColumn("k", F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id").cast("string")))
    kept = null_aware_anti_join(nulls, spark.range(0).select(F.col("id").cast("string").alias("k")), "k")
    tasks = rows_per_task(spark, kept)
    assert sum(tasks) == 60_000 and tasks[-1] < 2 * tasks[8]


def test_boards_split_the_hot_account(spark):
    from daymark.plans.boards import external_activity

    tables = inputs(spark, "/root/testdata/sf0.001")
    plan = external_activity(tables, VOCABULARY)._jdf.queryExecution().optimizedPlan().toString()
    assert "approx_top_k" in plan and "_salt" in plan and ETL_DATE
