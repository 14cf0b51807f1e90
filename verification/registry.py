"""The query registry and what a query may use."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.plans.account_dimension import account_type_edition_daily
from daymark.plans.events import events_daily, events_regional_daily
from daymark.plans.revenue import revenue_daily
from daymark.plans.rolling import count_user_rolling_days
from verification.inputs import ETL_DATE, VOCABULARY, inputs
from verification.oracle import query


@dataclass(frozen=True, eq=False)
class Context:
    """One session on one scale: the source tables and the five jobs, all lazy."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def inputs(self):
        return inputs(self.spark, self.sf_dir)

    @cached_property
    def dimension(self) -> DataFrame:
        return account_type_edition_daily(self.inputs, ETL_DATE, VOCABULARY)

    def job(self, build: Callable[..., DataFrame]) -> DataFrame:
        return build(self.inputs, self.dimension, ETL_DATE, VOCABULARY)

    @cached_property
    def events(self) -> DataFrame:
        return self.job(events_daily)

    @cached_property
    def regional(self) -> DataFrame:
        return self.job(events_regional_daily)

    @cached_property
    def revenue(self) -> DataFrame:
        return self.job(revenue_daily)

    @cached_property
    def rolling(self) -> DataFrame:
        return self.job(count_user_rolling_days)

    @cached_property
    def event_days(self) -> DataFrame:
        return self.inputs.raw_events.withColumn("day", F.to_date("event_day"))

    def new_path(self) -> str:
        """A new folder in the session's shared folder, or else in its warehouse."""
        base = self.spark.conf.get("spark.checkpoint.dir", None)
        return f"{base or self.spark.conf.get('spark.sql.warehouse.dir')}/{uuid.uuid4().hex}"


@cache
def context(spark: SparkSession, sf_dir: str) -> Context:
    """One context per session and scale: plans are built once and run as often as asked."""
    return Context(spark, sf_dir)


Build = Callable[[Context], DataFrame]
CASES: dict[str, tuple[Build, str | None]] = {}


def case(key: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under ``key``, with the SQL that must give the same rows."""

    def register(build: Build) -> Build:
        if key in CASES:
            raise ValueError(f"query {key} is registered twice")
        CASES[key] = (build, sql)
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Computed decimals in one common type, so that both engines print them alike."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("decimal(38,10)").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: plain(build(context(spark, sf_dir)))

    return {key: runner(build) for key, (build, _) in CASES.items()}


def oracle_queries() -> dict[str, str]:
    return {key: query(sql) for key, (_, sql) in CASES.items() if sql is not None}
