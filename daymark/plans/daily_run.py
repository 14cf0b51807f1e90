"""One day's run: build the five tables in order and load them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.config import Inputs, Vocabulary
from daymark.plans.account_dimension import account_type_edition_daily
from daymark.plans.events import (
    events_daily,
    events_regional_daily,
    lookback_facts,
    user_days_of,
)
from daymark.plans.history import (
    HISTORY_TABLES,
    History,
    advanced,
    history_before,
    history_with_facts,
    window_start,
)
from daymark.plans.revenue import revenue_daily
from daymark.plans.rolling import count_user_rolling_days
from daymark.sources.store import TableStore


def run_daily(
    inputs: Inputs,
    etl_date: dt.date,
    vocabulary: Vocabulary,
    base: str,
    kept: History | None = None,
) -> dict[str, DataFrame]:
    """Load all five tables; the dimension is staged first and read by the others.

    The days of the run window change in all tables at once, in one version of the store
    under ``base``: a run that stops changes nothing, and a rerun replaces the same days,
    also those that have become empty. Raw events are read once: those of the lookback are
    reduced to facts, which are stored and serve all tables; older ones only reach the
    history, and with a ``kept`` history just those from its end on. What is stored also
    cuts the lineage of the tables after it, so a lost executor does not bring all work
    back.
    """
    facts = _stored(lookback_facts(inputs, etl_date, vocabulary), f"{base}/_facts/{etl_date}")
    user_days = _stored(user_days_of(facts, vocabulary), f"{base}/_user_days/{etl_date}")
    history = _stored_history(
        history_with_facts(inputs, etl_date, vocabulary, facts, kept),
        f"{base}/_history/{etl_date}",
        "overwrite",
    )

    store = TableStore(inputs.raw_events.sparkSession, base)
    name = "account_type_edition_daily"
    staged = {name: store.stage(name, account_type_edition_daily(inputs, etl_date, vocabulary, history))}
    arguments = (inputs, staged[name].rows, etl_date, vocabulary)
    built = {
        "events_daily": events_daily(*arguments, history, user_days),
        "events_regional_daily": events_regional_daily(*arguments, history, user_days),
        "revenue_daily": revenue_daily(*arguments),
        "count_user_rolling_days": count_user_rolling_days(*arguments, facts),
    }
    staged |= {name: store.stage(name, df) for name, df in built.items()}
    store.replace_days(list(staged.values()), window_start(etl_date), etl_date)
    return {name: store.read(name) for name in staged}


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stored_history(history: History, path: str, mode: str) -> History:
    """Write a history with the day it ends before, and read it back."""
    spark = history.join_dates.sparkSession
    for name in HISTORY_TABLES:
        getattr(history, name).write.mode(mode).parquet(f"{path}/{name}")
    end = spark.range(1).select(F.lit(history.until).cast("date").alias("until"))
    end.write.mode(mode).parquet(f"{path}/until")
    return read_history(spark, path)


def read_history(spark: SparkSession, path: str) -> History:
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in HISTORY_TABLES}
    return History(**tables, until=spark.read.parquet(f"{path}/until").first()["until"])


def keep_history(
    inputs: Inputs, etl_date: dt.date, vocabulary: Vocabulary, path: str
) -> History:
    """Write the history before the run window to a new ``path``, and read it back."""
    history = history_before(inputs, window_start(etl_date), vocabulary)
    return _stored_history(history, path, "errorifexists")


def advance_history(
    kept: History, inputs: Inputs, to_day: dt.date, vocabulary: Vocabulary, path: str
) -> History:
    """Write ``kept`` with the rows up to, but without, ``to_day`` to a new ``path``."""
    return _stored_history(advanced(kept, inputs, to_day, vocabulary), path, "errorifexists")
