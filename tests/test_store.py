"""Versions of tables: loads that stop half-way, retries, emptied days and corrections."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import local_frame
from daymark.schemas import TABLES
from daymark.sources.store import TableStore

NAME = "count_user_rolling_days"


def rows_of(spark, *rows):
    """Rows of a table: day of January, account and its authors; other columns are NULL."""
    df = local_frame(spark, [(dt.date(2024, 1, d), a, n) for d, a, n in rows], "day date, account string, n bigint")
    given = {"computation_date": "day", "account_id": "account", "l30_count_active_authors": "n"}
    return df.select(
        *[
            (F.col(given[f.name]) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[NAME]
        ]
    )


def shown(df):
    found = df.select("computation_date", "account_id", "l30_count_active_authors").collect()
    return sorted((r[0].day, r[1], r[2]) for r in found)


def test_a_load_that_stops_changes_nothing_and_can_be_tried_again(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    assert store.version() == 0 and store.read(NAME).count() == 0
    assert store.append(NAME, rows_of(spark, (1, "a", 1), (2, "a", 2)), "one")
    batch = rows_of(spark, (2, "b", 3), (3, "b", 4))
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.append(NAME, batch, "two")
    assert shown(store.read(NAME)) == [(1, "a", 1), (2, "a", 2)]
    assert store.append(NAME, batch, "two") and not store.append(NAME, batch, "two")
    assert shown(store.read(NAME)) == [(1, "a", 1), (2, "a", 2), (2, "b", 3), (3, "b", 4)]
    assert shown(store.read(NAME, version=1)) == [(1, "a", 1), (2, "a", 2)]
    assert store.names() == {"one", "two"}


def test_emptied_days_go_and_others_stay(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.append(NAME, rows_of(spark, (1, "a", 1), (2, "a", 2), (3, "a", 3)), "one")
    staged = store.stage(NAME, rows_of(spark, (3, "b", 9)))
    with pytest.raises(ValueError, match="staged rows of 2024-01-03"):
        store.replace_days([staged], dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    store.replace_days([staged], dt.date(2024, 1, 2), dt.date(2024, 1, 4))
    assert shown(store.read(NAME)) == [(1, "a", 1), (3, "b", 9)]


def test_a_correction_is_applied_once(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path))
    store.append(NAME, rows_of(spark, (1, "a", 1), (2, "a", 2)), "one")

    def halved(table):
        n = F.col("l30_count_active_authors")
        return table.withColumn("l30_count_active_authors", n - 1)

    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.correct(NAME, "less one", halved)
    assert shown(store.read(NAME)) == [(1, "a", 1), (2, "a", 2)]
    assert store.correct(NAME, "less one", halved) and not store.correct(NAME, "less one", halved)
    assert shown(store.read(NAME)) == [(1, "a", 0), (2, "a", 1)]
