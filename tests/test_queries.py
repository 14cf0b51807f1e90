"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.compare import connect, difference
from verification.queries import oracle_queries, spark_queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = spark_queries(), oracle_queries()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, key):
    assert difference(QUERIES[key](spark, SF), connection, SQL[key]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
