"""Versions compared by digests: against a count of all rows, and what is read for it."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import types as T

from conftest import local_frame
from daymark.sources.digests import DigestedTable, differing_leaves, reconcile_tables

ONE = D("1.0000000000")
DDL = "computation_date date, k string, n long, amount decimal(38,10)"
KEYS = ("computation_date", "k")


def rows_of(days=14, keys=40):
    first = dt.date(2023, 12, 20)
    return [(first + dt.timedelta(days=d), f"k{k}", d * k, (D(k) / 8).quantize(ONE)) for d in range(days) for k in range(keys)]


@pytest.fixture
def version(spark, tmp_path):
    numbers = iter(range(100))

    def build(rows, **options):
        base = str(tmp_path / f"v{next(numbers)}")
        table = DigestedTable(spark, base, T.StructType.fromDDL(DDL), KEYS, **options)
        return table.write(local_frame(spark, rows, DDL))

    return build


def surplus(left, right):
    return sorted(map(repr, (tuple(r) for r in reconcile_tables(left, right).collect())))


def expected(left, right):
    a, b = Counter(left), Counter(right)
    return sorted(repr((*r, a[r] - b[r])) for r in a | b if a[r] != b[r])


def test_every_changed_row_is_found_and_no_other_leaf_is_read(version):
    old = rows_of()
    day = old[0][0]
    new = [r for r in old if r[:2] != (day + dt.timedelta(days=5), "k7")]  # gone
    new[3] = (*new[3][:2], None, new[3][3])  # changed to NULL
    new.append(old[300])  # twice
    new.append((day + dt.timedelta(days=200), "late", 1, None))  # a day and month of its own
    left, right = version(old), version(new)
    assert surplus(left, right) == expected(old, new) and len(expected(old, new)) == 5
    leaves = differing_leaves(left.digests(), right.digests()).collect()
    assert len(leaves) == 4
    # Days without a difference are not read, and of the others only the rows of those leaves.
    read = {path.split("/")[-2] for path in right.rows(leaves).inputFiles()}
    assert read == {f"computation_date={r.computation_date}" for r in leaves}
    assert right.rows(leaves).count() == sum(r.right_rows for r in leaves) < 40


def test_equal_and_empty_versions(version):
    rows = rows_of(3)
    assert surplus(version(rows), version(rows[::-1])) == []
    assert surplus(version([]), version([])) == []
    assert surplus(version(rows), version([])) == expected(rows, [])


def test_nulls_and_swapped_values_differ(version):
    day = dt.date(2024, 1, 1)
    left = [(day, None, 1, None), (None, "a", None, ONE), (day, "b", None, None), (day, "b", None, None)]
    right = [(day, None, None, ONE), (None, "a", 1, None), (day, "b", None, None)]
    assert surplus(version(left), version(right)) == expected(left, right)
    assert surplus(version(left), version(left)) == []


def test_versions_of_other_shape_are_refused(version):
    with pytest.raises(ValueError, match="buckets"):
        reconcile_tables(version([]), version([], buckets=8))
