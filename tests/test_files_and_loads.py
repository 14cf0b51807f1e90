"""Delimited files and table loads."""

from __future__ import annotations

import gzip
import os
import re
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from conftest import ETL, account, login
from daymark.plans.account_dimension import account_type_edition_daily
from daymark.plans.events import events_daily
from daymark.schemas import KEYS, TABLES, _text, enforce_schema
from daymark.sources import loads
from daymark.sources.delimited import (
    MAX_BAD_ROWS,
    _raw,
    _typed,
    export_delimited,
    import_delimited,
    import_with_rejects,
)
from verification.case_sources import _loaded
from verification.registry import Context

SCHEMA = (
    StructType()
    .add("id", "long")
    .add("amount", DecimalType(38, 30))
    .add("day", "date")
    .add("text", "string")
)
TEXTS = [
    "plain",
    "pipe | inside",
    'quote " inside',
    '"quoted"',
    "line\nbreak",
    "ends with backslash \\",
    'backslash quote \\" both',
    "\\\\ two",
    '\\|"|"\n"|"',
    "  padded  ",
    "tab\there",
    "carriage\rreturn",
    "ünïcode ✓",
    "\\n literal",
    '"',
    "\\",
    "#comment",
]


def test_text_survives_a_round_trip(spark, tmp_path):
    rows = [(i, Decimal("1.25"), ETL, t) for i, t in enumerate(TEXTS)]
    rows += [(100, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    export_delimited(df, str(tmp_path / "x"))
    back = import_delimited(spark, str(tmp_path / "x"), SCHEMA)
    assert back.schema == SCHEMA
    assert {r.id: r for r in back.collect()} == {r.id: r for r in df.collect()}


def test_blank_and_empty_text_become_null(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, "   "), (3, "x"), (4, None)], "id int, text string")
    export_delimited(df, str(tmp_path / "x"))
    back = import_delimited(spark, str(tmp_path / "x"), df.schema)
    assert sorted((r.id, r.text) for r in back.collect()) == [
        (1, None), (2, None), (3, "x"), (4, None)
    ]


def test_export_replaces_and_splits_files(spark, tmp_path):
    path = str(tmp_path / "x")
    export_delimited(spark.range(10).coalesce(1), path)
    export_delimited(spark.range(25).coalesce(1), path, rows_per_file=10)
    files = [f for f in os.listdir(path) if f.endswith(".csv.gz")]
    assert len(files) == 3
    assert import_delimited(spark, path, spark.range(1).schema).count() == 25


def write(tmp_path, content: bytes) -> str:
    path = tmp_path / "in"
    path.mkdir()
    with gzip.open(path / "part.csv.gz", "wb") as file:
        file.write(content)
    return str(path)


def test_invalid_characters_become_spaces(spark, tmp_path):
    path = write(tmp_path, b'"1"|"a\xffb"\n')
    schema = StructType.fromDDL("id int, text string")
    assert [tuple(r) for r in import_delimited(spark, path, schema).collect()] == [(1, "a b")]


@pytest.mark.parametrize("bad, fails", [(10, False), (11, True)])
def test_ten_bad_rows_are_skipped_and_eleven_fail(spark, tmp_path, bad, fails):
    kinds = [b'"x"|"text"\n', b'"1"|"too"|"many"\n', b'"1"\n', b'"1"|"toolong"\n']
    body = b'"7"|"good"\n' + b"".join(kinds[i % 4] for i in range(bad))
    path = write(tmp_path, body)
    schema = StructType([*StructType.fromDDL("id int"), _text("text", 4)])
    df = import_delimited(spark, path, schema, MAX_BAD_ROWS)
    staging = str(tmp_path / "staging")
    if fails:
        with pytest.raises(Exception, match="11 bad rows"):
            df.collect()
        with pytest.raises(ValueError, match="11 bad rows"):
            import_with_rejects(spark, path, schema, staging, MAX_BAD_ROWS)
    else:
        assert [tuple(r) for r in df.collect()] == [(7, "good")]
        assert df.count() == 1
        good, rejected = import_with_rejects(spark, path, schema, staging, MAX_BAD_ROWS)
        assert [tuple(r) for r in good.collect()] == [(7, "good")]
        assert rejected.count() == bad
        assert {r["reason"] for r in rejected.collect()} == {"id", "number of fields", "text"}
        assert all(r["file"].endswith(".gz") and r["raw"] for r in rejected.collect())
    with pytest.raises(Exception, match="bad rows"):
        import_delimited(spark, path, schema).collect()


def test_text_size_counts_bytes(spark):
    schema = StructType([_text("text", 4)])
    df = spark.createDataFrame([("abcd",)], "text string")
    assert enforce_schema(df, schema).collect()[0].text == "abcd"
    with pytest.raises(Exception, match="longer than 4 bytes"):
        enforce_schema(spark.createDataFrame([("abcé",)], "text string"), schema).collect()


def test_declared_tables_have_their_columns():
    sizes = {name: len(schema) for name, schema in TABLES.items()}
    assert sizes == {
        "account_type_edition_daily": 14,
        "events_daily": 39,
        "events_regional_daily": 46,
        "revenue_daily": 31,
        "count_user_rolling_days": 28,
    }
    assert TABLES["revenue_daily"].fieldNames()[-3:] == [
        "dw_create_date", "dw_update_date", "net_revenue"
    ]


@pytest.fixture
def events(make, words):
    inputs = make(
        raw_events=[login("2024-01-10", "a", "u"), login("2023-12-05", "a", "u")],
        account_details=[account("a")],
    )
    dimension = account_type_edition_daily(inputs, ETL, words)
    return events_daily(inputs, dimension, ETL, words)


def test_append_duplicates_and_replacing_days_does_not(spark, tmp_path, events):
    schema, keys = TABLES["events_daily"], KEYS["events_daily"]
    appended, replaced = str(tmp_path / "a"), str(tmp_path / "r")
    rows = events.count()
    assert rows == 61
    for _ in range(2):
        loads.append_load(events, appended, schema, keys)
        loads.replace_days_load(events, replaced, schema, keys)
    january = events.filter("computation_date >= '2024-01-01'")
    renamed = january.withColumn("company_name", F.lit("new"))
    loads.replace_days_load(renamed, replaced, schema, keys)
    assert loads.read_table(spark, appended, schema).count() == 2 * rows
    table = loads.read_table(spark, replaced, schema)
    assert table.columns == schema.fieldNames()
    assert table.count() == rows
    assert table.filter("company_name = 'new'").count() == 30


def test_load_is_positional(spark, tmp_path, events):
    schema, keys = TABLES["events_daily"], KEYS["events_daily"]
    staging = events.toDF(*[f"c{i}" for i in range(len(schema))])
    loads.append_load(staging, str(tmp_path / "t"), schema, keys)
    assert loads.read_table(spark, str(tmp_path / "t"), schema).exceptAll(events).count() == 0


def test_clone_has_the_columns_and_no_rows(events):
    assert loads.clone_staging(events).schema == events.schema
    assert loads.clone_staging(events).count() == 0
    assert loads.clone_staging(events, rows=1).count() == 1


def test_rows_of_the_widest_table_are_parsed_by_compiled_code(spark, tmp_path):
    path, schema = write(tmp_path, b""), TABLES["events_regional_daily"]
    typed = _typed(_raw(spark, path, schema), schema)
    query = typed.drop("_bad_reason", "_bad_text")._jdf.queryExecution()
    text = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "codegen")
    # The JVM compiles no method above this size.
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)), default=0) <= 8000


@pytest.mark.parametrize("bad, fails", [(0, False), (10, False), (11, True)])
def test_a_staged_import_parses_its_files_once(spark, tmp_path, bad, fails):
    path = write(tmp_path, b'"7"|"good"\n' + b'"x"|"text"\n' * bad)
    schema, staging = StructType.fromDDL("id int, text string"), str(tmp_path / "staging")
    df = import_delimited(spark, path, schema, MAX_BAD_ROWS, staging)
    with gzip.open(f"{path}/part.csv.gz", "wb") as file:
        file.write(b'"8"|"not read any more"\n')
    if fails:
        with pytest.raises(Exception, match="11 bad rows"):
            df.collect()
    else:
        assert [tuple(r) for r in df.collect()] == [(7, "good")]


def test_a_job_is_run_once_for_all_its_loads(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def job(c):
        schema = TABLES["events_daily"]
        rows = [{"computation_date": ETL, "account_id": "a"}, {"computation_date": ETL.replace(year=2023), "account_id": "b"}]
        return enforce_schema(spark.createDataFrame(rows, schema).mapInArrow(counted, schema), schema)

    class Here(Context):
        def new_path(self):
            return f"{tmp_path}/{uuid.uuid4().hex}"

    table = _loaded("events_daily", job, loads.append_load, times=2)(Here(spark, ""))
    assert sorted(r.account_id for r in table.collect()) == ["a", "a", "b"]
    assert seen.value == 2
