"""Scans, the calendar, delimited files and loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.predicates import etl_window
from daymark.schemas import KEYS, TABLES, enforce_schema
from daymark.sources import loads
from daymark.sources.calendar import run_calendar
from daymark.sources.delimited import export_delimited, import_delimited, import_with_rejects
from daymark.sources.loads import DAY
from daymark.sources.store import TableStore
from daymark.sources.tables import (
    scan_account_details,
    scan_external_events,
    scan_metering,
    scan_product,
    scan_raw_events,
)
from verification.inputs import ETL_DATE, VOCABULARY
from verification.registry import Context, case

V = VOCABULARY
EVENT_COLUMNS = "event_day, account_id, user_id, event_name, user_data, region"

# The SQL block, the cached job of a context, for every loaded table.
JOBS = {
    "account_type_edition_daily": ("dimension", lambda c: c.dimension),
    "events_daily": ("events_table", lambda c: c.events),
    "events_regional_daily": ("regional_table", lambda c: c.regional),
    "revenue_daily": ("revenue_table", lambda c: c.revenue),
    "count_user_rolling_days": ("rolling_table", lambda c: c.rolling),
}


@case("scan_raw_events", f"SELECT {EVENT_COLUMNS} FROM raw_events")
def _(c: Context):
    return scan_raw_events(c.inputs.raw_events)


@case("scan_external_events", f"SELECT {EVENT_COLUMNS} FROM external_events")
def _(c: Context):
    return scan_external_events(c.inputs.raw_events, c.inputs.account_details, V)


@case(
    "date_spine",
    """SELECT c.date AS calendar_date, c.start_iso_week_date, c.end_iso_week_date,
        c.month_days_no AS num_of_day_in_month, count(e.day) AS event_count
    FROM run_days c LEFT JOIN event_days e ON e.day = c.date GROUP BY ALL""",
)
def _(c: Context):
    counts = c.event_days.groupBy(F.col("day").alias("calendar_date")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
    days = run_calendar(c.inputs.calendar, ETL_DATE)
    return days.join(counts, "calendar_date", "left").fillna(0, ["event_count"])


@case(
    "scan_account_details",
    "SELECT account_id, payer_account_id, company_name, internal FROM account_details",
)
def _(c: Context):
    return scan_account_details(c.inputs.account_details)


@case(
    "scan_business_metrics",
    "SELECT * EXCLUDE (real_date) FROM business_metrics WHERE product_code = 'P'",
)
def _(c: Context):
    return scan_product(c.inputs.business_metrics, V)


@case(
    "scan_daily_account_metrics",
    "SELECT * FROM daily_account_metrics WHERE product_code = 'P'",
)
def _(c: Context):
    return scan_product(c.inputs.daily_account_metrics, V)


@case(
    "scan_metering",
    "SELECT day AS computation_date, account_id, usage_resource FROM metered_days",
)
def _(c: Context):
    return scan_metering(c.inputs.metering, V)


def _round_trip(name: str, job):
    def build(c: Context):
        path = c.new_path()
        export_delimited(job(c), path)
        return import_delimited(c.spark, path, TABLES[name], staging=c.new_path())

    return build


def _written(c: Context, rows: DataFrame) -> DataFrame:
    path = c.new_path()
    rows.write.parquet(path)
    return c.spark.read.schema(rows.schema).parquet(path)


def _loaded(name: str, job, load, times: int = 1):
    """The month before into a new table, then the run month, ``times`` times.

    The job runs once: its rows are written down, and every load reads them there.
    """

    def build(c: Context):
        path, schema, keys = c.new_path(), TABLES[name], KEYS[name]
        table = _written(c, job(c))
        this_month = F.trunc(F.lit(ETL_DATE), "month")
        loads.append_load(table.filter(F.col(loads.DAY) < this_month), path, schema, keys)
        for _ in range(times):
            load(table.filter(F.col(loads.DAY) >= this_month), path, schema, keys)
        return loads.read_table(c.spark, path, schema)

    return build


def _through_clone(name: str, job):
    """Clone the table without rows, fill the clone by position, load it, and read."""

    def build(c: Context):
        path, schema, table = c.new_path(), TABLES[name], job(c)
        staging = loads.clone_staging(table).union(table)
        loads.append_load(staging, path, schema, KEYS[name])
        return loads.read_table(c.spark, path, schema)

    return build


for _name, (_block, _job) in JOBS.items():
    case(f"export_import_{_name}", f"SELECT * FROM {_block}")(_round_trip(_name, _job))
    case(f"append_load_{_name}", f"SELECT * FROM {_block}")(
        _loaded(_name, _job, loads.append_load)
    )
    case(f"table_schema_{_name}", f"SELECT * FROM {_block}")(
        lambda c, job=_job, name=_name: enforce_schema(job(c), TABLES[name])
    )
    case(f"clone_staging_{_name}", f"SELECT * FROM {_block}")(_through_clone(_name, _job))

case(
    "append_load_twice",
    """SELECT * FROM events_table
    UNION ALL SELECT * FROM events_table WHERE computation_date >= DATE '2024-01-01'""",
)(_loaded("events_daily", JOBS["events_daily"][1], loads.append_load, times=2))

case("replace_days_load_twice", "SELECT * FROM events_table")(
    _loaded("events_daily", JOBS["events_daily"][1], loads.replace_days_load, times=2)
)


def _delimited_text(c: Context):
    """Prose with quotes, newlines and the delimiter, through a file and back."""
    text = F.concat_ws("|", "source", F.concat(F.lit('"'), "text", F.lit("\\")), "lang")
    return c.spark.read.parquet(f"{c.sf_dir}/documents.parquet").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")
    )


@case(
    "import_delimited",
    """SELECT doc_id, source || '|"' || text || '\\|' || lang AS text FROM documents""",
)
def _(c: Context):
    df, path = _delimited_text(c), c.new_path()
    export_delimited(df, path)
    return import_delimited(c.spark, path, df.schema)


@case(
    "import_delimited_rejects",
    """SELECT CASE WHEN doc_id % 7 <> 0 THEN CAST(doc_id AS BIGINT) END AS doc_id,
        CASE WHEN doc_id % 7 = 0 THEN 'x' || doc_id || '|' || lang ELSE lang END AS row_text,
        doc_id % 7 = 0 AS rejected
    FROM documents""",
)
def _(c: Context):
    """Ids that are no numbers in every seventh row; good and bad rows come back."""
    docs, path = c.spark.read.parquet(f"{c.sf_dir}/documents.parquet"), c.new_path()
    spoiled = F.col("doc_id") % 7 == 0
    number = F.col("doc_id").cast("string")
    name = F.when(spoiled, F.concat(F.lit("x"), number)).otherwise(number)
    export_delimited(docs.select(name.alias("doc_id"), "lang"), path)
    schema = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang").schema
    good, bad = import_with_rejects(c.spark, path, schema, c.new_path(), max_bad_rows=1 << 62)
    kept = good.select("doc_id", F.col("lang").alias("row_text"), F.lit(False).alias("rejected"))
    return kept.union(bad.select(F.lit(None).cast("bigint"), "raw", F.lit(True)))


@case(
    "export_delimited",
    """SELECT CAST(event_day AS VARCHAR) AS event_day, account_id, user_id, event_name,
        user_data, region FROM raw_events""",
)
def _(c: Context):
    """All columns, read back as texts in the stated format."""
    path, events = c.new_path(), scan_raw_events(c.inputs.raw_events)
    export_delimited(events, path)
    texts = ", ".join(f"{name} string" for name in events.columns)
    form = {"sep": "|", "quote": '"', "escape": "\\", "charToEscapeQuoteEscaping": "\\"}
    return c.spark.read.schema(texts).options(**form, multiLine=True, nullValue="").csv(path)


@case("clustered_write", "SELECT * FROM regional_table")
def _(c: Context):
    path, name = c.new_path(), "events_regional_daily"
    loads.clustered_write(c.regional, path, KEYS[name])
    return loads.read_table(c.spark, path, TABLES[name])


@case(
    "clone_staging",
    "SELECT count(*) AS row_count FROM (SELECT * FROM raw_events LIMIT 1)",
)
def _(c: Context):
    """A clone may keep one arbitrary row; only their number is defined."""
    return loads.clone_staging(c.inputs.raw_events, rows=1).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@case("append_load", f"SELECT {EVENT_COLUMNS}, day AS computation_date FROM event_days")
def _(c: Context):
    """A table and its staging rows, loaded one after the other; rows without a day stay."""
    path, day = c.new_path(), F.to_date("event_day")
    events = scan_raw_events(c.inputs.raw_events).withColumn(loads.DAY, day)
    window = F.coalesce(etl_window(loads.DAY, ETL_DATE), F.lit(False))
    for rows in (events.filter(~window), events.filter(window)):
        loads.append_load(rows, path, events.schema, [loads.DAY, "account_id", "user_id"])
    return loads.read_table(c.spark, path, events.schema)


@case("table_schema", "SELECT * FROM dimension")
def _(c: Context):
    return enforce_schema(c.dimension, TABLES["account_type_edition_daily"])


@case("append_load_retried", "SELECT * FROM events_table")
def _(c: Context):
    """A batch that stopped once before and once after it was published."""
    store, middle = TableStore(c.spark, c.new_path()), F.lit(dt.date(2024, 1, 1))
    earlier, batch = (c.events.filter(t) for t in (F.col(DAY) < middle, F.col(DAY) >= middle))
    store.append("events_daily", earlier, "first")
    store.stage("events_daily", batch, "second")
    for _ in range(2):
        store.append("events_daily", batch, "second")
    return store.read("events_daily")


@case(
    "replace_days_emptied",
    "SELECT * FROM events_table WHERE computation_date NOT IN (DATE '2024-01-05', DATE '2024-01-07')",
)
def _(c: Context):
    """A rerun of three days, of which only one still has rows."""
    store, name = TableStore(c.spark, c.new_path()), "events_daily"
    store.append(name, c.events, "first")
    first, last = dt.date(2024, 1, 5), dt.date(2024, 1, 7)
    again = store.stage(name, store.read(name).filter(F.col(DAY) == F.lit(dt.date(2024, 1, 6))))
    store.replace_days([again], first, last)
    return store.read(name)
