"""The source tables, derived from the test tables by whole-table formulas.

``ADAPTER_SQL`` holds the same formulas for the SQL side. Accounts are runs of
neighbouring users, parts or customers, so their number grows with the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import Inputs, Vocabulary
from daymark.sources.calendar import date_spine

ETL_DATE = dt.date(2024, 1, 30)
FIRST_DAY = dt.date(2023, 12, 15)
TOP_DAY = dt.date(2024, 1, 15)
REPORTING_DATE = dt.date(2024, 1, 29)
PAYER = "19"
VOCABULARY = Vocabulary(product_code="P", board_regions=("AFRICA", "ASIA", "EUROPE"))

# Names of events, source types and metrics that the tables use.
_SIGNUP = ["UserActivated", "UserInvite", "Unsubscribe", "PreparedDataSourceCreated"]
_ERROR = [
    "AnalysisCreated",
    "AnalysisCreatedFromDashboard",
    "DashboardCreated",
    "AnalysisDeleted",
    "DashboardDeleted",
    "DashboardUpdated",
]
_SOURCE_TYPES = [
    "S3CONNECTION", "REDSHIFT", "EXTERNAL", "RDS", "ATHENA", "XLSX", "CSV", "TSV", "ELF", "CLF",
]
_METRICS = [
    "QS-Overall", "QS-User-Enterprise-Annual", "QS-User-Standard-Annual",
    "QS-User-Enterprise-Month", "QS-User-Standard-Month", "SPICE", "QS-ReaderOverall",
    "QS-ReaderReportSession", "PaidAnnual", "PaidMonthly", "FreeTier", "FreeTrial",
    "TotalStandard",
]
# Three metrics (by line number) for each of six kinds of account-weeks.
_PLANS = [
    "FreeTier", "TotalStandard", "FreeTier",
    "FreeTier", "FreeTrial", "TotalEnterprise",
    "FreeTier", "FreeTrial", "PaidEnterprise",
    "PaidStandard", "TotalStandard", "PaidEnterprise",
    "FreeTrial", "TotalEnterprise", "FreeTrial",
    "Other", "TotalEnterprise", "Other",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def dec(column: str | Column, precision: int = 18) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.cast(f"decimal({precision},4)")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", k.alias("k")
    )
    k, kind = F.col("k"), F.col("event_type")
    name = (
        F.when(kind == "click", "UserLogin")
        .when(kind == "view", "DashboardView")
        .when(kind == "purchase", "DataSourceGroupCreated")
        .when(kind == "signup", pick(_SIGNUP, k % 4))
        .when(kind == "error", pick(_ERROR, k % 6))
    )
    text = F.concat(
        F.lit('{"role":"'),
        F.when((F.col("user_id") + k) % 4 == 0, "READER").otherwise("AUTHOR"),
        F.lit('","accelerated":'),
        F.when(k % 3 == 0, "false").otherwise("true"),
        F.lit(',"dataSourceGroupType":"'),
        pick(_SOURCE_TYPES, k % 10),
        F.when(k % 7 == 0, '","name":"SAMPLE"}').otherwise('"}'),
    )
    shift = F.make_dt_interval((30 * (F.col("event_id") % 3)).cast("int"))
    return events.join(
        region, F.col("event_id") % 5 == F.col("r_regionkey"), "left"
    ).select(
        (F.col("ts").cast("timestamp_ntz") - shift).alias("event_day"),
        F.expr("user_id div 3").cast("string").alias("account_id"),
        F.col("user_id").cast("string").alias("user_id"),
        name.alias("event_name"),
        text.alias("user_data"),
        F.col("r_name").alias("region"),
    )


def account_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("account_id"),
        nation.cast("string").alias("payer_account_id"),
        F.col("c_name").alias("company_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "internal")
        .otherwise("external")
        .alias("internal"),
        F.when(F.col("c_acctbal") < 0, "Suspended")
        .otherwise("Active")
        .alias("account_status_code"),
        F.when(nation == 13, "Account Terminated")
        .when(nation == 17, "Account Suspended")
        .alias("fraud_enforcement_status"),
    )


def _line_account() -> Column:
    return F.expr("l_partkey div 50 + 2")


def _product() -> Column:
    return F.when(F.col("l_linestatus") == "O", "P").otherwise("OTHER")


def business_metrics(
    spark: SparkSession, sf_dir: str, real_days: bool = False
) -> DataFrame:
    """``real_days`` keeps the shipping day, for the rule that changed in 2017."""
    shifted = F.date_add(F.lit(dt.date(2023, 12, 1)), (F.col("l_orderkey") % 61).cast("int"))
    day = F.to_date("l_shipdate") if real_days else shifted
    account = _line_account()
    return table(spark, sf_dir, "lineitem").select(
        day.alias("computation_date"),
        account.cast("string").alias("account_id"),
        F.expr("(l_partkey div 50 + 2) div 10").cast("string").alias("payer_account_id"),
        _product().alias("product_code"),
        pick(_METRICS, (F.col("l_partkey") + F.col("l_linenumber")) % 13).alias("metrics_name"),
        dec("l_extendedprice").alias("gross_revenue"),
        dec("l_discount", 6).alias("estimated_negative_revenue_share"),
        dec("l_quantity").alias("usage"),
        dec(dec("l_discount", 6) * -100).alias("discounts"),
        dec("l_tax").alias("crf"),
    )


def daily_account_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = F.col("account") % 2 == 0
    lines = table(spark, sf_dir, "lineitem").withColumn("account", _line_account())
    lines = lines.withColumn(
        "offset",
        F.when(late, F.col("l_orderkey") % 61).otherwise(F.col("l_orderkey") % 183).cast("int"),
    )
    start = F.when(late, F.lit(dt.date(2023, 12, 1))).otherwise(F.lit(dt.date(2023, 8, 1)))
    kind = F.expr("(account + offset div 20) % 6")
    day = F.date_add(start, F.col("offset"))
    week = F.trunc(day, "week")
    return lines.select(
        day.alias("computation_date"),
        week.alias("start_iso_week_date"),
        F.date_add(week, 6).alias("end_iso_week_date"),
        F.col("account").cast("string").alias("account_id"),
        _product().alias("product_code"),
        pick(_PLANS, kind * 3 + F.col("l_linenumber") % 3).alias("metrics_name"),
        dec(dec("l_quantity") - 10).alias("daily_usage"),
    )


def metering(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit(dt.date(2023, 11, 2)), (F.col("l_orderkey") % 90).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        day.cast("timestamp_ntz").alias("request_day"),
        _line_account().cast("string").alias("account_id"),
        F.col("l_partkey").cast("string").alias("usage_resource"),
        F.when(F.col("l_returnflag") == "A", "Reader-Session")
        .when(F.col("l_returnflag") == "R", "ReaderUsage")
        .otherwise("Author-Hours")
        .alias("usage_type"),
        _product().alias("product_code"),
    )


def calendar(spark: SparkSession) -> DataFrame:
    return date_spine(spark, dt.date(2023, 8, 1), dt.date(2024, 2, 29))


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    events, details = raw_events(spark, sf_dir), account_details(spark, sf_dir)
    seen = events.select(
        "account_id", "region", F.to_date("event_day").alias("computation_date")
    ).distinct()
    return Inputs(
        raw_events=events,
        calendar=calendar(spark),
        account_details=details,
        business_metrics=business_metrics(spark, sf_dir),
        daily_account_metrics=daily_account_metrics(spark, sf_dir),
        metering=metering(spark, sf_dir),
        account_daily=seen.join(details.select("account_id", "internal"), "account_id"),
        regions=table(spark, sf_dir, "region").select(F.col("r_name").alias("region_code")),
        reporting_dates=spark.range(1).select(F.lit(REPORTING_DATE).alias("dbr_start_date")),
    )


def _sql_list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


ADAPTER_SQL: dict[str, str] = {
    "raw_events": f"""
        SELECT e.ts - to_days(CAST(30 * (e.event_id % 3) AS INTEGER)) AS event_day,
               CAST(e.user_id // 3 AS VARCHAR) AS account_id,
               CAST(e.user_id AS VARCHAR) AS user_id,
               CASE e.event_type
                   WHEN 'click' THEN 'UserLogin'
                   WHEN 'view' THEN 'DashboardView'
                   WHEN 'purchase' THEN 'DataSourceGroupCreated'
                   WHEN 'signup' THEN {_sql_list(_SIGNUP)}[k % 4 + 1]
                   WHEN 'error' THEN {_sql_list(_ERROR)}[k % 6 + 1]
               END AS event_name,
               '{{"role":"' || CASE WHEN (e.user_id + k) % 4 = 0 THEN 'READER' ELSE 'AUTHOR' END
                   || '","accelerated":' || CASE WHEN k % 3 = 0 THEN 'false' ELSE 'true' END
                   || ',"dataSourceGroupType":"' || {_sql_list(_SOURCE_TYPES)}[k % 10 + 1]
                   || CASE WHEN k % 7 = 0 THEN '","name":"SAMPLE"}}' ELSE '"}}' END AS user_data,
               r.r_name AS region
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
        LEFT JOIN region r ON r.r_regionkey = e.event_id % 5""",
    "account_details": """
        SELECT CAST(c_custkey AS VARCHAR) AS account_id,
               CAST(c_nationkey AS VARCHAR) AS payer_account_id,
               c_name AS company_name,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN 'internal' ELSE 'external' END AS internal,
               CASE WHEN c_acctbal < 0 THEN 'Suspended' ELSE 'Active' END AS account_status_code,
               CASE c_nationkey WHEN 13 THEN 'Account Terminated'
                                WHEN 17 THEN 'Account Suspended' END AS fraud_enforcement_status
        FROM customer""",
    "business_metrics": f"""
        SELECT DATE '2023-12-01' + CAST(l_orderkey % 61 AS INTEGER) AS computation_date,
               CAST(l_shipdate AS DATE) AS real_date,
               CAST(l_partkey // 50 + 2 AS VARCHAR) AS account_id,
               CAST((l_partkey // 50 + 2) // 10 AS VARCHAR) AS payer_account_id,
               CASE WHEN l_linestatus = 'O' THEN 'P' ELSE 'OTHER' END AS product_code,
               {_sql_list(_METRICS)}[(l_partkey + l_linenumber) % 13 + 1] AS metrics_name,
               CAST(l_extendedprice AS DECIMAL(18,4)) AS gross_revenue,
               CAST(l_discount AS DECIMAL(6,4)) AS estimated_negative_revenue_share,
               CAST(l_quantity AS DECIMAL(18,4)) AS usage,
               CAST(CAST(l_discount AS DECIMAL(6,4)) * -100 AS DECIMAL(18,4)) AS discounts,
               CAST(l_tax AS DECIMAL(18,4)) AS crf
        FROM lineitem""",
    "daily_account_metrics": f"""
        SELECT d AS computation_date,
               CAST(date_trunc('week', d) AS DATE) AS start_iso_week_date,
               CAST(date_trunc('week', d) AS DATE) + 6 AS end_iso_week_date,
               CAST(account AS VARCHAR) AS account_id,
               CASE WHEN l_linestatus = 'O' THEN 'P' ELSE 'OTHER' END AS product_code,
               {_sql_list(_PLANS)}[((account + o // 20) % 6) * 3 + l_linenumber % 3 + 1]
                   AS metrics_name,
               CAST(CAST(l_quantity AS DECIMAL(18,4)) - 10 AS DECIMAL(18,4)) AS daily_usage
        FROM (SELECT *, CASE WHEN account % 2 = 0 THEN DATE '2023-12-01'
                             ELSE DATE '2023-08-01' END + CAST(o AS INTEGER) AS d
              FROM (SELECT *, l_partkey // 50 + 2 AS account,
                           CASE WHEN (l_partkey // 50 + 2) % 2 = 0 THEN l_orderkey % 61
                                ELSE l_orderkey % 183 END AS o
                    FROM lineitem))""",
    "metering": """
        SELECT CAST(DATE '2023-11-02' + CAST(l_orderkey % 90 AS INTEGER) AS TIMESTAMP)
                   AS request_day,
               CAST(l_partkey // 50 + 2 AS VARCHAR) AS account_id,
               CAST(l_partkey AS VARCHAR) AS usage_resource,
               CASE l_returnflag WHEN 'A' THEN 'Reader-Session' WHEN 'R' THEN 'ReaderUsage'
                                 ELSE 'Author-Hours' END AS usage_type,
               CASE WHEN l_linestatus = 'O' THEN 'P' ELSE 'OTHER' END AS product_code
        FROM lineitem""",
    "calendar": """
        SELECT CAST(g AS DATE) AS date,
               CAST(date_trunc('week', g) AS DATE) AS start_iso_week_date,
               CAST(date_trunc('week', g) AS DATE) + 6 AS end_iso_week_date,
               CAST(day(last_day(g)) AS SMALLINT) AS month_days_no
        FROM generate_series(DATE '2023-08-01', DATE '2024-02-29', INTERVAL 1 DAY) t(g)""",
    "account_daily": """
        SELECT DISTINCT e.account_id, e.region, CAST(e.event_day AS DATE) AS computation_date,
               a.internal
        FROM raw_events e JOIN account_details a USING (account_id)""",
    "regions": "SELECT r_name AS region_code FROM region",
    "reporting_dates": f"SELECT DATE '{REPORTING_DATE}' AS dbr_start_date",
}
