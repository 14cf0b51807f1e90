"""Filters, predicates, derived columns and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions import dates, predicates
from daymark.operators.aggregates import all_plan_metrics, new_authors
from daymark.plans.account_dimension import plan_days
from daymark.plans.boards import reporting_day
from daymark.plans.events import KEYS, REGION_KEYS, run_activity, run_new_authors, stamped
from daymark.plans.history import join_dates
from daymark.sources.tables import scan_suspended_accounts
from verification.inputs import ETL_DATE, TOP_DAY, VOCABULARY, business_metrics
from verification.oracle import READER, account_type_sql
from verification.registry import Context, case

V = VOCABULARY
EVENT = "event_day, account_id, user_id, event_name"
WINDOW = f"BETWEEN DATE '2023-12-01' AND DATE '{ETL_DATE}'"


def _events(c: Context, condition, *more: str):
    columns = [*EVENT.split(", "), *more]
    return c.inputs.raw_events.filter(condition).select(*columns)


@case("etl_window", f"SELECT {EVENT} FROM event_days WHERE day {WINDOW}")
def _(c: Context):
    return _events(c, predicates.etl_window(predicates.event_day(), ETL_DATE))


@case(
    "etl_window_month",
    f"""SELECT computation_date, account_id, metrics_name FROM daily_account_metrics
    WHERE date_trunc('month', computation_date) >= DATE '2023-12-01'
      AND computation_date <= DATE '{ETL_DATE}'""",
)
def _(c: Context):
    return c.inputs.daily_account_metrics.filter(
        predicates.etl_window_month("computation_date", ETL_DATE)
    ).select("computation_date", "account_id", "metrics_name")


@case(
    "lookback_window",
    f"SELECT {EVENT} FROM event_days WHERE day BETWEEN DATE '2023-11-01' AND DATE '{ETL_DATE}'",
)
def _(c: Context):
    return _events(c, predicates.lookback_window(predicates.event_day(), ETL_DATE))


@case(
    "upper_bound_only",
    f"SELECT * FROM daily_account_metrics WHERE computation_date <= DATE '{TOP_DAY}'",
)
def _(c: Context):
    return c.inputs.daily_account_metrics.filter(F.col("computation_date") <= F.lit(TOP_DAY))


@case(
    "event_name_filter",
    f"""SELECT {EVENT} FROM raw_events
    WHERE event_name = 'UserLogin' OR event_name = 'DashboardView'""",
)
def _(c: Context):
    return _events(c, predicates.is_event(V.login, V.dashboard_view))


@case(
    "metric_in_list",
    """SELECT * FROM daily_account_metrics WHERE metrics_name IN
    ('FreeTier', 'FreeTrial', 'PaidStandard', 'PaidEnterprise', 'TotalStandard',
     'TotalEnterprise')""",
)
def _(c: Context):
    return c.inputs.daily_account_metrics.filter(predicates.any_metric(all_plan_metrics(V)))


@case("reader_predicate", f"SELECT {EVENT}, user_data FROM raw_events WHERE {READER}")
def _(c: Context):
    return _events(c, predicates.is_reader_view(V), "user_data")


@case(
    "reader_predicate_cs",
    f"""SELECT {EVENT}, user_data FROM raw_events
    WHERE event_name = 'DashboardView' AND user_data LIKE '%"role":"READER"%'""",
)
def _(c: Context):
    return _events(c, predicates.is_reader_view(V, ignore_case=False), "user_data")


@case(
    "not_like_sample",
    f"SELECT {EVENT}, user_data FROM raw_events WHERE user_data NOT LIKE '%SAMPLE%'",
)
def _(c: Context):
    return _events(c, ~F.col("user_data").like(V.sample_pattern), "user_data")


@case("suffix_like", "SELECT account_id FROM suspended")
def _(c: Context):
    return scan_suspended_accounts(c.inputs.account_details, V)


@case(
    "infix_like",
    "SELECT * FROM metering WHERE product_code = 'P' AND usage_type LIKE '%Reader%'",
)
def _(c: Context):
    return c.inputs.metering.filter(predicates.is_reader_usage(V))


@case(
    "null_tests",
    """SELECT account_id, fraud_enforcement_status IS NULL AS clear,
        fraud_enforcement_status IS NOT NULL AS marked
    FROM account_details""",
)
def _(c: Context):
    status = F.col("fraud_enforcement_status")
    return c.inputs.account_details.select(
        "account_id", status.isNull().alias("clear"), status.isNotNull().alias("marked")
    )


@case(
    "between_filter",
    f"""SELECT {EVENT} FROM event_days
    WHERE day >= DATE '{TOP_DAY}' - 13 AND day <= DATE '{TOP_DAY}'""",
)
def _(c: Context):
    last = F.lit(TOP_DAY)
    return _events(c, predicates.event_day().between(F.date_sub(last, 13), last))


@case(
    "scalar_subquery_filter",
    f"""SELECT {EVENT} FROM event_days
    WHERE day >= (SELECT dbr_start_date FROM reporting_dates) - 45
      AND day <= (SELECT dbr_start_date FROM reporting_dates)""",
)
def _(c: Context):
    end = reporting_day(c.inputs.reporting_dates)
    return _events(c, predicates.event_day().between(F.date_sub(end, 45), end))


@case(
    "positive_usage_filter",
    """SELECT * FROM daily_account_metrics
    WHERE ceil(daily_usage * day(last_day(computation_date))) > 0""",
)
def _(c: Context):
    return c.inputs.daily_account_metrics.filter(predicates.has_positive_usage("daily_usage"))


@case(
    "account_type_case",
    f"""SELECT computation_date, p.account_id, {account_type_sql()} AS account_type
    FROM plans p LEFT JOIN joined j ON j.account_id = p.account_id""",
)
def _(c: Context):
    joined = plan_days(c.inputs, V).join(join_dates(c.inputs, V), "account_id", "left")
    return joined.select(
        "computation_date", "account_id", predicates.account_type().alias("account_type")
    )


@case(
    "edition_case",
    """SELECT computation_date, account_id,
        CASE WHEN total_ent > 0 THEN 'enterprise' WHEN total_std > 0 THEN 'standard' END AS edition
    FROM plans""",
)
def _(c: Context):
    return plan_days(c.inputs, V).select(
        "computation_date", "account_id", predicates.edition().alias("edition")
    )


@case(
    "active_account_flag",
    """SELECT d.computation_date, d.account_id,
        EXISTS (SELECT 1 FROM event_days e WHERE e.day = d.computation_date
                AND e.account_id = d.account_id AND event_name = 'UserLogin') AS active_account
    FROM dimension d""",
)
def _(c: Context):
    activity = run_activity(c.inputs, KEYS, ETL_DATE, V).select(*KEYS, "count_login_event")
    flag = predicates.active_flag("count_login_event")
    return (
        c.dimension.select(*KEYS).join(activity, KEYS, "left")
        .select(*KEYS, flag.alias("active_account"))
    )


@case(
    "coalesce_keys",
    f"""SELECT coalesce(a.day, n.day) AS computation_date,
        coalesce(a.account_id, n.account_id) AS account_id,
        coalesce(a.region, n.region, 'Unknown') AS region,
        a.count_login_event, n.count_new_authors
    FROM (SELECT * FROM activity_regional WHERE count_spice > 0) a
    FULL JOIN (SELECT * FROM authors_regional WHERE day {WINDOW}) n
      ON a.day = n.day AND a.account_id = n.account_id AND a.region = n.region""",
)
def _(c: Context):
    activity = run_activity(c.inputs, REGION_KEYS, ETL_DATE, V).filter("count_spice > 0")
    authors = run_new_authors(c.inputs, REGION_KEYS[1:], ETL_DATE, V)
    a, n = activity.alias("a"), authors.alias("n")
    same = [F.col(f"a.{k}") == F.col(f"n.{k}") for k in REGION_KEYS]
    keys = {k: [F.col(f"a.{k}"), F.col(f"n.{k}")] for k in REGION_KEYS}
    keys["region"].append(F.lit(V.unknown_region))
    return a.join(n, same, "full").select(
        *[F.coalesce(*columns).alias(k) for k, columns in keys.items()],
        "count_login_event",
        "count_new_authors",
    )


@case(
    "coalesce_zero",
    """SELECT a.account_id, coalesce(n.authors, 0) AS new_authors
    FROM account_details a
    LEFT JOIN (SELECT account_id, CAST(sum(count_new_authors) AS BIGINT) AS authors
               FROM authors GROUP BY account_id) n ON n.account_id = a.account_id""",
)
def _(c: Context):
    authors = new_authors(c.inputs.raw_events, ["account_id"], V)
    sums = authors.groupBy("account_id").agg(F.sum("count_new_authors").alias("n"))
    return c.inputs.account_details.join(sums, "account_id", "left").select(
        "account_id", F.coalesce("n", F.lit(0)).alias("new_authors")
    )


@case(
    "audit_columns",
    f"""SELECT account_id, TIMESTAMP '{ETL_DATE} 00:00:00' AS dw_create_date,
        TIMESTAMP '{ETL_DATE} 00:00:00' AS dw_update_date FROM account_details""",
)
def _(c: Context):
    return stamped(c.inputs.account_details.select("account_id"), ETL_DATE)


@case(
    "null_literal_column",
    """SELECT account_id, CAST(NULL AS DECIMAL(38,10)) AS interactive_sessions
    FROM account_details""",
)
def _(c: Context):
    empty = F.lit(None).cast("decimal(38,30)")
    return c.inputs.account_details.select("account_id", empty.alias("interactive_sessions"))


# Scalar functions, each over a whole table.


def _function(key: str, table: str, columns: str, sql: str, expression) -> None:
    """``SELECT columns, sql AS result FROM table``, and the same from an expression."""

    @case(key, f"SELECT {columns}, {sql} AS result FROM {table}")
    def _(c: Context):
        return getattr(c.inputs, table).select(
            *columns.split(", "), expression().alias("result")
        )


DAY = "computation_date"
_function("fn_to_date", "raw_events", EVENT, "CAST(event_day AS DATE)", predicates.event_day)
_function(
    "fn_date_trunc",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"CAST(date_trunc('month', {DAY}) AS DATE)",
    lambda: dates.month_start(DAY),
)
_function(
    "fn_date_trunc_day",
    "raw_events",
    EVENT,
    "CAST(date_trunc('day', event_day) AS TIMESTAMP)",
    lambda: F.date_trunc("day", "event_day").cast("timestamp_ntz"),
)
_function(
    "fn_date_add_month",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"CAST(date_trunc('month', {DAY}) - INTERVAL 2 MONTH AS DATE)",
    lambda: F.add_months(dates.month_start(DAY), -2),
)
_function(
    "fn_date_add_day",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"CAST({DAY} + INTERVAL (-29) DAY AS DATE)",
    lambda: F.date_add(DAY, -29),
)
_function(
    "fn_date_minus_int",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"{DAY} - 29",
    lambda: F.date_sub(DAY, 29),
)
_function(
    "fn_days_in_month",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"CAST(day(last_day({DAY})) AS INTEGER)",
    lambda: dates.days_in_month(DAY),
)
_function(
    "fn_now",
    "raw_events",
    EVENT,
    f"date_diff('day', CAST(event_day AS DATE), DATE '{ETL_DATE}')",
    lambda: F.datediff(dates.as_date(ETL_DATE), "event_day"),
)
_function(
    "fn_to_char",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"strftime({DAY}, '%Y-%m-%d')",
    lambda: dates.iso_date_text(DAY),
)
_function(
    "fn_json_text",
    "raw_events",
    f"{EVENT}, user_data",
    "json_extract_string(user_data, '$.accelerated') || ':' || "
    "json_extract_string(user_data, '$.dataSourceGroupType') || ':' || "
    "ifnull(json_extract_string(user_data, '$.name'), 'none')",
    lambda: F.concat_ws(
        ":",
        predicates.json_text("user_data", V.accelerated_key),
        predicates.json_text("user_data", V.source_type_key),
        F.coalesce(predicates.json_text("user_data", "name"), F.lit("none")),
    ),
)
_function(
    "fn_ceil",
    "daily_account_metrics",
    f"{DAY}, account_id, daily_usage",
    f"CAST(ceil(daily_usage * day(last_day({DAY})) / 7) AS BIGINT)",
    lambda: F.ceil(F.col("daily_usage") * dates.days_in_month(DAY) / 7).cast("bigint"),
)
_function(
    "fn_coalesce",
    "account_details",
    "account_id",
    "coalesce(fraud_enforcement_status, account_status_code, 'none')",
    lambda: F.coalesce("fraud_enforcement_status", "account_status_code", F.lit("none")),
)
_function(
    "fn_case",
    "raw_events",
    EVENT,
    """CASE event_name WHEN 'UserLogin' THEN 'author' WHEN 'DashboardView' THEN 'viewer' END""",
    lambda: F.when(predicates.is_event(V.login), "author").when(
        predicates.is_event(V.dashboard_view), "viewer"
    ),
)
_function(
    "fn_like_family",
    "raw_events",
    f"{EVENT}, user_data",
    """CAST(user_data LIKE '%READER%' AS INTEGER) + 2 * CAST(user_data ILIKE '%reader%' AS INTEGER)
       + 4 * CAST(user_data NOT LIKE '%SAMPLE%' AS INTEGER)""",
    lambda: F.col("user_data").like("%READER%").cast("int")
    + F.col("user_data").ilike("%reader%").cast("int") * 2
    + (~F.col("user_data").like(V.sample_pattern)).cast("int") * 4,
)
_function(
    "fn_concat",
    "account_details",
    "account_id",
    "account_id || fraud_enforcement_status",
    lambda: F.concat("account_id", "fraud_enforcement_status"),
)
_function(
    "fn_cast",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"CAST(CAST(account_id AS INTEGER) + 1 AS VARCHAR) || CAST({DAY} AS VARCHAR)",
    lambda: F.concat(
        (F.col("account_id").cast("int") + 1).cast("string"), F.col(DAY).cast("string")
    ),
)
_function(
    "fn_cast_timestamp",
    "daily_account_metrics",
    f"{DAY}, account_id",
    f"CAST({DAY} AS TIMESTAMP)",
    lambda: F.col(DAY).cast("timestamp_ntz"),
)


@case(
    "fn_arith",
    """SELECT computation_date, account_id,
        CAST(gross_revenue * (1 - estimated_negative_revenue_share) + discounts - crf
            AS DECIMAL(38,10)) AS net,
        CAST(CAST(usage / 24.0 AS DECIMAL(28,8)) AS DECIMAL(38,10)) AS hours
    FROM business_metrics""",
)
def _(c: Context):
    share = 1 - F.col("estimated_negative_revenue_share")
    net = F.col("gross_revenue") * share + F.col("discounts") - F.col("crf")
    hours = F.col("usage") / F.lit(24.0).cast("decimal(3,1)")
    return business_metrics(c.spark, c.sf_dir).select(
        "computation_date", "account_id", net.alias("net"), hours.alias("hours")
    )
