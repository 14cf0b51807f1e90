"""The SQL side: named building blocks, and how a query is put together from them.

The blocks compute the jobs a second way, with set predicates, range joins and
filtered aggregates over undeduplicated rows.
"""

from __future__ import annotations

import re

from verification.inputs import ADAPTER_SQL, ETL_DATE

RUN_END = f"DATE '{ETL_DATE}'"
RUN_START = "DATE '2023-12-01'"
LOOKBACK = "DATE '2023-11-01'"
STAMP = f"TIMESTAMP '{ETL_DATE} 00:00:00'"

READER = """event_name = 'DashboardView' AND user_data ILIKE '%"role":"READER"%'"""
SOURCE = "event_name = 'DataSourceGroupCreated' AND user_data ->> 'dataSourceGroupType'"
SPICE = """event_name = 'PreparedDataSourceCreated' AND user_data ->> 'accelerated' = 'true'
           AND user_data NOT LIKE '%SAMPLE%'"""

COUNTS = {
    "count_login_event": "event_name = 'UserLogin'",
    "dataset_created": f"({SPICE}) OR ({SOURCE} IN ('REDSHIFT', 'EXTERNAL', 'RDS', 'ATHENA'))",
    "count_analysis_created": "event_name LIKE 'AnalysisCreated%'",
    "count_dashboard_created": "event_name = 'DashboardCreated'",
    "count_analysis_deleted": "event_name = 'AnalysisDeleted'",
    "count_dashboard_deleted": "event_name = 'DashboardDeleted'",
    "dashboards_viewed": "event_name = 'DashboardView'",
    "dashboards_updated": "event_name = 'DashboardUpdated'",
    "datasourcegroups_created": "event_name = 'DataSourceGroupCreated'",
    "count_spice": SPICE,
    "count_s3_dataset": f"{SOURCE} = 'S3CONNECTION'",
    "count_redshift_dataset": f"{SOURCE} IN ('REDSHIFT', 'EXTERNAL')",
    "count_rds_dataset": f"{SOURCE} = 'RDS'",
    "count_athena_dataset": f"{SOURCE} = 'ATHENA'",
    "count_xlsx_dataset": f"{SOURCE} = 'XLSX'",
    "count_csv_dataset": f"{SOURCE} = 'CSV'",
    "count_flat": f"{SOURCE} IN ('CSV', 'TSV')",
    "count_log": f"{SOURCE} IN ('ELF', 'CLF')",
}
USERS = {
    "count_active_readers": READER,
    "login_users": "event_name = 'UserLogin'",
    "count_users_unsubscribed": "event_name = 'Unsubscribe'",
    "count_users_activated": "event_name = 'UserActivated'",
    "count_users_invited": "event_name = 'UserInvite'",
}
ATTRIBUTES = (
    "start_iso_week_date, end_iso_week_date, num_of_day_in_month, payer_account_id, "
    "company_name, internal, join_date, last_login_date, account_type, edition"
)
ACTIVITY = (
    "count_active_readers, login_users - count_active_readers AS count_active_authors, "
    "count_users_unsubscribed, count_users_activated, count_users_invited, "
    + ", ".join(COUNTS)
)


def activity_sql(keys: str, where: str = "TRUE") -> str:
    counts = [f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in COUNTS.items()]
    users = [f"count(DISTINCT user_id) FILTER (WHERE {c}) AS {n}" for n, c in USERS.items()]
    return f"""
        SELECT day, {keys}, {", ".join(counts + users)}
        FROM event_days WHERE {where} GROUP BY day, {keys}"""


def authors_sql(keys: str) -> str:
    same = " AND ".join(f"v.{k} = f.{k}" for k in [*keys.split(", "), "user_id", "day"])
    return f"""
        SELECT day, {keys}, count(DISTINCT user_id) AS count_new_authors
        FROM (SELECT {keys}, user_id, min(day) AS day FROM event_days
              WHERE event_name = 'UserLogin' GROUP BY {keys}, user_id) f
        WHERE NOT EXISTS (SELECT 1 FROM event_days v WHERE {READER} AND {same})
        GROUP BY day, {keys}"""


def rolling_sql(keys: str, width: int, prefix: str) -> str:
    return f"""
        SELECT c.date AS day, {keys},
               min(e.day) AS {prefix}_first, max(e.day) AS {prefix}_last,
               count(DISTINCT user_id) FILTER (WHERE {READER}) AS {prefix}_readers,
               count(DISTINCT user_id) FILTER (WHERE event_name = 'UserLogin') AS {prefix}_users,
               count(*) FILTER (WHERE event_name = 'UserLogin') AS {prefix}_logins,
               count(DISTINCT account_id) FILTER (WHERE event_name = 'UserLogin')
                   AS {prefix}_accounts
        FROM run_days c
        JOIN (SELECT DISTINCT {keys}, day, user_id, user_data, event_name FROM event_days
              WHERE day BETWEEN {LOOKBACK} AND {RUN_END}
                AND (event_name = 'UserLogin' OR ({READER}))) e
          ON e.day > c.date - {width} AND e.day <= c.date
        GROUP BY c.date, {keys}"""


def readers_sql(width: int, name: str) -> str:
    return f"""
        SELECT c.date AS day, m.account_id, count(DISTINCT m.usage_resource) AS {name}
        FROM run_days c JOIN metered_days m
          ON m.day > c.date - {width} AND m.day <= c.date AND m.day >= {LOOKBACK}
        GROUP BY c.date, m.account_id"""


def amount(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,10))"


def net_sql(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return (
        f"sum(CASE WHEN metrics_name IN ({listed}) THEN gross_revenue "
        "* (1 - estimated_negative_revenue_share) ELSE 0 END)"
    )


def usage_sql(name: str) -> str:
    return f"sum(CASE metrics_name WHEN '{name}' THEN usage ELSE 0 END * day(last_day({{day}})))"


def dated_usage_sql(name: str) -> str:
    return f"""sum(CASE WHEN metrics_name <> '{name}' THEN 0
        WHEN {{day}} < DATE '2017-02-01' THEN CAST(usage / 24.0 AS DECIMAL(28,8))
        ELSE CAST(usage * day(last_day({{day}})) AS DECIMAL(28,8)) END)"""


PAID = "count_provisioned_paid_authors_with_{}_subscription"
REVENUE = {
    "gross_revenue": "sum(CASE metrics_name WHEN 'QS-Overall' THEN gross_revenue ELSE 0 END)",
    "revenue": net_sql("QS-Overall"),
    "annual_sub_revenue": net_sql("QS-User-Enterprise-Annual", "QS-User-Standard-Annual"),
    "monthly_sub_revenue": net_sql("QS-User-Enterprise-Month", "QS-User-Standard-Month"),
    "spice_revenue": net_sql("SPICE"),
    "reader_revenue": net_sql("QS-ReaderOverall", "QS-ReaderReportSession"),
    PAID.format("annual"): usage_sql("PaidAnnual"),
    PAID.format("monthly"): usage_sql("PaidMonthly"),
    "count_provisioned_free_users": dated_usage_sql("FreeTier"),
    "count_provisioned_trial_users": dated_usage_sql("FreeTrial"),
    "count_provisioned_reader_seesions": (
        "sum(CASE metrics_name WHEN 'QS-ReaderOverall' THEN usage ELSE 0 END)"
    ),
    "spice_gb": usage_sql("SPICE"),
    "count_provisioned_reader_email_sessions": (
        "sum(usage) FILTER (WHERE metrics_name = 'QS-ReaderReportSession')"
    ),
    "net_revenue": (
        "sum(CASE metrics_name WHEN 'QS-Overall' THEN gross_revenue + discounts + crf ELSE 0 END)"
    ),
}
_AUTHOR_PARTS = [
    PAID.format("annual"),
    PAID.format("monthly"),
    "count_provisioned_free_users",
    "count_provisioned_trial_users",
]


def revenue_sql(day: str, keys: str, where: str) -> str:
    sums = [f"{amount(c.format(day=day))} AS {n}" for n, c in REVENUE.items()]
    return f"""
        SELECT {day} AS day, {keys}, {", ".join(sums)}
        FROM business_metrics WHERE product_code = 'P' AND {where} GROUP BY {day}, {keys}"""


def account_type_sql(alias: str = "p") -> str:
    since = f"CAST(date_trunc('month', {alias}.week_end_date) - INTERVAL 2 MONTH AS DATE)"
    return f"""CASE
        WHEN paid > 0 AND free_trial = 0 THEN 'paid'
        WHEN free_tier > 0 AND free_trial > 0 THEN
            CASE WHEN paid > 0 THEN 'paid in trial' ELSE 'trial' END
        WHEN free_tier > 0 AND free_trial = 0 AND join_date >= {since} THEN 'free in trial'
        WHEN free_tier > 0 AND free_trial = 0 AND join_date < {since} THEN 'free'
    END"""


BLOCKS: dict[str, str] = {
    **ADAPTER_SQL,
    "event_days": "SELECT *, CAST(event_day AS DATE) AS day FROM raw_events",
    "metered_days": """
        SELECT CAST(request_day AS DATE) AS day, account_id, usage_resource FROM metering
        WHERE product_code = 'P' AND contains(usage_type, 'Reader')""",
    "run_days": f"SELECT * FROM calendar WHERE date >= {RUN_START} AND date <= {RUN_END}",
    "suspended": """
        SELECT account_id FROM account_details
        WHERE account_status_code = 'Suspended'
           OR ends_with(fraud_enforcement_status, 'Suspended')
           OR ends_with(fraud_enforcement_status, 'Terminated')""",
    "universe": """
        SELECT account_id FROM raw_events
        WHERE account_id NOT IN (SELECT account_id FROM suspended)
        UNION
        SELECT account_id FROM business_metrics WHERE product_code = 'P'""",
    "external_events": """
        SELECT * FROM event_days e
        WHERE EXISTS (SELECT 1 FROM account_details a
                      WHERE a.account_id = e.account_id AND a.internal = 'external')""",
    "joined": """
        SELECT account_id, min(computation_date) AS join_date FROM daily_account_metrics
        WHERE product_code = 'P' GROUP BY account_id""",
    "plans": """
        SELECT computation_date, start_iso_week_date AS week_start_date,
               end_iso_week_date AS week_end_date, account_id,
               count(*) FILTER (WHERE metrics_name = 'FreeTier') AS free_tier,
               count(*) FILTER (WHERE metrics_name = 'FreeTrial') AS free_trial,
               count(*) FILTER (WHERE metrics_name LIKE 'Paid%') AS paid,
               count(*) FILTER (WHERE metrics_name = 'TotalStandard') AS total_std,
               count(*) FILTER (WHERE metrics_name = 'TotalEnterprise') AS total_ent
        FROM daily_account_metrics
        WHERE product_code = 'P' AND metrics_name <> 'Other'
          AND ceil(daily_usage * day(last_day(computation_date))) > 0
        GROUP BY ALL""",
    "dimension": f"""
        SELECT c.date AS computation_date, a.account_id, c.start_iso_week_date,
               c.end_iso_week_date, c.month_days_no AS num_of_day_in_month, j.join_date,
               (SELECT max(event_day) FROM raw_events e
                WHERE e.account_id = a.account_id AND e.event_name = 'UserLogin')
                   AS last_login_date,
               a.payer_account_id, a.company_name, a.internal,
               {account_type_sql()} AS account_type,
               CASE WHEN total_ent > 0 THEN 'enterprise' WHEN total_std > 0 THEN 'standard' END
                   AS edition,
               {STAMP} AS dw_create_date, {STAMP} AS dw_update_date
        FROM account_details a
        CROSS JOIN run_days c
        LEFT JOIN joined j ON j.account_id = a.account_id
        LEFT JOIN plans p ON p.account_id = a.account_id AND p.computation_date = c.date
        WHERE a.account_id IN (SELECT account_id FROM universe)""",
    "activity": activity_sql("account_id", f"day BETWEEN {RUN_START} AND {RUN_END}"),
    "activity_regional": activity_sql(
        "account_id, region", f"day BETWEEN {RUN_START} AND {RUN_END}"
    ),
    "authors": authors_sql("account_id"),
    "authors_regional": authors_sql("account_id, region"),
    "l30": rolling_sql("account_id", 30, "l30"),
    "l7": rolling_sql("account_id", 7, "l7"),
    "l30_regional": rolling_sql("account_id, region", 30, "l30"),
    "l7_regional": rolling_sql("account_id, region", 7, "l7"),
    "l30_metered": readers_sql(30, "l30_count_reader"),
    "l7_metered": readers_sql(7, "l7_count_reader"),
    "sums": revenue_sql(
        "computation_date", "account_id", f"computation_date BETWEEN {RUN_START} AND {RUN_END}"
    ),
    "metered": """
        SELECT day, account_id, count(DISTINCT usage_resource) AS provisioned_readers
        FROM metered_days GROUP BY day, account_id""",
    "events_table": f"""
        SELECT d.computation_date, d.account_id, {ATTRIBUTES},
               ifnull(a.count_login_event > 0, FALSE) AS active_account,
               {ACTIVITY}, n.count_new_authors, dw_create_date, dw_update_date
        FROM dimension d
        LEFT JOIN activity a ON a.day = d.computation_date AND a.account_id = d.account_id
        LEFT JOIN authors n ON n.day = a.day AND n.account_id = a.account_id""",
    "regional_table": f"""
        SELECT coalesce(d.computation_date, a.day, n.day) AS computation_date,
               coalesce(d.account_id, a.account_id, n.account_id) AS account_id,
               coalesce(r.region, a.region, n.region, 'Unknown') AS region, {ATTRIBUTES},
               ifnull(a.count_login_event > 0, FALSE) AS active_account,
               {ACTIVITY}, n.count_new_authors,
               r.l30_readers AS l30_count_active_reader,
               r.l30_users - r.l30_readers AS l30_count_active_authors,
               r.l30_accounts AS l30_count_active_accounts,
               w.l7_readers AS l7_count_active_reader,
               w.l7_users - w.l7_readers AS l7_count_active_authors,
               w.l7_accounts AS l7_count_active_accounts,
               {STAMP} AS dw_create_date, {STAMP} AS dw_update_date
        FROM dimension d
        LEFT JOIN l30_regional r ON r.day = d.computation_date AND r.account_id = d.account_id
        LEFT JOIN l7_regional w
          ON w.day = r.day AND w.account_id = r.account_id AND w.region = r.region
        FULL JOIN activity_regional a
          ON a.day = d.computation_date AND a.account_id = d.account_id AND a.region = r.region
        FULL JOIN authors_regional n
          ON n.day = d.computation_date AND n.account_id = d.account_id AND n.region = a.region
        WHERE coalesce(d.computation_date, a.day, n.day) BETWEEN {RUN_START} AND {RUN_END}""",
    "revenue_table": f"""
        SELECT d.computation_date, d.account_id, {ATTRIBUTES},
               {", ".join(n for n in REVENUE if n != "net_revenue")},
               {amount(" + ".join(_AUTHOR_PARTS))} AS count_provisioned_author,
               CAST(NULL AS DECIMAL(38,10)) AS count_provisioned_reader_interactive_sessions,
               m.provisioned_readers, dw_create_date, dw_update_date, net_revenue
        FROM dimension d
        LEFT JOIN sums s ON s.day = d.computation_date AND s.account_id = d.account_id
        LEFT JOIN metered m ON m.day = d.computation_date AND m.account_id = d.account_id""",
    "rolling_table": f"""
        SELECT coalesce(d.computation_date, m.day) AS computation_date,
               coalesce(d.account_id, m.account_id) AS account_id, {ATTRIBUTES},
               m.l30_count_reader, k.l7_count_reader,
               r.l30_first AS l30_period_first_event_date,
               r.l30_last AS l30_period_last_event_date,
               r.l30_readers AS l30_count_active_reader,
               r.l30_users - r.l30_readers AS l30_count_active_authors,
               r.l30_logins AS l30_total_login_event,
               r.l30_accounts AS l30_count_active_accounts,
               w.l7_first AS l7_period_first_event_date,
               w.l7_last AS l7_period_last_event_date,
               w.l7_readers AS l7_count_active_reader,
               w.l7_users - w.l7_readers AS l7_count_active_authors,
               w.l7_logins AS l7_total_login_event,
               w.l7_accounts AS l7_count_active_accounts,
               {STAMP} AS dw_create_date, {STAMP} AS dw_update_date
        FROM dimension d
        LEFT JOIN l30 r ON r.day = d.computation_date AND r.account_id = d.account_id
        LEFT JOIN l7 w ON w.day = r.day AND w.account_id = r.account_id
        FULL JOIN l30_metered m ON m.day = d.computation_date AND m.account_id = r.account_id
        LEFT JOIN l7_metered k ON k.day = m.day AND k.account_id = m.account_id
        WHERE coalesce(d.account_id, m.account_id) IS NOT NULL""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in BLOCKS:
        if name not in found and re.search(rf"(?:FROM|JOIN)\s+{name}\b", sql):
            _needed(BLOCKS[name], found)
            found[name] = None


def query(body: str) -> str:
    """``body`` with the blocks it reads, directly or through others, put before it."""
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in found) + "\n" + body
