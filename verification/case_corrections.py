"""History corrections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymark.plans import corrections as fix
from daymark.sources.store import TableStore
from verification.inputs import VOCABULARY
from verification.oracle import account_type_sql, amount, net_sql
from verification.registry import Context, case

V = VOCABULARY
AS_OF = dt.date(2024, 2, 5)
NOW = f"TIMESTAMP '{AS_OF} 00:00:00'"


@case(
    "purge_suspended",
    "SELECT * FROM dimension d WHERE NOT EXISTS "
    "(SELECT 1 FROM suspended s WHERE s.account_id = d.account_id)",
)
def _(c: Context):
    return fix.purge_suspended(c.dimension, c.inputs.account_details, V)


@case(
    "purge_suspended_simple",
    """SELECT * FROM dimension d WHERE NOT EXISTS (SELECT 1 FROM account_details a
        WHERE a.account_id = d.account_id AND a.account_status_code = 'Suspended')""",
)
def _(c: Context):
    return fix.purge_suspended(c.dimension, c.inputs.account_details, V, with_fraud=False)


_GROSS = "sum(CASE metrics_name WHEN 'QS-Overall' THEN gross_revenue ELSE 0 END)"
_NET = "CASE metrics_name WHEN 'QS-Overall' THEN gross_revenue + discounts + crf ELSE 0 END"


@case(
    "backfill_revenue",
    f"""SELECT r.* REPLACE (
        CASE WHEN s.day IS NULL THEN r.net_revenue ELSE s.net END AS net_revenue,
        CASE WHEN s.day IS NULL THEN r.gross_revenue ELSE s.gross END AS gross_revenue,
        CASE WHEN s.day IS NULL THEN r.revenue ELSE s.rev END AS revenue,
        CASE WHEN s.day IS NULL THEN r.count_provisioned_reader_interactive_sessions END
            AS count_provisioned_reader_interactive_sessions)
    FROM (SELECT * REPLACE (gross_revenue + 1 AS gross_revenue, NULL AS net_revenue)
          FROM revenue_table) r
    LEFT JOIN (SELECT computation_date AS day, account_id, {amount(f"sum({_NET})")} AS net,
               {amount(_GROSS)} AS gross, {amount(net_sql("QS-Overall"))} AS rev
               FROM business_metrics WHERE product_code = 'P'
               GROUP BY computation_date, account_id, payer_account_id) s
      ON s.day = r.computation_date AND s.account_id = r.account_id""",
)
def _(c: Context):
    wrong = c.revenue.withColumns(
        {
            "gross_revenue": (F.col("gross_revenue") + 1).cast("decimal(38,22)"),
            "net_revenue": F.lit(None).cast("decimal(38,30)"),
        }
    )
    return fix.backfill_revenue(wrong, c.inputs.business_metrics, V)


@case(
    "backfill_analysis_count",
    """SELECT t.* REPLACE (coalesce(a.count_analysis_created, t.count_analysis_created)
        AS count_analysis_created)
    FROM (SELECT * REPLACE (count_analysis_created + 5 AS count_analysis_created)
          FROM events_table) t
    LEFT JOIN activity a ON a.day = t.computation_date AND a.account_id = t.account_id""",
)
def _(c: Context):
    wrong = c.events.withColumn("count_analysis_created", c.events.count_analysis_created + 5)
    return fix.backfill_analysis_count(wrong, c.inputs.raw_events, V)


@case(
    "backfill_analysis_count_regional",
    f"""SELECT t.* REPLACE (
        coalesce(a.count_analysis_created, t.count_analysis_created) AS count_analysis_created,
        CASE WHEN a.day IS NULL THEN t.dw_update_date ELSE {NOW} END AS dw_update_date)
    FROM (SELECT * REPLACE (count_analysis_created + 5 AS count_analysis_created)
          FROM regional_table) t
    LEFT JOIN activity_regional a
      ON a.day = t.computation_date AND a.account_id = t.account_id AND a.region = t.region""",
)
def _(c: Context):
    wrong = c.regional.withColumn(
        "count_analysis_created", c.regional.count_analysis_created + 5
    )
    return fix.backfill_analysis_count_regional(wrong, c.inputs.raw_events, V, AS_OF)


@case(
    "backfill_account_type",
    f"""SELECT d.* REPLACE (
        CASE WHEN u.account_id IS NULL THEN d.account_type ELSE u.kind END AS account_type,
        CASE WHEN u.account_id IS NULL THEN d.dw_update_date ELSE {NOW} END AS dw_update_date)
    FROM (SELECT * REPLACE ('unset' AS account_type) FROM dimension) d
    LEFT JOIN (
        SELECT c.date, a.account_id, {account_type_sql()} AS kind
        FROM calendar c CROSS JOIN account_details a
        LEFT JOIN joined j ON j.account_id = a.account_id
        LEFT JOIN plans p ON p.account_id = a.account_id AND p.computation_date = c.date
        WHERE a.account_id IN (
            SELECT account_id FROM raw_events
            UNION SELECT account_id FROM business_metrics WHERE product_code = 'P'
            UNION SELECT account_id FROM daily_account_metrics WHERE product_code = 'P')) u
      ON u.date = d.computation_date AND u.account_id = d.account_id""",
)
def _(c: Context):
    wrong = c.dimension.withColumn("account_type", F.lit("unset"))
    return fix.backfill_account_type(wrong, c.inputs, V, AS_OF)


@case(
    "backfill_new_authors",
    f"""SELECT t.* REPLACE (
        coalesce(n.count_new_authors, t.count_new_authors) AS count_new_authors,
        CASE WHEN n.day IS NULL THEN t.dw_update_date ELSE {NOW} END AS dw_update_date)
    FROM (SELECT * REPLACE (CAST(7 AS BIGINT) AS count_new_authors) FROM events_table) t
    LEFT JOIN authors n ON n.day = t.computation_date AND n.account_id = t.account_id""",
)
def _(c: Context):
    wrong = c.events.withColumn("count_new_authors", F.lit(7).cast("bigint"))
    return fix.backfill_new_authors(wrong, c.inputs.raw_events, V, AS_OF)


_LESS = ", ".join(
    f"t.{p}_count_active_authors - CASE WHEN {{matched}} THEN t.{p}_count_active_reader ELSE 0 END"
    f" AS {p}_count_active_authors"
    for p in ("l30", "l7")
)


_REGIONAL_FIX = f"""SELECT t.* REPLACE (
        coalesce(n.count_new_authors, t.count_new_authors) AS count_new_authors,
        {_LESS.format(matched="n.day IS NOT NULL")},
        CASE WHEN n.day IS NULL THEN t.dw_update_date ELSE {NOW} END AS dw_update_date)
    FROM regional_table t
    LEFT JOIN authors_regional n
      ON n.day = t.computation_date AND n.account_id = t.account_id AND n.region = t.region"""


@case("backfill_new_authors_regional", _REGIONAL_FIX)
def _(c: Context):
    return fix.backfill_new_authors_regional(c.regional, c.inputs.raw_events, V, AS_OF)


_ROLLING_FIX = f"""SELECT t.* REPLACE ({_LESS.format(matched="TRUE")}, {NOW} AS dw_update_date)
    FROM rolling_table t"""


@case("adjust_rolling_authors", _ROLLING_FIX)
def _(c: Context):
    return fix.adjust_rolling_authors(c.rolling, AS_OF)


def _applied_twice(c: Context, table: str, rows, name: str, correction):
    """A correction under its name, called again after it was published."""
    store = TableStore(c.spark, c.new_path())
    store.append(table, rows, "history")
    for _ in range(2):
        store.correct(table, name, correction)
    return store.read(table)


@case("backfill_new_authors_regional_twice", _REGIONAL_FIX)
def _(c: Context):
    def correction(table):
        return fix.backfill_new_authors_regional(table, c.inputs.raw_events, V, AS_OF)

    return _applied_twice(c, "events_regional_daily", c.regional, "new-authors", correction)


@case("adjust_rolling_authors_twice", _ROLLING_FIX)
def _(c: Context):
    def correction(table):
        return fix.adjust_rolling_authors(table, AS_OF)

    return _applied_twice(c, "count_user_rolling_days", c.rolling, "less-readers", correction)
