"""The five daily jobs, their reports, and the checks on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymark.functions.predicates import etl_window, is_event, is_reader_view
from daymark.operators.quality import check_unique_key, reconcile_reports
from daymark.plans import boards, presence_boards, reports
from daymark.plans.account_dimension import account_type_edition_daily
from daymark.plans.events import (
    events_daily,
    events_regional_daily,
    lookback_facts,
    lookback_user_days,
    member_days_of,
    user_days_of,
)
from daymark.plans.history import (
    advanced,
    brought_up_to_date,
    history_before,
    history_with_facts,
    window_start,
)
from daymark.plans.rolling import count_user_rolling_days, lookback_metering
from daymark.plans.rolling_state import (
    carried_activity,
    carried_readers,
    carry_forward,
    keep_state,
    state_of,
)
from daymark.schemas import KEYS, TABLES
from daymark.sources import loads
from daymark.sources.digests import DigestedTable, reconcile_tables
from daymark.sources.tables import scan_external_events
from verification.inputs import (
    ETL_DATE,
    FIRST_DAY,
    PAYER,
    REPORTING_DATE,
    TOP_DAY,
    VOCABULARY,
)
from verification.oracle import amount
from verification.registry import Context, case

V = VOCABULARY
SINCE = f"internal = 'external' AND computation_date >= DATE '{FIRST_DAY}'"
ON_DAY = f"internal = 'external' AND computation_date = DATE '{TOP_DAY}'"
PAYER_KEYS = "payer_account_id, company_name"
NEW_ACCOUNT = "count(DISTINCT account_id) FILTER (WHERE computation_date = join_date)"

case("job_account_type_edition_daily", "SELECT * FROM dimension")(lambda c: c.dimension)
case("job_events_daily", "SELECT * FROM events_table")(lambda c: c.events)
case("job_events_regional_daily", "SELECT * FROM regional_table")(lambda c: c.regional)
case("job_revenue_daily", "SELECT * FROM revenue_table")(lambda c: c.revenue)
case("job_user_rolling_period", "SELECT * FROM rolling_table")(lambda c: c.rolling)


def _kept(c: Context):
    """A history of the older rows, brought up to date with the recent ones."""
    return brought_up_to_date(
        history_before(c.inputs, window_start(ETL_DATE), V), c.inputs, ETL_DATE, V
    )


def _kept_older(c: Context):
    """A history of an early day, advanced twice, and then brought up to date."""
    kept = history_before(c.inputs, dt.date(2023, 9, 20), V)
    for day in (dt.date(2023, 10, 5), dt.date(2023, 11, 17)):
        kept = advanced(kept, c.inputs, day, V)
    return brought_up_to_date(kept, c.inputs, ETL_DATE, V)


@case("job_account_type_edition_daily_kept_older", "SELECT * FROM dimension")
def _(c: Context):
    return account_type_edition_daily(c.inputs, ETL_DATE, V, _kept_older(c))


@case("job_events_daily_kept_older", "SELECT * FROM events_table")
def _(c: Context):
    days = lookback_user_days(c.inputs, ETL_DATE, V)
    return events_daily(c.inputs, c.dimension, ETL_DATE, V, _kept_older(c), days)


@case("job_events_regional_daily_kept_older", "SELECT * FROM regional_table")
def _(c: Context):
    days = lookback_user_days(c.inputs, ETL_DATE, V)
    return events_regional_daily(c.inputs, c.dimension, ETL_DATE, V, _kept_older(c), days)


@case("job_account_type_edition_daily_kept", "SELECT * FROM dimension")
def _(c: Context):
    return account_type_edition_daily(c.inputs, ETL_DATE, V, _kept(c))


@case("job_events_daily_kept", "SELECT * FROM events_table")
def _(c: Context):
    days = lookback_user_days(c.inputs, ETL_DATE, V)
    return events_daily(c.inputs, c.dimension, ETL_DATE, V, _kept(c), days)


@case("job_events_regional_daily_kept", "SELECT * FROM regional_table")
def _(c: Context):
    days = lookback_user_days(c.inputs, ETL_DATE, V)
    return events_regional_daily(c.inputs, c.dimension, ETL_DATE, V, _kept(c), days)


def _facts(c: Context):
    return lookback_facts(c.inputs, ETL_DATE, V)


def _facts_history(c: Context):
    """An older history and the stored facts: each raw event is read once."""
    kept = history_before(c.inputs, dt.date(2023, 10, 9), V)
    return history_with_facts(c.inputs, ETL_DATE, V, _facts(c), kept)


@case("job_account_type_edition_daily_facts", "SELECT * FROM dimension")
def _(c: Context):
    history = history_with_facts(c.inputs, ETL_DATE, V, _facts(c))
    return account_type_edition_daily(c.inputs, ETL_DATE, V, history)


@case("job_events_daily_facts", "SELECT * FROM events_table")
def _(c: Context):
    days = user_days_of(_facts(c), V)
    return events_daily(c.inputs, c.dimension, ETL_DATE, V, _facts_history(c), days)


@case("job_events_regional_daily_facts", "SELECT * FROM regional_table")
def _(c: Context):
    days = user_days_of(_facts(c), V)
    return events_regional_daily(c.inputs, c.dimension, ETL_DATE, V, _facts_history(c), days)


@case("job_user_rolling_period_facts", "SELECT * FROM rolling_table")
def _(c: Context):
    return count_user_rolling_days(c.inputs, c.dimension, ETL_DATE, V, _facts(c))


RECENT = f"computation_date > DATE '{ETL_DATE}' - 30"


def _carried(c: Context, rows, carried):
    """Figures of the last 30 days, from a state of the day before and 30 daily steps."""
    path, before = c.new_path(), ETL_DATE - dt.timedelta(days=30)
    # By day, so that a step reads its own.
    loads.clustered_write(rows, f"{path}/rows", [loads.DAY, *carried.keys])
    rows = loads.read_table(c.spark, f"{path}/rows", rows.schema)
    keep_state(state_of(rows, carried, before), f"{path}/states")
    first = before + dt.timedelta(days=1)
    return carry_forward(c.spark, f"{path}/states", rows, carried, first, ETL_DATE)


@case("job_user_rolling_period_advanced", f"SELECT * FROM rolling_table WHERE {RECENT}")
def _(c: Context):
    days = member_days_of(_facts(c), ["account_id"])
    activity = _carried(c, days, carried_activity("account_id"))
    metered = lookback_metering(c.inputs, ETL_DATE, V).distinct()
    readers = _carried(c, metered, carried_readers())
    table = count_user_rolling_days(
        c.inputs, c.dimension, ETL_DATE, V, activity=activity, readers=readers
    )
    return table.filter(F.expr(RECENT))


@case("job_events_regional_daily_advanced", f"SELECT * FROM regional_table WHERE {RECENT}")
def _(c: Context):
    places = ["account_id", "region"]
    rolling = _carried(c, member_days_of(_facts(c), places), carried_activity(*places))
    table = events_regional_daily(c.inputs, c.dimension, ETL_DATE, V, rolling=rolling)
    return table.filter(F.expr(RECENT))


def total(column: str, name: str | None = None, where: str = "") -> str:
    kept = f" FILTER (WHERE {where})" if where else ""
    return f"CAST(sum({column}){kept} AS BIGINT) AS {name or column}"


def money(column: str, name: str | None = None, where: str = "") -> str:
    kept = f" FILTER (WHERE {where})" if where else ""
    return f"{amount(f'sum({column}){kept}')} AS {name or column}"


@case(
    "rpt_daily_activity",
    f"""SELECT computation_date, {total("1", "active_account", "active_account")},
        {total("count_active_authors", "active_authors")},
        {total("count_active_readers", "active_readers")},
        {total("count_new_authors", "new_authors")}
    FROM events_table WHERE {SINCE} GROUP BY computation_date""",
)
def _(c: Context):
    return reports.daily_activity_report(c.events, FIRST_DAY, V)


def _revenue_report_sql(headline: str) -> str:
    paid = "count_provisioned_paid_authors_with_{}_subscription"
    free, trial = "count_provisioned_free_users", "count_provisioned_trial_users"
    std, ent = "edition = 'standard'", "edition = 'enterprise'"
    columns = [
        money("gross_revenue"),
        money(headline),
        money("annual_sub_revenue"),
        money("monthly_sub_revenue"),
        money("reader_revenue", "reaader_revenue"),
        money("spice_revenue"),
        money(free, "free_users"),
        money(free, "std_free", std),
        money(free, "ent_free", ent),
        money(trial, "trial_users"),
        money(trial, "std_trial", std),
        money(trial, "ent_trial", ent),
        money("count_provisioned_author", "author"),
        money(paid.format("annual"), "annual_sub_author"),
        money(paid.format("monthly"), "monthly_sub_author"),
        total("provisioned_readers", "reader_count"),
        money("count_provisioned_reader_seesions", "reader_sessions"),
        money("spice_gb"),
    ]
    return f"""SELECT computation_date, {", ".join(columns)}
        FROM revenue_table WHERE {SINCE} GROUP BY computation_date"""


@case("rpt_daily_revenue", _revenue_report_sql("revenue"))
def _(c: Context):
    return reports.daily_revenue_report(c.revenue, FIRST_DAY, V)


@case("rpt_daily_revenue_net", _revenue_report_sql("net_revenue"))
def _(c: Context):
    return reports.daily_revenue_report(c.revenue, FIRST_DAY, V, total="net_revenue")


@case(
    "rpt_l30_summary",
    f"""SELECT computation_date, min(l30_period_first_event_date) AS first_event_date,
        max(l30_period_last_event_date) AS last_event_date,
        {total("l30_count_active_accounts", "l30_active_account")},
        {total("l30_count_active_authors", "l30_active_authors")},
        {total("l30_count_active_reader", "l30_active_reader")}
    FROM rolling_table WHERE {SINCE} GROUP BY computation_date""",
)
def _(c: Context):
    return reports.l30_summary_report(c.rolling, FIRST_DAY, V)


@case(
    "rpt_regional_snapshot",
    f"""SELECT computation_date, region, {NEW_ACCOUNT} AS new_account,
        {total("count_new_authors", "new_author")},
        count(DISTINCT account_id) FILTER (WHERE active_account) AS avtive_account,
        {total("count_active_authors", "active_authors")},
        {total("count_active_readers", "active_readers")},
        {total("l30_count_active_accounts", "l30_active_account")},
        {total("l30_count_active_authors", "l30_active_authors")},
        {total("l30_count_active_reader", "l30_active_readers")}
    FROM regional_table
    WHERE internal = 'external' AND computation_date = DATE '{ETL_DATE}' - 1
    GROUP BY computation_date, region""",
)
def _(c: Context):
    return reports.regional_snapshot_report(c.regional, ETL_DATE, V)


@case(
    "rpt_new_accounts",
    f"""SELECT computation_date, {NEW_ACCOUNT} AS new_account,
        {total("count_new_authors", "new_authors")}
    FROM events_table WHERE {SINCE} GROUP BY computation_date""",
)
def _(c: Context):
    return reports.new_accounts_report(c.events, FIRST_DAY, V)


def top_sql(
    source: str,
    where: str,
    keys: str,
    columns: list[str],
    by: str,
    having: str = "TRUE",
    nulls: str = "LAST",
) -> str:
    ties = ", ".join(f"{k} ASC NULLS LAST" for k in keys.split(", "))
    return f"""SELECT {keys}, {", ".join(columns)} FROM {source} WHERE {where}
        GROUP BY {keys} HAVING {having} ORDER BY {by} DESC NULLS {nulls}, {ties} LIMIT 10"""


AUTHORS = "sum(count_provisioned_author)"
AUTHOR_SUM, READER_SUM = (
    money("count_provisioned_author", "author"),
    total("provisioned_readers", "reader_count"),
)
NET, GB = money("net_revenue"), money("spice_gb")

@case(
    "rpt_top_payer_revenue",
    top_sql(
        "revenue_table",
        ON_DAY,
        f"computation_date, {PAYER_KEYS}",
        [money("net_revenue", "revenue"), AUTHOR_SUM, GB],
        "sum(net_revenue)",
    ),
)
def _(c: Context):
    return reports.top_payer_revenue_report(c.revenue, TOP_DAY, V)


@case(
    "rpt_payer_drilldown",
    top_sql(
        "revenue_table",
        f"{SINCE} AND payer_account_id = '{PAYER}'",
        PAYER_KEYS,
        [NET, AUTHOR_SUM, GB],
        AUTHORS,
        having="sum(net_revenue) IS NOT NULL",
        nulls="FIRST",
    ),
)
def _(c: Context):
    return reports.payer_drilldown_report(c.revenue, PAYER, FIRST_DAY, V)


def _top_accounts_sql(where: str) -> str:
    return top_sql(
        "revenue_table",
        where,
        "account_id, company_name, edition",
        [AUTHOR_SUM, READER_SUM, NET, GB],
        AUTHORS,
        having=f"{AUTHORS} IS NOT NULL",
    )


@case("rpt_top_account_authors", _top_accounts_sql(ON_DAY))
def _(c: Context):
    return reports.top_account_authors_report(c.revenue, reports.on_day(TOP_DAY), V)


@case("rpt_top_account_authors_since", _top_accounts_sql(SINCE))
def _(c: Context):
    return reports.top_account_authors_report(c.revenue, reports.since(FIRST_DAY), V)


@case(
    "rpt_top_payer_authors",
    top_sql(
        "revenue_table",
        ON_DAY,
        PAYER_KEYS,
        [money("count_provisioned_author", "user_count"), NET, GB],
        AUTHORS,
        having=f"{AUTHORS} IS NOT NULL",
    ),
)
def _(c: Context):
    return reports.top_payer_authors_report(c.revenue, reports.on_day(TOP_DAY), V)


@case(
    "rpt_top_payer_users",
    top_sql(
        "revenue_table",
        SINCE,
        PAYER_KEYS,
        [f"{amount(f'{AUTHORS} + sum(provisioned_readers)')} AS user_count", NET, GB],
        AUTHORS,
        having=f"{AUTHORS} IS NOT NULL",
    ),
)
def _(c: Context):
    return reports.top_payer_users_report(c.revenue, FIRST_DAY, V)


def _top_analysis_sql(where: str) -> str:
    return top_sql(
        "events_table",
        where,
        "account_id, company_name",
        [total("count_analysis_created", "analysis_created")],
        "sum(count_analysis_created)",
    )


@case("rpt_top_analysis_created", _top_analysis_sql(ON_DAY))
def _(c: Context):
    return reports.top_analysis_report(c.events, reports.on_day(TOP_DAY), V)


@case("rpt_top_analysis_created_since", _top_analysis_sql(SINCE))
def _(c: Context):
    return reports.top_analysis_report(c.events, reports.since(FIRST_DAY), V)


@case(
    "rpt_top_active_readers",
    top_sql(
        "events_table",
        ON_DAY,
        "account_id, company_name",
        [total("count_active_readers", "active_readers")],
        "sum(count_active_readers)",
    ),
)
def _(c: Context):
    return reports.top_readers_report(c.events, TOP_DAY, V)


SERIES_FIRST = dt.date(2024, 1, 10)
READER_CS = """event_name = 'DashboardView' AND user_data LIKE '%"role":"READER"%'"""


_SERIES_SQL = f"""SELECT strftime(c.date, '%Y-%m-%d') AS date,
        s.accounts AS "active accounts (30 days)", s.users AS "active authors (30 days)",
        (SELECT count(DISTINCT user_id) FROM external_events e
         WHERE {READER_CS} AND e.day BETWEEN c.date - 29 AND c.date)
            AS "active readers (30 days)",
        s.day_accounts AS "daily active accounts", s.day_users AS "daily active authors",
        (SELECT count(DISTINCT user_id) FROM external_events e
         WHERE {READER_CS} AND e.day = c.date) AS "daily active readers"
    FROM calendar c
    LEFT JOIN (
        SELECT k.date, count(DISTINCT account_id) AS accounts, count(DISTINCT user_id) AS users,
               count(DISTINCT account_id) FILTER (WHERE day = k.date) AS day_accounts,
               count(DISTINCT user_id) FILTER (WHERE day = k.date) AS day_users
        FROM calendar k JOIN external_events e ON e.day > k.date - 30 AND e.day <= k.date
        WHERE event_name = 'UserLogin'
          AND k.date > DATE '{REPORTING_DATE}' - 14 AND k.date <= DATE '{REPORTING_DATE}'
        GROUP BY k.date HAVING bool_or(day = k.date)) s ON s.date = c.date
    WHERE c.date BETWEEN DATE '{SERIES_FIRST}' AND DATE '{ETL_DATE}'"""


@case("rpt_rolling_activity_series", _SERIES_SQL)
def _(c: Context):
    return boards.rolling_activity_series(c.inputs, V, SERIES_FIRST, ETL_DATE)


_END = f"DATE '{REPORTING_DATE}'"
_READER_END = f"(DATE '{ETL_DATE}' - 2)"
_LOGIN = "e.region = r.region_code AND event_name = 'UserLogin'"


def _login_count(what: str, days: str) -> str:
    return f"""(SELECT count(DISTINCT {what}) FROM external_events e
        WHERE {_LOGIN} AND day BETWEEN {_END} - {days} AND {_END})"""


def _view_count(first: int, last: int) -> str:
    return f"""(SELECT count(DISTINCT user_id) FROM external_events e
        WHERE e.region = r.region_code AND {READER_CS}
          AND day BETWEEN {_READER_END} - {first} AND {_READER_END} - {last})"""


_BOARD_SQL = f"""SELECT r.region_code AS "Region", ifnull(a.n, 0) AS "New Accounts",
        (SELECT count(DISTINCT account_id || user_id)
         FROM (SELECT account_id, user_id, min(day) AS day FROM external_events e
               WHERE {_LOGIN} GROUP BY account_id, user_id) WHERE day = {_END}) AS "New Authors",
        {_login_count("account_id", "0")} AS "Active Accounts",
        {_login_count("user_id", "0")} AS "Active Authors",
        {_view_count(0, 0)} AS "Active Readers",
        {_login_count("account_id", "29")} AS "30-day Active Accounts",
        {_login_count("user_id", "29")} AS "30-day Active Authors",
        {_view_count(29, 1)} AS "30 day Active Readers"
    FROM regions r
    LEFT JOIN (SELECT region, day, count(*) AS n
               FROM (SELECT account_id, region, min(computation_date) AS day FROM account_daily
                     WHERE internal = 'external' GROUP BY account_id, region)
               WHERE day >= {_END} GROUP BY region, day) a ON a.region = r.region_code
    WHERE r.region_code IN ('AFRICA', 'ASIA', 'EUROPE')"""


@case("rpt_regional_board", _BOARD_SQL)
def _(c: Context):
    return boards.regional_board(c.inputs, V, ETL_DATE)


def _stored_days(c: Context):
    """External activity, written once for a board."""
    path = c.new_path()
    boards.external_activity(c.inputs, V).write.parquet(path)
    return c.spark.read.parquet(path)


@case("rpt_rolling_activity_series_stored", _SERIES_SQL)
def _(c: Context):
    return boards.rolling_activity_series(c.inputs, V, SERIES_FIRST, ETL_DATE, _stored_days(c))


@case("rpt_regional_board_stored", _BOARD_SQL)
def _(c: Context):
    return boards.regional_board(c.inputs, V, ETL_DATE, _stored_days(c))


BOARD_DATES = presence_boards.BoardDates(SERIES_FIRST, ETL_DATE, REPORTING_DATE)


def _stored_presence(c: Context):
    """Bits of presence, from one pass over events, written once for a board."""
    path = c.new_path()
    presence_boards.board_presence(c.inputs, V, BOARD_DATES).write.parquet(path)
    return c.spark.read.parquet(path)


@case("rpt_rolling_activity_series_presence", _SERIES_SQL)
def _(c: Context):
    return presence_boards.rolling_activity_series(c.inputs, V, BOARD_DATES, _stored_presence(c))


@case("rpt_regional_board_presence", _BOARD_SQL)
def _(c: Context):
    return presence_boards.regional_board(c.inputs, V, BOARD_DATES, _stored_presence(c))


# Between the two versions: a count has changed, rows have gone, rows have come twice.
_CHANGED, _GONE, _TWICE = dt.date(2023, 12, 20), dt.date(2024, 1, 3), dt.date(2024, 1, 17)


@case(
    "reconcile_tables",
    f"""SELECT * EXCLUDE (sign), CAST(sum(sign) AS BIGINT) AS surplus FROM (
        SELECT *, 1 AS sign FROM regional_table
        UNION ALL
        SELECT * REPLACE (count_analysis_created
                   + CASE WHEN computation_date = DATE '{_CHANGED}' AND account_id LIKE '%3'
                     THEN 1 ELSE 0 END AS count_analysis_created), -1 FROM regional_table
        WHERE computation_date <> DATE '{_GONE}' OR region IS DISTINCT FROM 'ASIA'
        UNION ALL
        SELECT *, -1 FROM regional_table
        WHERE computation_date = DATE '{_TWICE}' AND region = 'AFRICA')
    GROUP BY ALL HAVING sum(sign) <> 0""",
)
def _(c: Context):
    day, region, count = F.col("computation_date"), F.col("region"), F.col("count_analysis_created")
    more = ((day == F.lit(_CHANGED)) & F.col("account_id").like("%3")).cast("bigint")
    kept = (day != F.lit(_GONE)) | ~region.eqNullSafe(F.lit("ASIA"))
    name = "events_regional_daily"

    def version(rows):
        return DigestedTable(c.spark, c.new_path(), TABLES[name], KEYS[name]).write(rows)

    before = version(c.regional)
    rows = before.rows()
    changed = rows.filter(kept).withColumn("count_analysis_created", (count + more).cast("bigint"))
    twice = rows.filter((day == F.lit(_TWICE)) & (region == "AFRICA"))
    return reconcile_tables(before, version(changed.unionByName(twice)))


@case(
    "check_unique_key",
    """SELECT computation_date, account_id, region, count(*) AS row_count FROM regional_table
    GROUP BY computation_date, account_id, region HAVING count(*) > 1""",
)
def _(c: Context):
    return check_unique_key(c.regional, ["computation_date", "account_id", "region"])


@case(
    "check_unique_key_rolling",
    """SELECT computation_date, account_id, count(*) AS row_count FROM rolling_table
    GROUP BY computation_date, account_id HAVING count(*) > 1""",
)
def _(c: Context):
    return check_unique_key(c.rolling, ["computation_date", "account_id"])


@case(
    "reconcile_reports",
    f"""SELECT computation_date, metric, a AS left_value, b AS right_value,
        abs(a - b) AS difference,
        CASE WHEN a IS NOT DISTINCT FROM b THEN 'matched'
             WHEN abs(a - b) <= 0.01 * greatest(abs(a), abs(b)) THEN 'almost matched'
             ELSE 'not matched' END AS verdict
    FROM (
        SELECT computation_date, metric, {amount("l.v")} AS a, {amount("r.v")} AS b
        FROM (SELECT computation_date, 'readers' AS metric, sum(count_active_readers) AS v
              FROM events_table WHERE internal = 'external' GROUP BY computation_date
              UNION ALL
              SELECT computation_date, 'logins', sum(count_login_event)
              FROM events_table WHERE internal = 'external' GROUP BY computation_date) l
        FULL JOIN (
              SELECT day AS computation_date, 'readers' AS metric,
                     count(DISTINCT user_id) FILTER (WHERE {READER_CS}) AS v
              FROM external_events WHERE day >= DATE '2023-12-01' GROUP BY day
              UNION ALL
              SELECT day, 'logins', count(*) FILTER (WHERE event_name = 'UserLogin')
              FROM external_events WHERE day >= DATE '2023-12-01' GROUP BY day) r
        USING (computation_date, metric))""",
)
def _(c: Context):
    """The activity table summed per day, against the raw events counted per day."""
    table = (
        c.events.filter(F.col("internal") == V.external)
        .groupBy("computation_date")
        .agg(
            F.sum("count_active_readers").alias("readers"),
            F.sum("count_login_event").alias("logins"),
        )
    )
    events = scan_external_events(c.inputs.raw_events, c.inputs.account_details, V)
    day = F.to_date("event_day").alias("computation_date")
    per_user = (
        events.filter(etl_window(F.to_date("event_day"), ETL_DATE))
        .groupBy(day, "user_id")
        .agg(
            F.max(is_reader_view(V, ignore_case=False)).alias("reader"),
            F.count_if(is_event(V.login)).alias("logins"),
        )
    )
    raw = per_user.groupBy("computation_date").agg(
        F.count_if("reader").alias("readers"), F.sum("logins").alias("logins")
    )
    return reconcile_reports(table, raw, ["computation_date"], ["readers", "logins"])
