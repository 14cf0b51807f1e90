"""Aggregations, ordering and set operations."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from daymark.functions.dates import as_date, day_of, months_before
from daymark.functions.predicates import is_event, is_reader_view
from daymark.operators import aggregates as agg
from daymark.operators.ordering import newest_first, top_k
from daymark.operators.rolling import rolling_members
from daymark.plans.account_dimension import live_accounts, plan_days
from daymark.plans.boards import reporting_day
from daymark.plans.corrections import account_universe
from daymark.plans.events import (
    KEYS,
    REGION_KEYS,
    lookback_activity,
    run_activity,
    run_rolling_activity,
)
from daymark.plans.history import History, join_dates, seen_accounts
from daymark.plans.revenue import revenue_sums
from daymark.plans.rolling import run_rolling_readers
from daymark.plans.segments import SegmentedHistory
from daymark.sources.tables import scan_external_events, scan_metering, scan_product
from verification.inputs import ETL_DATE, VOCABULARY, business_metrics
from verification.oracle import (
    COUNTS,
    READER,
    _AUTHOR_PARTS,
    amount,
    dated_usage_sql,
    net_sql,
    usage_sql,
)
from verification.registry import Context, case

V = VOCABULARY
GROUP = "day AS computation_date, account_id"


def _activity(c: Context, *columns: str):
    return run_activity(c.inputs, KEYS, ETL_DATE, V).select(*KEYS, *columns)


@case("conditional_sum_flags", f"SELECT {GROUP}, {', '.join(COUNTS)} FROM activity")
def _(c: Context):
    return _activity(c, *COUNTS)


@case(
    "conditional_sum_flags_regional",
    f"SELECT {GROUP}, region, {', '.join(COUNTS)} FROM activity_regional",
)
def _(c: Context):
    return run_activity(c.inputs, REGION_KEYS, ETL_DATE, V).select(*REGION_KEYS, *COUNTS)


@case("conditional_count", f"SELECT {GROUP}, count_login_event FROM activity")
def _(c: Context):
    return _activity(c, "count_login_event")


_USERS = (
    "count_active_readers, count_users_unsubscribed, count_users_activated, count_users_invited"
)


@case("conditional_count_distinct", f"SELECT {GROUP}, {_USERS} FROM activity")
def _(c: Context):
    return _activity(c, *_USERS.split(", "))


@case(
    "distinct_difference",
    f"SELECT {GROUP}, login_users - count_active_readers AS count_active_authors FROM activity",
)
def _(c: Context):
    return _activity(c, "count_active_authors")


@case("sum_of_sums", f"SELECT {GROUP}, dataset_created FROM activity")
def _(c: Context):
    return _activity(c, "dataset_created")


@case(
    "two_level_agg",
    "SELECT day AS first_login_date, account_id, count_new_authors FROM authors",
)
def _(c: Context):
    return agg.new_authors(c.inputs.raw_events, ["account_id"], V)


@case(
    "two_level_agg_regional",
    "SELECT day AS first_login_date, account_id, region, count_new_authors FROM authors_regional",
)
def _(c: Context):
    return agg.new_authors(c.inputs.raw_events, ["account_id", "region"], V)


@case(
    "min_max_agg",
    """SELECT account_id, join_date, last_login_date FROM joined FULL JOIN
    (SELECT account_id, max(event_day) AS last_login_date FROM raw_events
     WHERE event_name = 'UserLogin' GROUP BY account_id) USING (account_id)""",
)
def _(c: Context):
    seen = seen_accounts(c.inputs, V).filter(F.col("last_login_date").isNotNull())
    return join_dates(c.inputs, V).join(seen.drop("billed"), "account_id", "full")


# A history that ends before UNTIL, first built without the rows of one of the days and with
# rows of another that were withdrawn later; then made up for.
UNTIL = dt.date(2024, 1, 1)
LATE_DAY, WITHDRAWN_DAY = dt.date(2023, 12, 7), dt.date(2023, 11, 21)


def _restated(c: Context) -> History:
    rows, day = c.inputs, F.to_date("event_day")
    withdrawn = F.concat("user_id", F.lit("-withdrawn"))
    wrong = rows.raw_events.filter(day != F.lit(LATE_DAY)).union(
        rows.raw_events.filter(day == F.lit(WITHDRAWN_DAY)).withColumn("user_id", withdrawn)
    )
    kept = SegmentedHistory(c.spark, c.new_path(), V)
    kept.build(replace(rows, raw_events=wrong), UNTIL)
    kept.restate(rows, [LATE_DAY, WITHDRAWN_DAY])
    return kept.history()


@case(
    "two_level_agg_restated",
    f"""SELECT day AS first_login_date, account_id, count(*) AS count_new_authors
    FROM (SELECT account_id, user_id, min(CAST(event_day AS DATE)) AS day FROM raw_events
          WHERE event_name = 'UserLogin' AND event_day < DATE '{UNTIL}'
          GROUP BY account_id, user_id) GROUP BY day, account_id""",
)
def _(c: Context):
    firsts = _restated(c).first_logins
    return firsts.groupBy("first_login_date", "account_id").agg(
        F.count("user_id").alias("count_new_authors")
    )


@case(
    "min_max_agg_restated",
    f"""SELECT account_id, join_date, last_login_date FROM
    (SELECT account_id, min(computation_date) AS join_date FROM daily_account_metrics
     WHERE product_code = 'P' AND computation_date < DATE '{UNTIL}' GROUP BY account_id)
    FULL JOIN
    (SELECT account_id, max(event_day) AS last_login_date FROM raw_events
     WHERE event_name = 'UserLogin' AND event_day < DATE '{UNTIL}' GROUP BY account_id)
    USING (account_id)""",
)
def _(c: Context):
    history = _restated(c)
    seen = history.seen_accounts.filter(F.col("last_login_date").isNotNull())
    return history.join_dates.join(seen.drop("billed"), "account_id", "full")


@case("metric_presence_counts", "SELECT * FROM plans")
def _(c: Context):
    return plan_days(c.inputs, V)


PRODUCT = "FROM business_metrics WHERE product_code = 'P' GROUP BY computation_date, account_id"


def _revenue(c: Context, *columns: str):
    return revenue_sums(c.inputs.business_metrics, KEYS, V).select(*KEYS, *columns)


_STREAMS = {
    "revenue": net_sql("QS-Overall"),
    "annual_sub_revenue": net_sql("QS-User-Enterprise-Annual", "QS-User-Standard-Annual"),
    "monthly_sub_revenue": net_sql("QS-User-Enterprise-Month", "QS-User-Standard-Month"),
    "spice_revenue": net_sql("SPICE"),
    "reader_revenue": net_sql("QS-ReaderOverall", "QS-ReaderReportSession"),
}


@case(
    "weighted_conditional_sum",
    f"""SELECT computation_date, account_id,
        {", ".join(f"{amount(s)} AS {n}" for n, s in _STREAMS.items())} {PRODUCT}""",
)
def _(c: Context):
    return _revenue(c, *_STREAMS)


_NET = "CASE metrics_name WHEN 'QS-Overall' THEN gross_revenue + discounts + crf ELSE 0 END"


@case(
    "net_revenue_sum",
    f"SELECT computation_date, account_id, {amount(f'sum({_NET})')} AS net_revenue {PRODUCT}",
)
def _(c: Context):
    return _revenue(c, "net_revenue")


_USAGE = {
    "spice_gb": "SPICE",
    "count_provisioned_paid_authors_with_annual_subscription": "PaidAnnual",
    "count_provisioned_paid_authors_with_monthly_subscription": "PaidMonthly",
}


@case(
    "usage_to_count",
    f"""SELECT computation_date, account_id, {", ".join(
        f"{amount(usage_sql(m).format(day='computation_date'))} AS {n}"
        for n, m in _USAGE.items())} {PRODUCT}""",
)
def _(c: Context):
    return _revenue(c, *_USAGE)


_DATED = {
    "count_provisioned_free_users": "FreeTier",
    "count_provisioned_trial_users": "FreeTrial",
}


@case(
    "usage_to_count_legacy",
    f"""SELECT real_date AS computation_date, account_id, {", ".join(
        f"{amount(dated_usage_sql(m).format(day='real_date'))} AS {n}"
        for n, m in _DATED.items())}
    FROM business_metrics WHERE product_code = 'P' GROUP BY real_date, account_id""",
)
def _(c: Context):
    metrics = business_metrics(c.spark, c.sf_dir, real_days=True)
    return revenue_sums(metrics, KEYS, V).select(*KEYS, *_DATED)


_EMAIL = "sum(usage) FILTER (WHERE metrics_name = 'QS-ReaderReportSession')"
_SESSIONS = "sum(CASE metrics_name WHEN 'QS-ReaderOverall' THEN usage ELSE 0 END)"


@case(
    "nullable_conditional_sum",
    f"""SELECT computation_date, account_id,
        {amount(_EMAIL)} AS count_provisioned_reader_email_sessions,
        {amount(f"{_SESSIONS} - {_EMAIL}")} AS count_provisioned_reader_interactive_sessions
    {PRODUCT}""",
)
def _(c: Context):
    return _revenue(
        c,
        "count_provisioned_reader_email_sessions",
        "count_provisioned_reader_interactive_sessions",
    )


@case(
    "provisioned_readers",
    "SELECT day AS computation_date, account_id, provisioned_readers FROM metered",
)
def _(c: Context):
    return agg.provisioned_readers(scan_metering(c.inputs.metering, V))


@case(
    "provisioned_author_total",
    f"""SELECT d.computation_date, d.account_id,
        {amount(" + ".join(_AUTHOR_PARTS))} AS count_provisioned_author
    FROM dimension d
    LEFT JOIN sums s ON s.day = d.computation_date AND s.account_id = d.account_id""",
)
def _(c: Context):
    sums = _revenue(c, *agg.AUTHOR_PARTS)
    joined = c.dimension.select(*KEYS).join(sums, KEYS, "left")
    return joined.select(*KEYS, agg.provisioned_authors().alias("count_provisioned_author"))


def _users_sql(block: str, p: str, keys: str, dated: bool) -> str:
    dates = (
        f"""{p}_first AS {p}_period_first_event_date, {p}_last AS {p}_period_last_event_date,
        {p}_logins AS {p}_total_login_event,"""
        if dated
        else ""
    )
    return f"""SELECT day AS computation_date, {keys}, {dates}
        {p}_readers AS {p}_count_active_reader,
        {p}_users - {p}_readers AS {p}_count_active_authors,
        {p}_accounts AS {p}_count_active_accounts FROM {block}"""


def _rolling(c: Context, prefix: str, keys: list[str], dated: bool):
    """The columns of one width; a window without rows has no row."""
    rolling = run_rolling_activity(c.inputs, keys, ETL_DATE, V)
    columns = [x for x in rolling.columns if x.startswith(prefix)]
    if not dated:
        columns = [x for x in columns if "_count_" in x]
    present = rolling.filter(F.col(f"{prefix}_count_active_reader").isNotNull())
    return present.select("computation_date", *keys, *columns)


for _p in ("l30", "l7"):
    case(f"rolling_{_p}_users", _users_sql(_p, _p, "account_id", True))(
        lambda c, p=_p: _rolling(c, p, ["account_id"], True)
    )
    case(
        f"rolling_{_p}_regional", _users_sql(f"{_p}_regional", _p, "account_id, region", False)
    )(lambda c, p=_p: _rolling(c, p, ["account_id", "region"], False))
    case(
        f"rolling_{_p}_metered",
        f"SELECT day AS computation_date, account_id, {_p}_count_reader FROM {_p}_metered",
    )(
        lambda c, p=_p: run_rolling_readers(c.inputs, ETL_DATE, V)
        .filter(F.col(f"{p}_count_reader").isNotNull())
        .select("computation_date", "account_id", f"{p}_count_reader")
    )


@case(
    "rolling_global_users",
    f"""SELECT c.date AS calendar_date, count(DISTINCT user_id) AS l30_users
    FROM run_days c JOIN event_days e ON e.day BETWEEN c.date - 29 AND c.date
    WHERE e.event_name = 'UserLogin' GROUP BY c.date""",
)
def _(c: Context):
    """One group for the whole population: the hottest key there can be."""
    logins = c.event_days.filter(is_event(V.login)).select("user_id", "day")
    first, last = months_before(ETL_DATE, 1), as_date(ETL_DATE)
    return rolling_members(logins, [], "user_id", first, last, {"l30_users": 30}, day="day")


@case(
    "select_distinct",
    f"""SELECT DISTINCT account_id, day AS computation_date, user_id, user_data,
        event_name = 'UserLogin' AS is_login
    FROM event_days WHERE event_name = 'UserLogin' OR ({READER})""",
)
def _(c: Context):
    return lookback_activity(c.inputs, ["account_id"], ETL_DATE, V).distinct()


@case(
    "group_by_as_distinct",
    f"""SELECT account_id, user_id, day AS first_login_date FROM event_days WHERE {READER}
    GROUP BY account_id, user_id, day""",
)
def _(c: Context):
    return agg.reader_view_days(c.inputs.raw_events, ["account_id"], V)


@case(
    "composite_distinct",
    """SELECT region, count(DISTINCT account_id || user_id) AS user_count
    FROM raw_events GROUP BY region""",
)
def _(c: Context):
    users = agg.composite_distinct("account_id", "user_id").alias("user_count")
    return c.inputs.raw_events.groupBy("region").agg(users)


@case(
    "having_filter",
    """SELECT account_id, user_id, min(day) AS first_day, count(*) AS login_count
    FROM event_days WHERE event_name = 'UserLogin' GROUP BY account_id, user_id
    HAVING min(day) >= (SELECT dbr_start_date FROM reporting_dates) - 88 AND count(*) > 1""",
)
def _(c: Context):
    end = reporting_day(c.inputs.reporting_dates)
    return (
        c.event_days.filter(is_event(V.login))
        .groupBy("account_id", "user_id")
        .agg(F.min("day").alias("first_day"), F.count(F.lit(1)).alias("login_count"))
        .filter((F.col("first_day") >= F.date_sub(end, 88)) & (F.col("login_count") > 1))
    )


@case(
    "group_by_ordinal",
    """SELECT day, region, event_name, count(*) AS event_count
    FROM event_days GROUP BY 1, 2, event_name""",
)
def _(c: Context):
    keys = [F.to_date("event_day").alias("day"), "region", "event_name"]
    return c.inputs.raw_events.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))


@case(
    "conditional_distinct_small",
    """SELECT event_name, count(DISTINCT user_id) FILTER (WHERE region = 'ASIA') AS asia_users
    FROM raw_events GROUP BY event_name""",
)
def _(c: Context):
    users = agg.count_distinct_if(F.col("region") == "ASIA", "user_id").alias("asia_users")
    return c.inputs.raw_events.groupBy("event_name").agg(users)


# Ordering and top-k.

_BY_DAY = "SELECT day AS computation_date, count(*) AS event_count FROM event_days GROUP BY day"


def _by_day(c: Context):
    return c.event_days.groupBy(F.col("day").alias("computation_date")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


@case("order_by_desc", f"{_BY_DAY} ORDER BY computation_date DESC")
def _(c: Context):
    return newest_first(_by_day(c))


@case("order_by_ordinal", f"{_BY_DAY} ORDER BY 1")
def _(c: Context):
    return _by_day(c).orderBy(1)


_EMAILS = f"""SELECT account_id, {amount(_EMAIL)} AS emails, {amount(_SESSIONS)} AS sessions
    FROM business_metrics WHERE product_code = 'P' GROUP BY account_id, computation_date"""


def _emails(c: Context):
    sums = revenue_sums(c.inputs.business_metrics, KEYS, V)
    return sums.select(
        "account_id",
        F.col("count_provisioned_reader_email_sessions").alias("emails"),
        F.col("count_provisioned_reader_seesions").alias("sessions"),
    )


@case(
    "topk_nulls_last",
    f"{_EMAILS} ORDER BY emails DESC NULLS LAST, account_id, sessions LIMIT 10",
)
def _(c: Context):
    return top_k(_emails(c), "emails", ["account_id", "sessions"])


@case(
    "topk_having",
    f"{_EMAILS} HAVING emails IS NOT NULL ORDER BY emails DESC, account_id, sessions LIMIT 10",
)
def _(c: Context):
    known = _emails(c).filter(F.col("emails").isNotNull())
    return top_k(known, "emails", ["account_id", "sessions"])


@case(
    "topk_default_nulls",
    f"""{_EMAILS} HAVING sessions IS NOT NULL
    ORDER BY emails DESC NULLS FIRST, account_id, sessions LIMIT 10""",
)
def _(c: Context):
    known = _emails(c).filter(F.col("sessions").isNotNull())
    return top_k(known, "emails", ["account_id", "sessions"], nulls_first=True)


# Set operations.


@case(
    "union_distinct",
    """SELECT account_id FROM raw_events
    UNION SELECT account_id FROM business_metrics WHERE product_code = 'P'""",
)
def _(c: Context):
    events = c.inputs.raw_events.select("account_id")
    billed = scan_product(c.inputs.business_metrics, V).select("account_id")
    return events.union(billed).distinct()


@case(
    "union_distinct_3way",
    """SELECT account_id FROM raw_events
    UNION SELECT account_id FROM business_metrics WHERE product_code = 'P'
    UNION SELECT account_id FROM daily_account_metrics WHERE product_code = 'P'""",
)
def _(c: Context):
    return account_universe(c.inputs, V)


@case("account_universe", "SELECT account_id FROM universe")
def _(c: Context):
    return live_accounts(c.inputs, V).select("account_id")


@case(
    "external_reader_days",
    f"""SELECT day, count(DISTINCT user_id) AS daily_readers FROM external_events
    WHERE {READER} GROUP BY day""",
)
def _(c: Context):
    external = scan_external_events(c.inputs.raw_events, c.inputs.account_details, V)
    views = external.filter(is_reader_view(V))
    return views.groupBy(day_of("event_day").alias("day")).agg(
        F.count_distinct("user_id").alias("daily_readers")
    )
