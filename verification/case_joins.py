"""Joins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daymark.functions.dates import as_date, day_of, months_before
from daymark.functions.predicates import is_event, is_reader_view
from daymark.operators import joins
from daymark.operators.aggregates import (
    first_logins,
    provisioned_readers,
    reader_view_days,
)
from daymark.operators.rolling import range_counts
from daymark.plans.account_dimension import live_accounts
from daymark.plans.boards import reporting_day
from daymark.plans.events import KEYS
from daymark.plans.revenue import revenue_sums
from daymark.plans.corrections import restate
from daymark.sources.calendar import run_calendar, whole_calendar
from daymark.sources.tables import (
    scan_account_details,
    scan_external_events,
    scan_metering,
    scan_suspended_accounts,
)
from verification.inputs import ETL_DATE, REPORTING_DATE, VOCABULARY
from verification.oracle import READER
from verification.registry import Context, case

V = VOCABULARY
# The calendar reaches past the events on both sides, so some days stay empty.
FIRST, LAST = dt.date(2023, 10, 20), dt.date(2024, 2, 20)


@case(
    "inner_equi_join",
    """SELECT a.account_id, payer_account_id, company_name, internal
    FROM universe u JOIN account_details a ON a.account_id = u.account_id""",
)
def _(c: Context):
    accounts = live_accounts(c.inputs, V).select("account_id")
    return accounts.join(scan_account_details(c.inputs.account_details), "account_id")


@case(
    "inner_join_view",
    """SELECT e.event_day, e.account_id, e.user_id, e.region, a.internal
    FROM raw_events e JOIN account_details a ON a.account_id = e.account_id
    WHERE e.event_name = 'UserLogin'""",
)
def _(c: Context):
    logins = c.inputs.raw_events.filter(is_event(V.login))
    details = c.inputs.account_details.select("account_id", "internal")
    return logins.join(details, "account_id").select(
        "event_day", "account_id", "user_id", "region", "internal"
    )


@case(
    "left_equi_join",
    """SELECT d.computation_date, d.account_id, d.edition, s.gross_revenue, m.provisioned_readers
    FROM dimension d
    LEFT JOIN sums s ON s.day = d.computation_date AND s.account_id = d.account_id
    LEFT JOIN metered m ON m.day = d.computation_date AND m.account_id = d.account_id""",
)
def _(c: Context):
    sums = revenue_sums(c.inputs.business_metrics, KEYS, V).select(*KEYS, "gross_revenue")
    readers = provisioned_readers(scan_metering(c.inputs.metering, V))
    dimension = c.dimension.select(*KEYS, "edition")
    return dimension.join(sums, KEYS, "left").join(readers, KEYS, "left")


@case(
    "cross_join_densify",
    """SELECT c.date AS calendar_date, c.start_iso_week_date, c.end_iso_week_date,
        c.month_days_no AS num_of_day_in_month, a.account_id
    FROM run_days c CROSS JOIN account_details a""",
)
def _(c: Context):
    return joins.densify(
        c.inputs.account_details.select("account_id"),
        run_calendar(c.inputs.calendar, ETL_DATE),
        months_before(ETL_DATE, 1),
        as_date(ETL_DATE),
    )


def _login_days(c: Context):
    return c.inputs.raw_events.filter(is_event(V.login)).select(
        "account_id", "user_id", day_of("event_day").alias("day")
    )


def _range_sql(width: int, how: str, days: str, condition: str, source: str = "event_days") -> str:
    return f"""SELECT c.date AS calendar_date, count(e.day) AS row_count,
        count(DISTINCT e.user_id) AS member_count
    FROM (SELECT date FROM calendar WHERE {days}) c
    {how} JOIN (SELECT * FROM {source} WHERE {condition}) e
      ON e.day BETWEEN c.date - {width - 1} AND c.date
    GROUP BY c.date"""


_AXIS = f"date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
_LOGIN = "event_name = 'UserLogin'"


def _axis(c: Context):
    return whole_calendar(c.inputs.calendar).select("calendar_date")


@case("range_join_l30", _range_sql(30, "LEFT", _AXIS, _LOGIN))
def _(c: Context):
    return range_counts(_axis(c), _login_days(c), "user_id", "day", 30, FIRST, LAST)


@case("range_join_l7", _range_sql(7, "LEFT", _AXIS, _LOGIN))
def _(c: Context):
    return range_counts(_axis(c), _login_days(c), "user_id", "day", 7, FIRST, LAST)


@case(
    "range_join_inner",
    _range_sql(
        30,
        "INNER",
        f"date BETWEEN DATE '{REPORTING_DATE}' - 13 AND DATE '{REPORTING_DATE}'",
        _LOGIN,
    ),
)
def _(c: Context):
    end = reporting_day(c.inputs.reporting_dates)
    return range_counts(
        _axis(c), _login_days(c), "user_id", "day", 30, F.date_sub(end, 13), end, how="inner"
    )


@case("range_join_between", _range_sql(30, "LEFT", _AXIS, READER, "external_events"))
def _(c: Context):
    external = scan_external_events(c.inputs.raw_events, c.inputs.account_details, V)
    views = external.filter(is_reader_view(V)).select(
        "account_id", "user_id", day_of("event_day").alias("day")
    )
    return range_counts(_axis(c), views, "user_id", "day", 30, FIRST, LAST)


def _anti_sql(keys: str) -> str:
    same = " AND ".join(f"v.{k} = f.{k}" for k in [*keys.split(", "), "user_id", "day"])
    return f"""SELECT {keys}, user_id, day AS first_login_date
    FROM (SELECT {keys}, user_id, min(day) AS day FROM event_days WHERE {_LOGIN}
          GROUP BY {keys}, user_id) f
    WHERE NOT EXISTS (SELECT 1 FROM event_days v WHERE {READER} AND {same})"""


def _first_without_view(c: Context, keys: list[str]):
    firsts = first_logins(c.inputs.raw_events, keys, V)
    views = reader_view_days(c.inputs.raw_events, keys, V)
    return joins.semi_join_delete(firsts, views, [*keys, "user_id", "first_login_date"])


@case("anti_join_first_reader", _anti_sql("account_id"))
def _(c: Context):
    return _first_without_view(c, ["account_id"])


@case("anti_join_first_reader_regional", _anti_sql("account_id, region"))
def _(c: Context):
    return _first_without_view(c, ["account_id", "region"])


@case(
    "null_aware_anti_join",
    """SELECT account_id, user_id, event_day FROM raw_events
    WHERE account_id NOT IN (SELECT account_id FROM suspended)""",
)
def _(c: Context):
    events = c.inputs.raw_events.select("account_id", "user_id", "event_day")
    suspended = scan_suspended_accounts(c.inputs.account_details, V)
    return joins.null_aware_anti_join(events, suspended, "account_id")


@case(
    "null_aware_anti_join_with_null",
    """SELECT account_id, user_id FROM raw_events WHERE user_id NOT IN
    (SELECT CASE WHEN account_status_code = 'Active' THEN account_id END FROM account_details)""",
)
def _(c: Context):
    """A NULL in the list: nothing is left."""
    active = F.when(F.col("account_status_code") == "Active", F.col("account_id"))
    listed = c.inputs.account_details.select(active.alias("user_id"))
    events = c.inputs.raw_events.select("account_id", "user_id")
    return joins.null_aware_anti_join(events, listed, "user_id")


@case(
    "semi_join_delete",
    """SELECT account_id, user_id, event_day FROM raw_events
    WHERE (account_id IN (SELECT account_id FROM suspended)) IS NOT TRUE""",
)
def _(c: Context):
    events = c.inputs.raw_events.select("account_id", "user_id", "event_day")
    suspended = scan_suspended_accounts(c.inputs.account_details, V)
    return joins.semi_join_delete(events, suspended, ["account_id"])


@case(
    "full_outer_chain",
    """SELECT computation_date, account_id, region, edition, count_login_event,
        count_new_authors, l30_count_active_reader, l7_count_active_reader
    FROM regional_table""",
)
def _(c: Context):
    return c.regional.select(
        *KEYS,
        "region",
        "edition",
        "count_login_event",
        "count_new_authors",
        "l30_count_active_reader",
        "l7_count_active_reader",
    )


@case(
    "full_outer_rolling",
    """SELECT computation_date, account_id, edition, l30_count_reader, l7_count_reader,
        l30_count_active_reader
    FROM rolling_table""",
)
def _(c: Context):
    return c.rolling.select(
        *KEYS, "edition", "l30_count_reader", "l7_count_reader", "l30_count_active_reader"
    )


@case(
    "full_join_filtered",
    """SELECT r.region_code, e.event_count
    FROM regions r
    FULL JOIN (SELECT region, count(*) AS event_count FROM external_events
               WHERE region <> 'ASIA' GROUP BY region) e ON e.region = r.region_code
    WHERE r.region_code IN ('AFRICA', 'ASIA', 'EUROPE')""",
)
def _(c: Context):
    """The filter on the left side turns the full join into a left join."""
    external = scan_external_events(c.inputs.raw_events, c.inputs.account_details, V)
    counts = (
        external.filter(F.col("region") != "ASIA")
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    regions = c.inputs.regions
    return (
        regions.join(counts, regions["region_code"] == counts["region"], "full")
        .filter(F.col("region_code").isin(*V.board_regions))
        .select("region_code", "event_count")
    )


@case(
    "update_from_join",
    """SELECT d.computation_date, d.account_id, d.company_name,
        CASE WHEN a.account_id IS NULL THEN d.internal ELSE a.account_status_code END AS internal
    FROM dimension d
    LEFT JOIN (SELECT * FROM account_details WHERE fraud_enforcement_status IS NULL) a
      ON a.account_id = d.account_id""",
)
def _(c: Context):
    target = c.dimension.select(*KEYS, "company_name", "internal")
    source = c.inputs.account_details.filter(F.col("fraud_enforcement_status").isNull())
    return restate(target, source, ["account_id"], {"internal": "account_status_code"})
