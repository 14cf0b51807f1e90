"""Reports on the five daily tables. The names of their columns are fixed values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.config import Vocabulary
from daymark.functions.dates import as_date
from daymark.operators.ordering import newest_first, top_k

_DAY = "computation_date"


def since(day: dt.date) -> Column:
    return F.col(_DAY) >= as_date(day)


def on_day(day: dt.date) -> Column:
    return F.col(_DAY) == as_date(day)


def external_rows(table: DataFrame, days: Column, vocabulary: Vocabulary) -> DataFrame:
    """Rows of external customers, with decimals that have room for a grand total.

    Stored amounts have 30 decimals and 8 integer digits; a sum over all accounts
    outgrows that. Twenty decimals leave the sum eighteen integer digits.
    """
    roomy = {
        f.name: F.col(f.name).cast("decimal(36,20)")
        for f in table.schema
        if isinstance(f.dataType, T.DecimalType)
    }
    rows = table.filter(days & (F.col("internal") == vocabulary.external))
    return rows.withColumns(roomy) if roomy else rows


def sums(**columns: str | Column) -> list[Column]:
    """``output=column``: the sum of each column, or of each expression."""
    return [F.sum(source).alias(name) for name, source in columns.items()]


def _new_accounts() -> Column:
    joined = F.when(F.col(_DAY) == F.col("join_date"), F.col("account_id"))
    return F.count_distinct(joined).alias("new_account")


def daily_activity_report(events: DataFrame, first: dt.date, vocabulary: Vocabulary) -> DataFrame:
    """Active accounts, authors, readers and new authors per day."""
    report = external_rows(events, since(first), vocabulary).groupBy(_DAY).agg(
        *sums(
            active_account=F.when(F.col("active_account"), 1),
            active_authors="count_active_authors",
            active_readers="count_active_readers",
            new_authors="count_new_authors",
        )
    )
    return newest_first(report)


def daily_revenue_report(
    revenue: DataFrame, first: dt.date, vocabulary: Vocabulary, total: str = "revenue"
) -> DataFrame:
    """Revenue and usage per day; ``total`` is ``revenue`` or ``net_revenue``."""

    def within(edition: str, column: str) -> Column:
        return F.when(F.col("edition") == edition, F.col(column))

    free, trial = "count_provisioned_free_users", "count_provisioned_trial_users"
    paid = "count_provisioned_paid_authors_with_{}_subscription"
    report = external_rows(revenue, since(first), vocabulary).groupBy(_DAY).agg(
        *sums(gross_revenue="gross_revenue", **{total: total}),
        *sums(
            annual_sub_revenue="annual_sub_revenue",
            monthly_sub_revenue="monthly_sub_revenue",
            reaader_revenue="reader_revenue",
            spice_revenue="spice_revenue",
            free_users=free,
            std_free=within("standard", free),
            ent_free=within("enterprise", free),
            trial_users=trial,
            std_trial=within("standard", trial),
            ent_trial=within("enterprise", trial),
            author="count_provisioned_author",
            annual_sub_author=paid.format("annual"),
            monthly_sub_author=paid.format("monthly"),
            reader_count="provisioned_readers",
            reader_sessions="count_provisioned_reader_seesions",
            spice_gb="spice_gb",
        ),
    )
    return newest_first(report)


def l30_summary_report(rolling: DataFrame, first: dt.date, vocabulary: Vocabulary) -> DataFrame:
    """30-day totals per day, with the first and last event day they cover."""
    report = external_rows(rolling, since(first), vocabulary).groupBy(_DAY).agg(
        F.min("l30_period_first_event_date").alias("first_event_date"),
        F.max("l30_period_last_event_date").alias("last_event_date"),
        *sums(
            l30_active_account="l30_count_active_accounts",
            l30_active_authors="l30_count_active_authors",
            l30_active_reader="l30_count_active_reader",
        ),
    )
    return newest_first(report)


def regional_snapshot_report(
    regional: DataFrame, as_of: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    """The day before ``as_of`` by region."""
    day = F.date_sub(as_date(as_of), 1)
    totals = {
        "new_author": "count_new_authors",
        "active_authors": "count_active_authors",
        "active_readers": "count_active_readers",
        "l30_active_account": "l30_count_active_accounts",
        "l30_active_authors": "l30_count_active_authors",
        "l30_active_readers": "l30_count_active_reader",
    }
    # One row per account first, so that no distinct count is left.
    rows = external_rows(regional, F.col(_DAY) == day, vocabulary)
    accounts = rows.groupBy(_DAY, "region", "account_id").agg(
        F.max(F.col(_DAY) == F.col("join_date")).alias("joined"),
        F.max("active_account").alias("active"),
        *sums(**totals),
    )
    named = F.col("account_id").isNotNull()
    return accounts.groupBy(_DAY, "region").agg(
        F.count_if(named & F.col("joined")).alias("new_account"),
        F.count_if(named & F.col("active")).alias("avtive_account"),
        *sums(**{name: name for name in totals}),
    )


def new_accounts_report(events: DataFrame, first: dt.date, vocabulary: Vocabulary) -> DataFrame:
    report = external_rows(events, since(first), vocabulary).groupBy(_DAY).agg(
        _new_accounts(), *sums(new_authors="count_new_authors")
    )
    return newest_first(report)


def top_report(
    table: DataFrame,
    days: Column,
    vocabulary: Vocabulary,
    keys: Sequence[str],
    outputs: dict[str, str | Column],
    by: str,
    known: str | None = None,
    nulls_first: bool = False,
) -> DataFrame:
    """Sums per key, the ten largest by one of them.

    ``known`` names a sum that may not be NULL; ties are ordered by the keys.
    """
    totals = external_rows(table, days, vocabulary).groupBy(*keys).agg(*sums(**outputs))
    if known is not None:
        totals = totals.filter(F.col(known).isNotNull())
    return top_k(totals, by, keys, nulls_first=nulls_first)


def top_payer_revenue_report(
    revenue: DataFrame, day: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    outputs = {
        "revenue": "net_revenue",
        "author": "count_provisioned_author",
        "spice_gb": "spice_gb",
    }
    keys = [_DAY, "payer_account_id", "company_name"]
    return top_report(revenue, on_day(day), vocabulary, keys, outputs, by="revenue")


_PAYER = ["payer_account_id", "company_name"]


def payer_drilldown_report(
    revenue: DataFrame, payer: str, first: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    """One payer's totals; a company without author counts comes first."""
    outputs = {
        "net_revenue": "net_revenue",
        "author": "count_provisioned_author",
        "spice_gb": "spice_gb",
    }
    days = since(first) & (F.col("payer_account_id") == payer)
    return top_report(
        revenue, days, vocabulary, _PAYER, outputs, "author", known="net_revenue", nulls_first=True
    )


def top_account_authors_report(
    revenue: DataFrame, days: Column, vocabulary: Vocabulary
) -> DataFrame:
    outputs = {
        "author": "count_provisioned_author",
        "reader_count": "provisioned_readers",
        "net_revenue": "net_revenue",
        "spice_gb": "spice_gb",
    }
    keys = ["account_id", "company_name", "edition"]
    return top_report(revenue, days, vocabulary, keys, outputs, "author", known="author")


def top_payer_authors_report(
    revenue: DataFrame, days: Column, vocabulary: Vocabulary
) -> DataFrame:
    outputs = {
        "user_count": "count_provisioned_author",
        "net_revenue": "net_revenue",
        "spice_gb": "spice_gb",
    }
    return top_report(
        revenue, days, vocabulary, _PAYER, outputs, "user_count", known="user_count"
    )


def top_payer_users_report(
    revenue: DataFrame, first: dt.date, vocabulary: Vocabulary
) -> DataFrame:
    """Users are authors plus readers, NULL if either is; ordered by authors."""
    authors, readers = F.col("author"), F.col("reader_count")
    outputs = {
        "author": "count_provisioned_author",
        "reader_count": "provisioned_readers",
        "net_revenue": "net_revenue",
        "spice_gb": "spice_gb",
    }
    top = top_report(
        revenue, since(first), vocabulary, _PAYER, outputs, "author", known="author"
    )
    return top.select(*_PAYER, (authors + readers).alias("user_count"), "net_revenue", "spice_gb")


def top_analysis_report(events: DataFrame, days: Column, vocabulary: Vocabulary) -> DataFrame:
    outputs = {"analysis_created": "count_analysis_created"}
    keys = ["account_id", "company_name"]
    return top_report(events, days, vocabulary, keys, outputs, "analysis_created")


def top_readers_report(events: DataFrame, day: dt.date, vocabulary: Vocabulary) -> DataFrame:
    outputs = {"active_readers": "count_active_readers"}
    keys = ["account_id", "company_name"]
    return top_report(events, on_day(day), vocabulary, keys, outputs, "active_readers")
