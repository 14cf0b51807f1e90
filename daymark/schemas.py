"""Typed definitions of the five output tables, and how a frame is made to fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MAX_BYTES = "max_bytes"


def _text(name: str, size: int) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {MAX_BYTES: size})


def _fields(data_type: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, data_type) for name in names]


# Column names, order, types and text sizes of the loaded tables.
_DATE, _STAMP, _COUNT = T.DateType(), T.TimestampNTZType(), T.LongType()
_MONEY = T.DecimalType(38, 30)
_KEY = [T.StructField("computation_date", _DATE), _text("account_id", 100)]
_CALENDAR = [
    *_fields(_DATE, "start_iso_week_date", "end_iso_week_date"),
    T.StructField("num_of_day_in_month", T.ShortType()),
]
_OWNER = [_text("payer_account_id", 32), _text("company_name", 256), _text("internal", 32)]
_SEEN = [T.StructField("join_date", _DATE), T.StructField("last_login_date", _STAMP)]
_PLAN = [_text("account_type", 13), _text("edition", 10)]
_AUDIT = _fields(_STAMP, "dw_create_date", "dw_update_date")
_ATTRIBUTES = [*_CALENDAR, *_OWNER, *_SEEN, *_PLAN]

ACTIVITY_COLUMNS = (
    "count_active_readers",
    "count_active_authors",
    "count_users_unsubscribed",
    "count_users_activated",
    "count_users_invited",
    "count_login_event",
    "dataset_created",
    "count_analysis_created",
    "count_dashboard_created",
    "count_analysis_deleted",
    "count_dashboard_deleted",
    "dashboards_viewed",
    "dashboards_updated",
    "datasourcegroups_created",
    "count_spice",
    "count_s3_dataset",
    "count_redshift_dataset",
    "count_rds_dataset",
    "count_athena_dataset",
    "count_xlsx_dataset",
    "count_csv_dataset",
    "count_flat",
    "count_log",
)
_ACTIVITY = [
    T.StructField("active_account", T.BooleanType()),
    *_fields(_COUNT, *ACTIVITY_COLUMNS, "count_new_authors"),
]

ACCOUNT_TYPE_EDITION_DAILY = T.StructType(
    [*_KEY, *_CALENDAR, *_SEEN, *_OWNER, *_PLAN, *_AUDIT]
)
EVENTS_DAILY = T.StructType([*_KEY, *_ATTRIBUTES, *_ACTIVITY, *_AUDIT])
EVENTS_REGIONAL_DAILY = T.StructType(
    [
        *_KEY,
        _text("region", 100),
        *_ATTRIBUTES,
        *_ACTIVITY,
        *_fields(
            _COUNT,
            "l30_count_active_reader",
            "l30_count_active_authors",
            "l30_count_active_accounts",
            "l7_count_active_reader",
            "l7_count_active_authors",
            "l7_count_active_accounts",
        ),
        *_AUDIT,
    ]
)
REVENUE_DAILY = T.StructType(
    [
        *_KEY,
        *_ATTRIBUTES,
        T.StructField("gross_revenue", T.DecimalType(38, 22)),
        *_fields(
            _MONEY,
            "revenue",
            "annual_sub_revenue",
            "monthly_sub_revenue",
            "spice_revenue",
            "reader_revenue",
            "count_provisioned_author",
            "count_provisioned_paid_authors_with_annual_subscription",
            "count_provisioned_paid_authors_with_monthly_subscription",
            "count_provisioned_free_users",
            "count_provisioned_trial_users",
            "count_provisioned_reader_seesions",
            "spice_gb",
            "count_provisioned_reader_interactive_sessions",
            "count_provisioned_reader_email_sessions",
        ),
        T.StructField("provisioned_readers", _COUNT),
        *_AUDIT,
        T.StructField("net_revenue", _MONEY),
    ]
)
COUNT_USER_ROLLING_DAYS = T.StructType(
    [
        *_KEY,
        *_ATTRIBUTES,
        *_fields(_COUNT, "l30_count_reader", "l7_count_reader"),
        *[
            f
            for span in ("l30", "l7")
            for f in (
                *_fields(
                    _DATE, f"{span}_period_first_event_date", f"{span}_period_last_event_date"
                ),
                *_fields(
                    _COUNT,
                    f"{span}_count_active_reader",
                    f"{span}_count_active_authors",
                    f"{span}_total_login_event",
                    f"{span}_count_active_accounts",
                ),
            )
        ],
        *_AUDIT,
    ]
)

TABLES: dict[str, T.StructType] = {
    "account_type_edition_daily": ACCOUNT_TYPE_EDITION_DAILY,
    "events_daily": EVENTS_DAILY,
    "events_regional_daily": EVENTS_REGIONAL_DAILY,
    "revenue_daily": REVENUE_DAILY,
    "count_user_rolling_days": COUNT_USER_ROLLING_DAYS,
}

KEYS: dict[str, tuple[str, ...]] = {
    name: (
        ("computation_date", "account_id", "region")
        if name == "events_regional_daily"
        else ("computation_date", "account_id")
    )
    for name in TABLES
}

#: Columns every fact table copies from the account dimension.
DIMENSION_ATTRIBUTES: tuple[str, ...] = tuple(f.name for f in _ATTRIBUTES)


def fitted(field: T.StructField) -> str:
    """SQL that casts a column to its declared type.

    A text above its declared size (in bytes) fails the query.
    """
    name, size = field.name, field.metadata.get(MAX_BYTES)
    value = f"CAST({name} AS {field.dataType.simpleString()})"
    if size is not None:
        message = f"concat('{name} is longer than {size} bytes: ', {value})"
        value = f"IF(octet_length({value}) > {size}, raise_error({message}), {value})"
    return f"{value} AS {name}"


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast, order and size-check the columns of ``df`` to the declared table."""
    return df.selectExpr(*[fitted(field) for field in schema])
