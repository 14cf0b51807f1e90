"""Names found in the source data, and the bundle of source tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


def _table(**entries: tuple[str, ...]):
    return field(default_factory=lambda: dict(entries))


@dataclass(frozen=True)
class Vocabulary:
    """Values the source systems write. Only the product code has no default."""

    product_code: str

    # Event names.
    login: str = "UserLogin"
    dashboard_view: str = "DashboardView"
    dataset_prepared: str = "PreparedDataSourceCreated"
    source_created: str = "DataSourceGroupCreated"

    # Patterns and keys of the JSON text of an event.
    reader_pattern: str = '%"role":"READER"%'
    sample_pattern: str = "%SAMPLE%"
    accelerated_key: str = "accelerated"
    source_type_key: str = "dataSourceGroupType"

    # Output column -> event whose distinct users are counted.
    user_counters: dict = _table(
        count_users_unsubscribed=("Unsubscribe",),
        count_users_activated=("UserActivated",),
        count_users_invited=("UserInvite",),
    )
    # Output column -> events that are counted.
    event_counters: dict = _table(
        count_analysis_created=("AnalysisCreated", "AnalysisCreatedFromDashboard"),
        count_dashboard_created=("DashboardCreated",),
        count_analysis_deleted=("AnalysisDeleted",),
        count_dashboard_deleted=("DashboardDeleted",),
        dashboards_viewed=("DashboardView",),
        dashboards_updated=("DashboardUpdated",),
        datasourcegroups_created=("DataSourceGroupCreated",),
    )
    # Output column -> source types that are counted.
    source_counters: dict = _table(
        count_s3_dataset=("S3CONNECTION",),
        count_redshift_dataset=("REDSHIFT", "EXTERNAL"),
        count_rds_dataset=("RDS",),
        count_athena_dataset=("ATHENA",),
        count_xlsx_dataset=("XLSX",),
        count_csv_dataset=("CSV",),
        count_flat=("CSV", "TSV"),
        count_log=("ELF", "CLF"),
    )
    # Counters that add up to dataset_created.
    dataset_parts: tuple[str, ...] = (
        "count_spice",
        "count_redshift_dataset",
        "count_rds_dataset",
        "count_athena_dataset",
    )

    # Plan metrics of the daily account table.
    plan_metrics: dict = _table(
        free_tier=("FreeTier",),
        free_trial=("FreeTrial",),
        paid=("PaidStandard", "PaidEnterprise"),
        total_std=("TotalStandard",),
        total_ent=("TotalEnterprise",),
    )

    # Revenue and usage metrics.
    overall_metric: str = "QS-Overall"
    revenue_streams: dict = _table(
        annual_sub_revenue=("QS-User-Enterprise-Annual", "QS-User-Standard-Annual"),
        monthly_sub_revenue=("QS-User-Enterprise-Month", "QS-User-Standard-Month"),
        spice_revenue=("SPICE",),
        reader_revenue=("QS-ReaderOverall", "QS-ReaderReportSession"),
    )
    annual_author_metric: str = "PaidAnnual"
    monthly_author_metric: str = "PaidMonthly"
    free_user_metric: str = "FreeTier"
    trial_user_metric: str = "FreeTrial"
    spice_metric: str = "SPICE"
    reader_metric: str = "QS-ReaderOverall"
    report_session_metric: str = "QS-ReaderReportSession"
    usage_rule_change: str = "2017-02-01"
    reader_usage_pattern: str = "%Reader%"

    # Account status.
    external: str = "external"
    suspended_status: str = "Suspended"
    fraud_patterns: tuple[str, ...] = ("%Suspended", "%Terminated")

    # Regions of the regional board, and the label for no region.
    board_regions: tuple[str, ...] = ("CMH", "DUB", "IAD", "PDX", "SIN", "SYD", "NRT")
    unknown_region: str = "Unknown"


@dataclass(frozen=True)
class Inputs:
    """The source tables the jobs and reports read."""

    raw_events: DataFrame
    calendar: DataFrame
    account_details: DataFrame
    business_metrics: DataFrame
    daily_account_metrics: DataFrame
    metering: DataFrame
    account_daily: DataFrame
    regions: DataFrame
    reporting_dates: DataFrame
