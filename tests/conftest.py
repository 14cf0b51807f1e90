from __future__ import annotations

import datetime as dt
import os
import sys

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daymark import Inputs, Vocabulary
from daymark.sources.calendar import date_spine
from verification.compare import session

SCHEMAS = {
    "raw_events": "event_day timestamp_ntz, account_id string, user_id string, "
    "event_name string, user_data string, region string",
    "account_details": "account_id string, payer_account_id string, company_name string, "
    "internal string, account_status_code string, fraud_enforcement_status string",
    "business_metrics": "computation_date date, account_id string, payer_account_id string, "
    "product_code string, metrics_name string, gross_revenue decimal(18,4), "
    "estimated_negative_revenue_share decimal(6,4), usage decimal(18,4), "
    "discounts decimal(18,4), crf decimal(18,4)",
    "daily_account_metrics": "computation_date date, start_iso_week_date date, "
    "end_iso_week_date date, account_id string, product_code string, metrics_name string, "
    "daily_usage decimal(18,4)",
    "metering": "request_day timestamp_ntz, account_id string, usage_resource string, "
    "usage_type string, product_code string",
    "account_daily": "account_id string, region string, internal string, computation_date date",
    "regions": "region_code string",
    "reporting_dates": "dbr_start_date date",
}
READER = '{"role":"READER"}'
AUTHOR = '{"role":"AUTHOR"}'
ETL = dt.date(2024, 1, 30)


@pytest.fixture(scope="session")
def spark():
    return session(4)


def local_frame(spark, rows, ddl):
    """A frame of literal rows that Spark knows to be small, or empty."""
    schema = StructType.fromDDL(ddl)
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(schema)}
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)), schema)


@pytest.fixture
def make(spark):
    """Build the source tables from literal rows; tables not given are empty."""

    def build(first=dt.date(2023, 11, 1), last=dt.date(2024, 2, 29), **tables) -> Inputs:
        frames = {
            name: local_frame(spark, tables.get(name, []), schema)
            for name, schema in SCHEMAS.items()
        }
        return Inputs(calendar=date_spine(spark, first, last), **frames)

    return build


@pytest.fixture
def words():
    return Vocabulary(product_code="P")


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def event(on, account, user, name, text=AUTHOR, region="r1"):
    return (dt.datetime.fromisoformat(on), account, user, name, text, region)


def login(on, account, user, region="r1", text=AUTHOR):
    return event(on, account, user, "UserLogin", text, region)


def view(on, account, user, region="r1", text=READER):
    return event(on, account, user, "DashboardView", text, region)


def account(name, internal="external", status="Active", fraud=None, payer="p"):
    return (name, payer, f"company {name}", internal, status, fraud)


def revenue(on, name, metric, gross=0, share=0, usage=0, payer="p", discounts=0, crf=0):
    from decimal import Decimal as D

    values = [D(str(x)) for x in (gross, share, usage, discounts, crf)]
    return (day(on), name, payer, "P", metric, *values)


def plan(on, name, metric, usage="1"):
    from decimal import Decimal as D

    start = day(on) - dt.timedelta(days=day(on).weekday())
    return (day(on), start, start + dt.timedelta(days=6), name, "P", metric, D(usage))


def metered(on, name, resource):
    return (dt.datetime.fromisoformat(on), name, resource, "Reader-Session", "P")
