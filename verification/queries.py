"""All registered queries."""

from verification import (  # noqa: F401
    case_aggregates,
    case_columns,
    case_corrections,
    case_joins,
    case_jobs,
    case_sources,
)
from verification.registry import oracle_queries, spark_queries

__all__ = ["oracle_queries", "spark_queries"]
