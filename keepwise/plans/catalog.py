"""Registry of named queries: name -> Spark builder (spark, sf_dir) -> DataFrame,
and, for SQL-checkable ones, the independent DuckDB formulation."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c: str | Column, k: int = 6) -> Column:
    """Round a double output for cross-engine comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, k)


def load_all() -> None:
    """Import every query module so the registry is complete."""
    from keepwise.plans import (q_core, q_metrics, q_ml, q_policy, q_profile,  # noqa: F401
                                q_stats, q_survival)
    from keepwise.plans import q_io, q_missing, q_report  # noqa: F401
