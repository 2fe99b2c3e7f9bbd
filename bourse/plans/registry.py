"""Registry of named queries: one Spark builder and (where SQL can express
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``
    with its oracle SQL (``None`` = no SQL form; rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that it registers itself."""
    from . import (q_extra, q_jobs, q_joins, q_master, q_nested, q_relational, q_search, q_stream, q_tables,  # noqa: F401
                   q_timeseries, q_views)
