"""User-supplied function surfaces: a frame transformation, a
SQL template with bound frames and scalars, and per-type dispatch."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def apply_transformation(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``transformation: DataFrame -> DataFrame`` supplied by the user."""
    return df.transform(fn)


def run_sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame] | None = None,
            args: Mapping[str, object] | None = None) -> DataFrame:
    """SQL text with ``{name}`` frame bindings and ``:name`` scalar
    parameters. Scalars are bound, never pasted into the text, so quoting
    cannot break or inject into the statement."""
    return spark.sql(text, args=dict(args or {}), **dict(frames or {}))


def dispatch_by_type(df: DataFrame, type_col: str, handlers: Mapping[str, Callable[[DataFrame], DataFrame]]
                     ) -> DataFrame:
    """One transformer per type value: each handler sees only its rows;
    results are unioned by name (types without a handler are skipped)."""
    parts = [fn(df.where(F.col(type_col) == F.lit(t))) for t, fn in handlers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
