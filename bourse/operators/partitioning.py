"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an UNDER-partitioned input over the cluster before a
    CPU-heavy per-row stage (JSON, tokenizing, trigram sets).

    A large table read from many files already has many partitions and is
    returned unchanged (no extra shuffle); a single-file input (one row group
    = one task) is spread to the default parallelism so that the heavy stage
    does not run in one task.

    Meant for file scans: asking a frame for its partition count runs the
    adaptive plan's shuffle stages, so it is not applied to frames that
    already contain shuffles (their partition count is the shuffle's)."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - plans without an RDD view
        return df
    return df.repartition(want) if have < want else df
