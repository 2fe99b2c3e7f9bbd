"""Structured Streaming re-aims of two batch ingest jobs.

Both use ``trigger(availableNow=True)``: every file present when the query
starts is processed, in bounded micro-batches, and the query stops; the
checkpoint folder (shared storage) records progress, so a restarted query
resumes without re-reading committed files. The same normalization
functions run in batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.projections import normalize_quote_update
from ..sinks.partitioned import append_epoch, partition_columns


def epoch_col() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_to_utc(c: Column) -> Column:
    """Epoch seconds (possibly fractional) -> UTC wall-clock timestamp, by
    arithmetic (independent of the session time zone)."""
    return F.timestamp_add("MICROSECOND", F.round(c.cast("double") * 1_000_000).cast("bigint"), epoch_col())


def normalize_logs(df: DataFrame, required: Sequence[str] = ("event", "message"),
                   upper: Sequence[str] = ("service", "level")) -> DataFrame:
    """Log ingest: ``created`` epoch seconds -> timestamp; required fields
    exist (NULL when absent); ``service`` / ``level`` upper-cased."""
    out = df.withColumn("created", epoch_to_utc(F.col("created")))
    for c in required:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    for c in upper:
        if c in out.columns:
            out = out.withColumn(c, F.upper(F.col(c)))
    return out


def stream_log_ingest(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                      checkpoint: str, max_files_per_trigger: int = 1000) -> None:
    """JSON log files -> normalized parquet table (append)."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir)
    q = (normalize_logs(src).writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


def stream_quote_increment(spark: SparkSession, source_dir: str, schema: T.StructType, target: str,
                           checkpoint: str, keys: Sequence[str] = ("date", "security_code", "exchange_code"),
                           max_files_per_trigger: int = 1000) -> None:
    """Daily bulk quote files -> normalize -> insert rows whose key is new.

    No watermark: a late file is as good as any. Of rows with one key in a
    batch the least by its other columns is kept; keys of earlier batches are
    found in the target by an anti join. The rows are appended in the target's
    own partition layout, and where its partition columns follow from the key
    (the exchange is part of it, the year of its date) the target is read only
    in the partitions of the batch. Every epoch is recorded with the table
    (under the checkpoint's name), so replaying it inserts nothing twice."""
    src = (spark.readStream.schema(schema).option("header", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir))
    layout = partition_columns(spark, target)
    query = checkpoint.rstrip("/").rsplit("/", 1)[-1]

    def merge_batch(batch: DataFrame, epoch: int) -> None:
        append_epoch(target, batch, epoch, query, keys, layout, key_fixes_partition=set(layout) <= {*keys, "year"})

    q = (normalize_quote_update(src).writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
