"""Registered queries for SURVEY 2.14 (streaming re-aims, checked against
their batch twins) and 2.15 (user-supplied function surfaces)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import udf_surface as U
from ..operators.projections import normalize_quote_update
from ..session import scratch_path
from ..sinks import writers as WR
from ..streaming import streams as ST
from .fixtures import table, v_quote, v_security, with_views
from .registry import register

def _raw_logs(spark, sf_dir):
    """Log records as a producer sends them: epoch seconds, lower-case
    service / level; every third record lacks ``event``."""
    e = table(spark, sf_dir, "events")
    secs = F.floor(F.timestamp_diff("MICROSECOND", ST.epoch_col(), F.col("ts")) / 1_000_000).cast("bigint")
    return e.select(
        F.col("event_id").alias("id"), secs.alias("created"),
        F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")).alias("service"),
        F.col("event_type").alias("level"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("event"),
        F.col("props").alias("message"), "user_id")


_LOG_SQL = """
SELECT event_id AS id, date_trunc('second', ts) AS created, 'S' || CAST(user_id % 4 AS VARCHAR) AS service,
       upper(event_type) AS level, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event,
       props AS message, user_id FROM events"""


@register("normalize_logs", _LOG_SQL)
def q_normalize_logs(spark, sf_dir):
    return ST.normalize_logs(_raw_logs(spark, sf_dir))


_LOG_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("created", T.LongType()),
                            T.StructField("service", T.StringType()), T.StructField("level", T.StringType()),
                            T.StructField("event", T.StringType()), T.StructField("message", T.StringType()),
                            T.StructField("user_id", T.LongType())])


@register("stream_log_ingest", _LOG_SQL)
def q_stream_log_ingest(spark, sf_dir):
    src, target, ckpt = (scratch_path(spark, n) for n in ("log-src", "log-table", "log-ckpt"))
    _raw_logs(spark, sf_dir).repartition(4).write.mode("overwrite").json(src)
    ST.stream_log_ingest(spark, src, _LOG_SCHEMA, target, ckpt, max_files_per_trigger=2)
    return spark.read.parquet(target).select("id", "created", "service", "level", "event", "message", "user_id")


_QCOLS = "date, security_code, exchange_code, open, high, low, close, adjusted_close, volume, year"
_RAW_Q_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()), T.StructField("Code", T.StringType()),
    T.StructField("exchange", T.StringType()), T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()), T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()), T.StructField("Adjusted_close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType())])


@register("stream_quote_increment", with_views("""
SELECT date, security_code, exchange_code, open, high, low, close, adjusted_close, volume,
       CAST(year(date) AS INTEGER) AS year FROM v_quote WHERE date < DATE '1998-01-01'
UNION ALL
SELECT date, security_code, exchange_code, open, high, low, close * 2, adjusted_close, volume,
       CAST(year(date) AS INTEGER) FROM v_quote WHERE date >= DATE '1998-01-01'""", "v_quote"))
def q_stream_quote_increment(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    raw = q.select(F.col("date").alias("Date"), F.col("security_code").alias("Code"),
                   F.col("exchange_code").alias("exchange"), F.col("open").alias("Open"),
                   F.col("high").alias("High"), F.col("low").alias("Low"), (F.col("close") * 2).alias("Close"),
                   F.col("adjusted_close").alias("Adjusted_close"), F.col("volume").cast("double").alias("Volume"))
    src, target, ckpt = (scratch_path(spark, n) for n in ("quote-src", "quote-table", "quote-ckpt"))
    # the table holds quotes before 1998; daily files from mid-1997 on overlap it
    start = normalize_quote_update(raw.where(F.col("Date") < F.lit(_dt.date(1998, 1, 1)))) \
        .withColumn("close", F.col("close") / 2)
    WR.write_partitioned(start, target, ["exchange_code", "year"])
    files = raw.where(F.col("Date") >= F.lit(_dt.date(1997, 7, 1)))
    files.repartition(6, "Date").write.mode("overwrite").option("header", True).csv(src)
    # several micro-batches, so that later ones meet what earlier ones wrote
    ST.stream_quote_increment(spark, src, _RAW_Q_SCHEMA, target, ckpt, max_files_per_trigger=2)
    return spark.read.parquet(target).select(*_QCOLS.split(", "))


# ------------------------------------------------------------------ 2.15

def _add_slug(df):
    return df.withColumn("slug", C.slugify(F.concat_ws(" ", "type", "name")))


@register("user_transformation", with_views("""
SELECT code, name, type, replace(lower(type || ' ' || name), ' ', '_') AS slug FROM v_security""", "v_security"))
def q_user_transformation(spark, sf_dir):
    return U.apply_transformation(v_security(spark, sf_dir).select("code", "name", "type"), _add_slug)


@register("sql_template", with_views("""
SELECT exchange_code, count(*) AS n, max(name) AS last_name FROM v_security
WHERE size >= 10 AND type <> 'it''s' GROUP BY exchange_code""", "v_security"))
def q_sql_template(spark, sf_dir):
    text = ("SELECT exchange_code, count(*) AS n, max(name) AS last_name FROM {sec} "
            "WHERE size >= :min_size AND type <> :bad GROUP BY exchange_code")
    return U.run_sql(spark, text, frames={"sec": v_security(spark, sf_dir)}, args={"min_size": 10, "bad": "it's"})


@register("dispatch_by_type", with_views("""
SELECT code, type, upper(name) AS label FROM v_security WHERE type = 'SMALL'
UNION ALL
SELECT code, type, lower(exchange_code) AS label FROM v_security WHERE type = 'LARGE'""", "v_security"))
def q_dispatch_by_type(spark, sf_dir):
    s = v_security(spark, sf_dir)
    return U.dispatch_by_type(s, "type", {
        "SMALL": lambda d: d.select("code", "type", F.upper("name").alias("label")),
        "LARGE": lambda d: d.select("code", "type", F.lower("exchange_code").alias("label")),
    })
