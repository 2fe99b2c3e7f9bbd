"""Table writers. Paths are folders in shared storage; a
rewrite of a table goes to a new folder first (``commit``), so that no plan
reads and overwrites the same path."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ntz_lit, utc_now


def stamp_overwrite(df: DataFrame, at: _dt.datetime | None = None) -> DataFrame:
    """Rows of a full replace: ``created_at`` = now (UTC), ``updated_at`` NULL."""
    now = ntz_lit(at) if at else utc_now()
    return df.withColumn("created_at", now).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "static",
                    fmt: str = "parquet") -> None:
    """Replace content. ``mode="static"`` replaces the whole table;
    ``"dynamic"`` replaces only the partitions present in ``df``."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], fmt: str = "parquet") -> None:
    """One folder per value combination (``k=v/...``) in ONE pass; rows are
    clustered by the partition columns first so each task writes few files, and
    a value that holds many rows is split over tasks (``rebalance``)."""
    df.hint("rebalance", *cols).write.mode("overwrite").format(fmt).partitionBy(*cols).save(path)


def write_sized_files(df: DataFrame, path: str, max_rows_per_file: int = 10 * 1024 * 1024,
                      row_group_bytes: int = 128 * 1024 * 1024) -> None:
    """Dataset writer with a rows-per-file cap and a row-group size."""
    (df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file)
     .option("parquet.block.size", row_group_bytes).parquet(path))


def write_format(df: DataFrame, path: str, fmt: str) -> None:
    """Same data as parquet, csv (with header) or json records."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 100_000, key: str | None = None) -> None:
    """JSON array files (one array per file), as vendor list endpoints
    deliver them. Rows are bucketed by a hash so that each array holds about
    ``rows_per_file`` rows; no file gathers the whole frame."""
    n = max(1, -(-df.count() // rows_per_file))
    k = F.col(key) if key else F.monotonically_increasing_id()
    b = df.withColumn("_b", F.pmod(F.xxhash64(k), F.lit(n)))
    arr = b.groupBy("_b").agg(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("value"))
    # one folder (hence one file) per bucket: a file holds exactly one array
    arr.select("_b", "value").write.mode("overwrite").partitionBy("_b").text(path)


def write_documents(df: DataFrame, path: str, name_col: str, text_col: str) -> None:
    """One document per folder ``name=<value>`` (a text file holding the
    JSON), as document stores deliver them."""
    df.select(name_col, text_col).hint("rebalance", name_col).write.mode("overwrite").partitionBy(name_col).text(path)


def insert_by_name(df: DataFrame, table_name: str, overwrite: bool = False) -> None:
    """INSERT into a catalog table matching columns BY NAME (``insertInto``
    alone is positional, and partition columns sit last in the table)."""
    cols = df.sparkSession.table(table_name).columns
    df.select(*cols).write.insertInto(table_name, overwrite=overwrite)


def create_curated_tables(spark: SparkSession, base_path: str, database: str = "curated") -> list[str]:
    """Namespace + curated tables, partitioned as the lakehouse layout
    (``year`` is a stored column: the hidden ``year(date)`` transform)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    ddl = {
        "exchange": ("code STRING, name STRING, operating_mic STRING, currency STRING, country STRING, "
                     "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ", ""),
        "security": ("code STRING, name STRING, isin STRING, country STRING, currency STRING, type STRING, "
                     "exchange_code STRING", "PARTITIONED BY (exchange_code, type)"),
        "security_quote": ("security_code STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, "
                           "adjusted_close DOUBLE, volume BIGINT, exchange_code STRING, year INT",
                           "PARTITIONED BY (exchange_code, year)"),
        "mapping": ("field STRING, source_value STRING, source_description STRING, mapping_value STRING, "
                    "uid_description STRING, active_from DATE, active_until DATE, is_active BOOLEAN, "
                    "product STRING, source STRING", "PARTITIONED BY (product, source)"),
        "fundamental": ("category STRING, metric STRING, value STRING, currency STRING, period DATE, "
                        "period_type STRING, published_at DATE, exchange_code STRING, security_code STRING, "
                        "year INT", "PARTITIONED BY (exchange_code, security_code, year)"),
        "entity_isin": ("lei STRING, isin STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ", ""),
        "entity": ("lei STRING, name STRING, legal_address_country STRING, status STRING", 
                   "PARTITIONED BY (legal_address_country)"),
    }
    made = []
    for t, (cols, part) in ddl.items():
        loc = f"{base_path.rstrip('/')}/{t}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t} ({cols}) USING parquet {part} LOCATION '{loc}'")
        made.append(f"{database}.{t}")
    return made
