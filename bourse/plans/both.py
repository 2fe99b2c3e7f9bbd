"""Stand-in frames written once in SQL that both engines run: Spark over the
parquet tables, DuckDB as common table expressions of the oracles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .fixtures import table

_NAME = re.compile(r"\{(\w+)\}")


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The SQL over the driver's tables, which it names in braces."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in set(_NAME.findall(sql))})


def ctes(**sqls: str) -> dict[str, str]:
    """The same SQL for DuckDB, by name."""
    return {n: _NAME.sub(r"\1", s) for n, s in sqls.items()}


def key_cte(known: str, rows: str, uid: str) -> str:
    """Known keys and the new ones that ``assign_surrogate_keys`` gives the
    other uids of ``rows``."""
    return (f"SELECT uid, surrogate_key FROM {known} UNION ALL SELECT uid, (SELECT max(surrogate_key) FROM {known}) + "
            f"row_number() OVER (ORDER BY uid) FROM (SELECT DISTINCT {uid} AS uid FROM {rows} WHERE {uid} IS NOT NULL "
            f"AND {uid} NOT IN (SELECT uid FROM {known}))")
