"""Stand-in views over the driver's tables (FIXTURES.md section 2).

Each view exists twice: as a Spark ``DataFrame`` builder and as a SQL body
that DuckDB runs for the oracle. Both read the same parquet files, so the
two sides see the same rows. The views are plain derivations: every row of
the base table reaches the view, nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed dates the checks run against (FIXTURES.md section 2).
QUOTE_AS_OF = _dt.date(2001, 6, 30)
EVENTS_AS_OF = _dt.date(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- Spark side

def _unit_price() -> Column:
    return F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))


def v_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars per (security_code, exchange_code, date)."""
    li = table(spark, sf_dir, "lineitem")
    p = _unit_price()
    return (
        li.groupBy(
            F.col("l_partkey").cast("string").alias("security_code"),
            F.col("l_linestatus").alias("exchange_code"),
            F.to_date("l_shipdate").alias("date"),
        )
        .agg(
            F.min(p).alias("open"),
            F.max(p).alias("high"),
            F.min(p).alias("low"),
            F.max(p).alias("close"),
            F.max(p).alias("adjusted_close"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
        )
    )


def v_quote_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``v_quote`` with holes in ``adjusted_close`` (for gap filling)."""
    q = v_quote(spark, sf_dir)
    hole = ((F.col("security_code").cast("int") + F.dayofmonth("date")) % 7) == 0
    return q.withColumn("adjusted_close", F.when(~hole, F.col("adjusted_close")))


def v_security(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    sz = F.col("p_size") % 10
    return p.select(
        k.cast("string").alias("code"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("exchange_code"),
        F.when(k % 5 != 0, F.concat(F.lit("IS"), k.cast("string"))).alias("isin"),
        F.when(sz == 0, F.lit("Unknown")).when(sz == 1, F.lit("")).otherwise(F.lit("USD")).alias("currency"),
        F.col("p_partkey").alias("id"),
        F.col("p_size").alias("size"),
    )


def v_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    venues = n.select(
        (F.col("n_nationkey").cast("bigint") + 100).alias("id"),
        F.col("n_name").alias("mic"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("bigint").alias("operating_exchange_id"),
    )
    operators = r.select(
        F.col("r_regionkey").cast("bigint").alias("id"),
        F.col("r_name").alias("mic"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("bigint").alias("operating_exchange_id"),
    )
    return venues.unionByName(operators)


def v_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # plain join: AQE broadcasts the (tiny) nation side from its runtime size
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("lei"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("legal_address_country"),
        F.col("c_mktsegment").alias("status"),
    )


def v_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("security_id"), F.col("l_suppkey").alias("exchange_id")
    ).distinct()


def v_figi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = v_security(spark, sf_dir)
    k = F.col("id")
    return s.where((k % 3 == 0) | (k % 4 == 0)).select(
        F.when(k % 3 == 0, F.col("code")).alias("ticker_source"),
        F.when(k % 4 == 0, F.col("isin")).alias("isin_source"),
        F.concat(F.lit("F"), F.col("code")).alias("figi"),
        F.concat(F.lit("C"), F.col("code")).alias("composite_figi"),
        F.col("name").alias("name_figi"),
        F.col("type").alias("security_type_figi"),
    )


def v_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value mapping derived from the data: brands with an even number and
    nations with an even key are mapped, the rest are not. Brands map by
    their last digit, so one composite value stands for several brands."""
    p = table(spark, sf_dir, "part")
    n = table(spark, sf_dir, "nation")
    brand_no = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")
    brands = p.select(F.col("p_brand").alias("source_value"), brand_no.alias("no")).distinct().select(
        F.lit("security").alias("product"),
        F.lit("vendor").alias("source"),
        F.lit("exchange_code").alias("field"),
        "source_value",
        F.when(F.col("no") % 2 == 0, F.concat(F.lit("X"), (F.col("no") % 10).cast("string"))).alias("mapping_value"),
        (F.col("no") % 4 != 3).alias("is_active"),
    )
    nations = n.select(
        F.lit("exchange").alias("product"),
        F.lit("vendor").alias("source"),
        F.lit("mic").alias("field"),
        F.col("n_name").alias("source_value"),
        F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("M"), F.col("n_nationkey").cast("string"))).alias("mapping_value"),
        F.lit(True).alias("is_active"),
    )
    return brands.unionByName(nations)


def v_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created"),
        F.upper("event_type").alias("level"),
        F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("service"),
        F.col("event_type").alias("event"),
        F.col("props").alias("message"),
        F.col("user_id"),
        F.col("value"),
    )


# ----------------------------------------------------------------- SQL side
# DuckDB bodies of the same views; ``with_views`` prepends the ones a query
# needs as CTEs (dependencies first).

SQL_VIEWS: dict[str, str] = {
    "v_quote": """
        SELECT CAST(l_partkey AS VARCHAR) AS security_code, l_linestatus AS exchange_code,
               CAST(l_shipdate AS DATE) AS date,
               min(l_extendedprice / NULLIF(l_quantity, 0)) AS open,
               max(l_extendedprice / NULLIF(l_quantity, 0)) AS high,
               min(l_extendedprice / NULLIF(l_quantity, 0)) AS low,
               max(l_extendedprice / NULLIF(l_quantity, 0)) AS close,
               max(l_extendedprice / NULLIF(l_quantity, 0)) AS adjusted_close,
               CAST(sum(l_quantity) AS BIGINT) AS volume
        FROM lineitem GROUP BY 1, 2, 3""",
    "v_quote_null": """
        SELECT security_code, exchange_code, date, open, high, low, close,
               CASE WHEN (CAST(security_code AS INTEGER) + day(date)) % 7 = 0 THEN NULL
                    ELSE adjusted_close END AS adjusted_close, volume
        FROM v_quote""",
    "v_security": """
        SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_type AS type,
               p_brand AS exchange_code,
               CASE WHEN p_partkey % 5 <> 0 THEN 'IS' || CAST(p_partkey AS VARCHAR) END AS isin,
               CASE WHEN p_size % 10 = 0 THEN 'Unknown' WHEN p_size % 10 = 1 THEN '' ELSE 'USD' END AS currency,
               p_partkey AS id, p_size AS size
        FROM part""",
    "v_exchange": """
        SELECT CAST(n_nationkey AS BIGINT) + 100 AS id, n_name AS mic, n_name AS name,
               CAST(n_regionkey AS BIGINT) AS operating_exchange_id FROM nation
        UNION ALL
        SELECT CAST(r_regionkey AS BIGINT), r_name, r_name, CAST(NULL AS BIGINT) FROM region""",
    "v_entity": """
        SELECT c_custkey AS id, c_name AS lei, c_name AS name, n_name AS legal_address_country,
               c_mktsegment AS status
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "v_listing": """
        SELECT DISTINCT l_partkey AS security_id, l_suppkey AS exchange_id FROM lineitem""",
    "v_figi": """
        SELECT CASE WHEN id % 3 = 0 THEN code END AS ticker_source,
               CASE WHEN id % 4 = 0 THEN isin END AS isin_source,
               'F' || code AS figi, 'C' || code AS composite_figi,
               name AS name_figi, type AS security_type_figi
        FROM v_security WHERE id % 3 = 0 OR id % 4 = 0""",
    "v_mapping": """
        SELECT 'security' AS product, 'vendor' AS source, 'exchange_code' AS field,
               source_value,
               CASE WHEN no % 2 = 0 THEN 'X' || CAST(no % 10 AS VARCHAR) END AS mapping_value,
               (no % 4 <> 3) AS is_active
        FROM (SELECT DISTINCT p_brand AS source_value,
                     CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS no FROM part)
        UNION ALL
        SELECT 'exchange', 'vendor', 'mic', n_name,
               CASE WHEN n_nationkey % 2 = 0 THEN 'M' || CAST(n_nationkey AS VARCHAR) END, TRUE
        FROM nation""",
    "v_log": """
        SELECT event_id AS id, ts AS created, upper(event_type) AS level,
               'S' || CAST(user_id % 4 AS VARCHAR) AS service, event_type AS event,
               props AS message, user_id, value
        FROM events""",
}

_DEPS = {
    "v_quote_null": ["v_quote"],
    "v_figi": ["v_security"],
}


def _order(names):
    out: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the named views (plus ``extra`` CTEs,
    which may use the views)."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in _order(names)]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v})")
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql


SPARK_VIEWS = {
    "v_quote": v_quote,
    "v_quote_null": v_quote_null,
    "v_security": v_security,
    "v_exchange": v_exchange,
    "v_entity": v_entity,
    "v_listing": v_listing,
    "v_figi": v_figi,
    "v_mapping": v_mapping,
    "v_log": v_log,
}
