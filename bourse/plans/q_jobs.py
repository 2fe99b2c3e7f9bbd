"""Registered queries for SURVEY 2.16 (end-to-end jobs and read views)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ntz_lit
from ..operators import filters as FL
from ..session import scratch_path
from ..sinks import writers as WR
from . import jobs as J
from .both import ctes, frame, key_cte
from .docs import v_doc
from .fixtures import QUOTE_AS_OF, table, v_log, v_mapping, v_quote, v_security, with_views
from .q_relational import SECURITY_FILTERS, _CHOICES
from .q_timeseries import PERFORMANCE_ASOF_SQL
from .registry import ORACLE, register

_AT = _dt.datetime(2024, 1, 31, 6, 0)
_AT_SQL = "TIMESTAMP '2024-01-31 06:00:00'"


# ------------------------------------------------------------ job_exchange

@register("job_exchange", f"""
SELECT 'X' || CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, 'R' || CAST(n_regionkey AS VARCHAR) AS operating_mic,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'USD' END AS currency,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 'C' || CAST(n_nationkey AS VARCHAR) END AS country,
       {_AT_SQL} AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM nation""")
def q_job_exchange(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    src = n.select(F.col("n_name").alias("Name"), F.concat(F.lit("X"), k.cast("string")).alias("Code"),
                   F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("OperatingMIC"),
                   F.when(k % 4 == 0, F.lit("Unknown")).otherwise(F.lit("USD")).alias("Currency"),
                   F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), k.cast("string"))).alias("CountryISO2"))
    path = scratch_path(spark, "exchange-json")
    WR.write_json_arrays(src, path, rows_per_file=10, key="Code")
    return J.job_exchange(spark, path, _AT)


# ------------------------------------------------------------ job_security

def _sec_raw(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(k.cast("string").alias("Code"), F.col("p_name").alias("Name"),
                    F.when(k % 5 != 0, F.concat(F.lit("IS"), k.cast("string"))).alias("Isin"),
                    F.lit("US").alias("Country"), F.lit("USD").alias("Currency"),
                    F.replace(F.col("p_brand"), F.lit("#"), F.lit(" ")).alias("Exchange"),
                    F.when(F.col("p_size") % 3 == 0, F.lit("Common Stock")).when(F.col("p_size") % 3 == 1, F.lit("ETF"))
                    .otherwise(F.col("p_type")).alias("Type"),
                    F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("no"))


@register("job_security", """
SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name,
       CASE WHEN regexp_extract(p_brand, '(\\d+)$', 1)::INTEGER % 2 = 0 AND p_partkey % 5 <> 0
            THEN 'IS' || CAST(p_partkey AS VARCHAR) END AS isin,
       'US' AS country, 'USD' AS currency, replace(p_brand, '#', '_') AS exchange_code,
       replace(lower(CASE WHEN p_size % 3 = 0 THEN 'Common Stock' WHEN p_size % 3 = 1 THEN 'ETF' ELSE p_type END),
               ' ', '_') AS type
FROM part WHERE regexp_extract(p_brand, '(\\d+)$', 1)::INTEGER <= 20""")
def q_job_security(spark, sf_dir):
    raw = _sec_raw(spark, sf_dir)
    a, b = scratch_path(spark, "sec-a"), scratch_path(spark, "sec-b")
    cols = ["Code", "Name", "Isin", "Country", "Currency", "Exchange", "Type"]
    WR.write_format(raw.where(F.col("no") % 2 == 0).select(*cols), a, "csv")          # layout with ISIN
    WR.write_format(raw.where(F.col("no") % 2 == 1).select(*[c for c in cols if c != "Isin"]), b, "csv")
    known = table(spark, sf_dir, "part").select(
        F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")).alias("code"),
        F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("no")).where(F.col("no") <= 20).select("code")
    return J.job_security(spark, [a, b], known)


# ------------------------------------------------------------ quotes

_NQ = "date, security_code, exchange_code, open, high, low, close, adjusted_close, volume, year"
_RAW_HIST = T.StructType([
    T.StructField("Date", T.DateType()), T.StructField("security", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ["Open", "High", "Low", "Close", "Adjusted_close", "Volume"]],
    T.StructField("exchange", T.StringType())])


def _norm_quotes(spark, d):
    q = v_quote(spark, d)
    return q.select("date", "security_code", "exchange_code", "open", "high", "low", "close", "adjusted_close",
                    "volume", F.year("date").alias("year"))


# Curated securities of the quoted keys, and the composite codes: the vendor is
# asked for exchange O as US, and lists its bulk quotes as two files.
_SECURITIES = """
SELECT DISTINCT l_linestatus AS exchange_code, CAST(l_partkey AS STRING) AS code, lower(p_type) AS type
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
_COMPOSITE = "SELECT DISTINCT l_linestatus AS source_value, 'US' AS mapping_value FROM {lineitem} WHERE l_linestatus = 'O'"
_FILES = """
SELECT DISTINCT 'OA' AS source_value, l_linestatus AS mapping_value FROM {lineitem} WHERE l_linestatus = 'O'
UNION ALL SELECT DISTINCT 'OB', l_linestatus FROM {lineitem} WHERE l_linestatus = 'O'"""
_EXCHANGES, _TYPES = ["O", "F"], ["small", "large", "promo"]
_YEAR = _NQ.replace("year", "CAST(year(date) AS INTEGER) AS year")


def _append(spark, target, rows_of):
    """The curated table as a partitioned folder, before and after the job's
    new rows are appended."""
    path = scratch_path(spark, "quote-table")
    WR.write_partitioned(target, path, J.QUOTE_PARTITIONS)
    WR.append_table(rows_of(spark.read.parquet(path).select(*target.columns)), path, J.QUOTE_PARTITIONS)
    return spark.read.parquet(path).select(*target.columns)


@register("job_quote_requests", with_views("""
SELECT s.exchange_code, s.code, s.type, COALESCE(c.mapping_value, s.exchange_code) AS api_exchange_code,
       s.code || '.' || COALESCE(c.mapping_value, s.exchange_code) AS request
FROM s LEFT JOIN c ON c.source_value = s.exchange_code WHERE s.type IN ('small', 'large', 'promo')""",
                                           extra=ctes(s=_SECURITIES, c=_COMPOSITE)))
def q_job_quote_requests(spark, sf_dir):
    return J.quote_requests(frame(spark, sf_dir, _SECURITIES), frame(spark, sf_dir, _COMPOSITE), _EXCHANGES, _TYPES)


@register("job_quote_historical", with_views(f"""
SELECT {_YEAR} FROM v_quote WHERE date < DATE '1998-01-01' OR (date < DATE '2001-06-30' AND security_code IN
  (SELECT code FROM s WHERE type IN ('small', 'large', 'promo')))""", "v_quote", extra=ctes(s=_SECURITIES)))
def q_job_quote_historical(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    raw = q.select(F.col("date").alias("Date"), F.col("security_code").alias("security"),
                   F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
                   F.col("close").alias("Close"), F.col("adjusted_close").alias("Adjusted_close"),
                   F.col("volume").cast("double").alias("Volume"), F.col("exchange_code").alias("exchange"))
    path = scratch_path(spark, "quote-history")
    raw.write.mode("overwrite").partitionBy("exchange").option("header", True).csv(path)   # exchange=X/ folders
    target = _norm_quotes(spark, sf_dir).where(F.col("date") < F.lit(_dt.date(1998, 1, 1)))
    return _append(spark, target, lambda cur: J.job_quote_historical(
        spark, path, _RAW_HIST, cur, QUOTE_AS_OF, frame(spark, sf_dir, _SECURITIES), frame(spark, sf_dir, _COMPOSITE),
        _EXCHANGES, _TYPES))


_RAW_BULK = T.StructType([
    T.StructField("Date", T.DateType()), T.StructField("Code", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ["Open", "High", "Low", "Close", "Adjusted_close", "Volume"]],
    T.StructField("exchange", T.StringType())])


@register("job_quote_update", with_views(f"""
SELECT {_YEAR} FROM v_quote WHERE date < DATE '2001-06-01'
UNION ALL
SELECT {_YEAR.replace("exchange_code", "CASE WHEN exchange_code <> 'O' THEN exchange_code WHEN CAST(security_code AS BIGINT) % 2 = 0 THEN 'OA' ELSE 'OB' END AS exchange_code")}
FROM v_quote JOIN (SELECT exchange_code AS x, max(date) AS last FROM v_quote WHERE date < DATE '2001-06-01' GROUP BY 1) l ON x = exchange_code
WHERE date > last AND date < DATE '2001-07-01'""", "v_quote"))
def q_job_quote_update(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    quotes = _norm_quotes(spark, sf_dir).where(F.col("date") < F.lit(_dt.date(2001, 6, 1)))
    file = F.when(F.col("exchange_code") != "O", F.col("exchange_code")) \
        .when(F.col("security_code").cast("bigint") % 2 == 0, "OA").otherwise("OB")
    bulk = q.where(F.col("date") >= F.lit(_dt.date(2001, 5, 15))).select(
        F.col("date").alias("Date"), F.col("security_code").alias("Code"), file.alias("exchange"),
        F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.col("close").alias("Close"), F.col("adjusted_close").alias("Adjusted_close"),
        F.col("volume").cast("double").alias("Volume"))
    path = scratch_path(spark, "quote-bulk")
    bulk.write.mode("overwrite").partitionBy("exchange").option("header", True).csv(path)
    return _append(spark, quotes, lambda cur: J.job_quote_update(
        spark, path, _RAW_BULK, cur, frame(spark, sf_dir, _FILES), _dt.date(2001, 7, 1)))


@register("job_quote_performance", PERFORMANCE_ASOF_SQL)
def q_job_quote_performance(spark, sf_dir):
    path = scratch_path(spark, "security-quote")
    WR.write_partitioned(_norm_quotes(spark, sf_dir), path, ["exchange_code", "year"])   # curated table
    quotes = spark.read.parquet(path)
    return J.job_quote_performance(quotes, QUOTE_AS_OF)


# ------------------------------------------------------------ fundamentals

_FUND_KEYS = ["fund_general", "fund_listing", "fund_people", "fund_balance_sheet", "fund_income_statement",
              "fund_cash_flow", "fund_outstanding_shares", "fund_earning_history", "fund_earning_trend",
              "fund_earning_per_share", "fund_highlight", "fund_valuation", "fund_share_stat", "fund_technical",
              "fund_dividend", "fund_share_split"]


def _fund_union_sql(where: str = "") -> str:
    from . import q_nested  # noqa: F401  (registers the category oracles)
    parts = [f"SELECT * FROM ({ORACLE[k]})" for k in _FUND_KEYS]
    body = "\nUNION ALL BY NAME\n".join(parts)
    return f"SELECT * FROM ({body}) {where}"


@register("job_fundamental", _fund_union_sql())
def q_job_fundamental(spark, sf_dir):
    return J.job_fundamental(v_doc(spark, sf_dir))[0]


@register("job_fundamental_rejects", """
SELECT CAST(o_orderkey AS VARCHAR) AS code, CASE WHEN o_orderkey % 5 = 0 THEN 'cut' ELSE 'no General' END AS fault FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0""")
def q_job_fundamental_rejects(spark, sf_dir):
    """Cut-off documents and documents without their General part come back.
    Their code is read from the undamaged text, of the rejected ones only; the
    cut takes the two bytes of the closing braces."""
    key, whole = F.col("doc_id"), F.col("whole")
    docs = v_doc(spark, sf_dir).select(key, F.col("doc_text").alias("whole"))
    cut = F.substring(whole.cast("binary"), F.lit(1), F.octet_length(whole) - 2).cast("string")
    text = F.when(key % 5 == 0, cut).when(key % 7 == 0, F.replace(whole, F.lit('"General"'), F.lit('"Other"')))
    docs = docs.withColumn("doc_text", F.coalesce(text, whole))
    _, rejects = J.job_fundamental(docs)
    return rejects.select(F.get_json_object("whole", "$.General.Code").alias("code"),
                          F.when(F.col("doc_text").contains('"General"'), "cut").otherwise("no General").alias("fault"))


_LISTED = """
SELECT o_orderpriority AS exchange_code, CAST(o_orderkey AS STRING) AS code,
       CASE WHEN o_orderstatus = 'F' THEN 'common_stock' ELSE 'other' END AS type FROM {orders}"""
_NO_COMPOSITE = "SELECT o_orderpriority AS source_value, o_orderpriority AS mapping_value FROM {orders} WHERE o_orderkey < 0"


@register("job_fundamental_groups", _fund_union_sql(
    "WHERE exchange_code IN ('1-URGENT', '3-MEDIUM') AND security_code IN "
    "(SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')"))
def q_job_fundamental_groups(spark, sf_dir):
    """Two groups: their documents are parsed once, the table is written by
    exchange."""
    path = scratch_path(spark, "fundamental")
    listed, composite = frame(spark, sf_dir, _LISTED), frame(spark, sf_dir, _NO_COMPOSITE)
    requested = J.quote_requests(listed, composite, ["1-URGENT", "3-MEDIUM"], ["common_stock"])
    rows, _ = J.job_fundamental(v_doc(spark, sf_dir), requested=requested)
    WR.overwrite_table(rows, path, ["exchange_code"], "dynamic")
    return spark.read.parquet(path).select(*rows.columns)


@register("job_index_member", """
SELECT CAST(l_partkey AS VARCHAR) AS security_code, 'Part ' || CAST(l_partkey AS VARCHAR) AS security_name,
       l_linestatus AS exchange_code, o_orderstatus AS country, 'USD' AS currency,
       CAST(o_orderkey AS VARCHAR) AS index_code, 'Order ' || CAST(o_orderkey AS VARCHAR) AS index_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'O'""")
def q_job_index_member(spark, sf_dir):
    # the index list: the orders whose documents are index documents
    indices = table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("string").alias("code"))
    members, _rejects = J.job_index_member(v_doc(spark, sf_dir), indices)
    return members


@register("job_index", with_views("""
SELECT code, name, NULLIF(NULLIF(currency, 'Unknown'), '') AS currency, isin FROM v_security
WHERE exchange_code = 'Brand#1'""", "v_security"))
def q_job_index(spark, sf_dir):
    return J.job_index(v_security(spark, sf_dir), "Brand#1")


# ------------------------------------------------------------ entities

_C = "CAST(c_custkey AS STRING)"
_DAY = "lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0')"
_ENTITY_VALUES = {
    "lei": "c_name", "name": "c_name || ' \"A, B\"'", "legal_form_id": "'LF' || CAST(c_custkey % 5 AS STRING)",
    "jurisdiction": "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE n_name END", "legal_address_street": f"'Street ' || {_C}",
    "legal_address_street_number": "CAST(c_custkey % 90 AS STRING)", "legal_address_zip_code": f"lpad({_C}, 8, '0')",
    "legal_address_city": "'City ' || CAST(c_custkey % 40 AS STRING)", "legal_address_country": "n_name",
    "headquarter_address_street": f"'Road ' || {_C}", "headquarter_address_street_number": "CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '1' END",
    "headquarter_address_city": "'Town ' || CAST(c_custkey % 30 AS STRING)", "headquarter_address_zip_code": f"lpad({_C}, 6, '9')",
    "headquarter_address_country": "n_name", "status": "c_mktsegment", "creation_date": f"'2001-01-' || {_DAY}",
    "expiration_date": f"CASE WHEN c_custkey % 4 = 0 THEN '2020-02-' || {_DAY} ELSE '' END",
    "expiration_reason": "CASE WHEN c_custkey % 4 = 0 THEN 'MERGED' ELSE '' END",
    "registration_date": f"'2002-03-' || {_DAY}", "registration_status": "CASE WHEN c_custkey % 2 = 0 THEN 'ISSUED' ELSE 'LAPSED' END"}
_ENTITY = ("SELECT " + ", ".join(f"{v} AS {k}" for k, v in _ENTITY_VALUES.items())
           + " FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey")


@register("job_entity", with_views("SELECT " + ", ".join(f"nullif({k}, '') AS {k}" for k in _ENTITY_VALUES) + " FROM e",
                                   extra=ctes(e=_ENTITY)))
def q_job_entity(spark, sf_dir):
    e = frame(spark, sf_dir, _ENTITY)
    e = e.select(*[F.col(dst).alias(src) for src, dst in J.ENTITY_COLUMNS.items()])
    folder = scratch_path(spark, "lei")
    e.write.option("header", True).option("escape", '"').csv(folder)   # quotes doubled, as vendors write them
    return J.job_entity(spark, folder)


_ISIN_KEYS = "SELECT DISTINCT 'IS' || CAST(o_custkey AS STRING) AS uid, o_custkey AS surrogate_key FROM {orders} WHERE o_custkey % 2 = 0"
_ENTITY_KEYS = "SELECT c_name AS uid, c_custkey AS surrogate_key FROM {customer} WHERE c_custkey % 10 <> 3"
_PAIRS = """
SELECT c_name AS lei, 'IS' || CAST(o_custkey AS STRING) AS isin FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""


@register("job_entity_isin", with_views(f"""
SELECT DISTINCT p.lei, p.isin, k.surrogate_key AS id, e.surrogate_key AS entity_id, {_AT_SQL} AS created_at,
       CAST(NULL AS TIMESTAMP) AS updated_at
FROM p JOIN keys k ON k.uid = p.isin JOIN e ON e.uid = p.lei""", extra=ctes(p=_PAIRS, known=_ISIN_KEYS, e=_ENTITY_KEYS)
    | {"keys": key_cte("known", "p", "isin")}))
def q_job_entity_isin(spark, sf_dir):
    pairs = frame(spark, sf_dir, _PAIRS).select(F.col("lei").alias("LEI"), F.col("isin").alias("ISIN"))
    folder = scratch_path(spark, "lei-isin")
    WR.write_format(pairs, folder, "csv")
    out, _new = J.job_entity_isin(spark, folder, frame(spark, sf_dir, _ISIN_KEYS), frame(spark, sf_dir, _ENTITY_KEYS), _AT)
    return out


# ------------------------------------------------------------ exchange merge

def _merge_sources(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    iso = n.select(F.col("n_name").alias("uid"), F.col("n_name").alias("mic"), F.col("n_name").alias("name"),
                   F.concat(F.when(k % 6 == 5, "OP_").otherwise("NATION_"), F.col("n_regionkey").cast("string"))
                   .alias("operating_mic"),
                   F.when(k % 7 == 0, F.lit("Unknown")).otherwise(F.concat(F.lit("C"), F.col("n_regionkey")
                                                                            .cast("string"))).alias("country"))
    eod = n.where(k % 2 == 0).select(F.col("n_name").alias("uid"), F.lower("n_name").alias("name"),
                                      F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("E")).alias("country"))
    msk = n.where(k % 3 == 0).select(F.col("n_name").alias("uid"), F.concat(F.lit("msk "), F.col("n_name")).alias("name"))
    return {"iso": iso, "eod": eod, "msk": msk}


_MERGE_CTE = {
    "iso": "SELECT n_name AS uid, n_name AS mic, n_name AS name, CASE WHEN n_nationkey % 6 = 5 THEN 'OP_' ELSE 'NATION_' END "
           "|| CAST(n_regionkey AS VARCHAR) AS operating_mic, CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE 'C' || CAST(n_regionkey AS VARCHAR) END "
           "AS country FROM nation",
    "eod": "SELECT n_name AS uid, lower(n_name) AS name, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'E' END "
           "AS country FROM nation WHERE n_nationkey % 2 = 0",
    "msk": "SELECT n_name AS uid, 'msk ' || n_name AS name FROM nation WHERE n_nationkey % 3 = 0",
    "m": "SELECT iso.uid, iso.mic, COALESCE(msk.name, eod.name, iso.name) AS name, iso.operating_mic, "
         "COALESCE(eod.country, iso.country) AS country FROM iso LEFT JOIN eod ON iso.uid = eod.uid "
         "LEFT JOIN msk ON iso.uid = msk.uid",
    "known": "SELECT n_name AS uid, CAST(n_nationkey AS BIGINT) AS surrogate_key FROM nation WHERE n_nationkey % 2 = 0",
    "codes": "SELECT mic AS code FROM m UNION ALL SELECT operating_mic FROM m",
    "keys": key_cte("known", "codes", "code"),
    "merged": "SELECT m.uid, m.mic, m.name, m.operating_mic, m.country, k.surrogate_key AS id, CASE WHEN ok.surrogate_key = "
              "k.surrogate_key THEN NULL ELSE ok.surrogate_key END AS operating_exchange_id FROM m JOIN keys k ON m.mic = k.uid "
              "LEFT JOIN keys ok ON m.operating_mic = ok.uid",
}
_MERGE_SQL = with_views("SELECT * FROM merged", extra=_MERGE_CTE)
_PRECEDENCE = {"mic": ["iso"], "name": ["msk", "eod", "iso"], "operating_mic": ["iso"], "country": ["eod", "iso"]}


def _exchange_keys(spark, d):
    return table(spark, d, "nation").where(F.col("n_nationkey") % 2 == 0).select(
        F.col("n_name").alias("uid"), F.col("n_nationkey").cast("bigint").alias("surrogate_key"))


@register("job_exchange_merge", _MERGE_SQL)
def q_job_exchange_merge(spark, sf_dir):
    out = J.job_exchange_merge(_merge_sources(spark, sf_dir), _PRECEDENCE, _exchange_keys(spark, sf_dir), None, _AT,
                               ["mic", "name"])
    return out.select("uid", "mic", "name", "operating_mic", "country", "id", "operating_exchange_id")


# The current table: the known exchanges under an older name, and some that are gone.
_CURRENT = """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS mic, 'old ' || n_name AS name FROM {nation} WHERE n_nationkey % 2 = 0
UNION ALL SELECT CAST(r_regionkey AS BIGINT) + 1000, 'GONE', r_name FROM {region}"""
_OLD = _dt.datetime(2020, 1, 1)


@register("job_exchange_snapshot", with_views(f"""
SELECT COALESCE(s.id, c.id) AS id, CASE WHEN s.id IS NULL THEN c.mic ELSE s.mic END AS mic,
       CASE WHEN s.id IS NULL THEN c.name ELSE s.name END AS name, s.operating_exchange_id, s.id IS NOT NULL AS is_active,
       CASE WHEN c.id IS NULL THEN {_AT_SQL} ELSE TIMESTAMP '2020-01-01 00:00:00' END AS active_from,
       CASE WHEN s.id IS NULL THEN {_AT_SQL} END AS active_until,
       CASE WHEN c.id IS NULL THEN {_AT_SQL} ELSE TIMESTAMP '2020-01-01 00:00:00' END AS created_at,
       CASE WHEN c.id IS NOT NULL THEN {_AT_SQL} END AS updated_at
FROM merged s FULL JOIN c ON c.id = s.id""", extra=_MERGE_CTE | ctes(c=_CURRENT)))
def q_job_exchange_snapshot(spark, sf_dir):
    old, none = ntz_lit(_OLD), F.lit(None).cast("timestamp_ntz")
    cur = frame(spark, sf_dir, _CURRENT).select(
        "id", "mic", "name", F.lit(None).cast("bigint").alias("operating_exchange_id"), F.lit(True).alias("is_active"),
        old.alias("active_from"), none.alias("active_until"), old.alias("created_at"), none.alias("updated_at"))
    return J.job_exchange_merge(_merge_sources(spark, sf_dir), _PRECEDENCE, _exchange_keys(spark, sf_dir), cur, _AT,
                                ["mic", "name", "operating_exchange_id"])


# ------------------------------------------------------------ exchange detail

def _detail_docs(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    doc = F.struct(
        F.col("n_name").alias("Code"), F.lower("n_name").alias("Name"),
        F.concat(F.lit("NATION_"), ((k + 1) % 25).cast("string")).alias("Country"), F.lit("USD").alias("Currency"),
        F.concat(F.lit("Zone/"), F.col("n_regionkey").cast("string")).alias("Timezone"), (k * 10).alias("ActiveTickers"),
        (k * 9).alias("UpdatedTickers"), (k * 8).alias("PreviousDayUpdatedTickers"),
        F.struct(F.format_string("%02d:30:00", F.lit(8) + k % 3).alias("Open"),
                 F.format_string("%02d:00:00", F.lit(16) + k % 2).alias("Close"),
                 F.format_string("%02d:30:00", F.lit(13) + k % 3).alias("OpenUTC"),
                 F.format_string("%02d:00:00", F.lit(21) + k % 2).alias("CloseUTC"),
                 F.when(k % 2 == 0, F.lit("Mon,Tue,Wed,Thu,Fri")).otherwise(F.lit("Sun,Mon,Tue,Wed,Thu"))
                 .alias("WorkingDays")).alias("TradingHours"),
        F.create_map(F.lit("0"), F.struct(F.lit("New Year").alias("Holiday"), F.lit("official").alias("Type"),
                                          F.lit("2024-01-01").alias("Date")),
                     F.lit("1"), F.struct(F.concat(F.lit("Day "), k.cast("string")).alias("Holiday"),
                                          F.lit("bank").alias("Type"),
                                          F.date_format(F.date_add(F.lit(_dt.date(2024, 2, 1)), k), "yyyy-MM-dd")
                                          .alias("Date"))).alias("ExchangeHolidays"))
    return n.select(F.to_json(doc).alias("t"))


_EXM = ("SELECT source_value, mapping_value FROM v_mapping WHERE product = 'exchange' AND source = 'vendor' "
        "AND field = 'mic' AND is_active")


_HOLIDAY_MAP = "SELECT 'official' AS source_value, CAST(count(*) AS STRING) AS mapping_value FROM {region}"
_DETAIL_CTE = {"m": _EXM} | ctes(h=_HOLIDAY_MAP)


def _detail(spark, d):
    from ..operators.lookup import mapping_slice
    m = mapping_slice(v_mapping(spark, d), "exchange", "vendor", "mic")
    return J.job_exchange_detail(_detail_docs(spark, d), "t", m, m, frame(spark, d, _HOLIDAY_MAP))


@register("job_exchange_detail", with_views("""
SELECT m.mapping_value AS exchange_uid, n_name AS exchange_source_code, lower(n_name) AS exchange_name,
       c.mapping_value AS country, 'USD' AS currency, 'Zone/' || n_regionkey AS timezone,
       printf('%02d:30:00', 8 + n_nationkey % 3) AS open, printf('%02d:00:00', 16 + n_nationkey % 2) AS close,
       printf('%02d:30:00', 13 + n_nationkey % 3) AS open_utc, printf('%02d:00:00', 21 + n_nationkey % 2) AS close_utc,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Mon|Tue|Wed|Thu|Fri' ELSE 'Sun|Mon|Tue|Wed|Thu' END AS working_days,
       CAST(n_nationkey * 10 AS BIGINT) AS active_tickers, CAST(n_nationkey * 9 AS BIGINT) AS updated_tickers,
       CAST(n_nationkey * 8 AS BIGINT) AS previous_day_updated_tickers
FROM nation LEFT JOIN m ON n_name = m.source_value
LEFT JOIN m c ON c.source_value = 'NATION_' || CAST((n_nationkey + 1) % 25 AS VARCHAR)""", "v_mapping", extra=_DETAIL_CTE))
def q_job_exchange_detail(spark, sf_dir):
    det = _detail(spark, sf_dir)[0]
    th = F.col("trading_hours")
    times = [F.date_format(th[c], "HH:mm:ss").alias(c) for c in ("open", "close", "open_utc", "close_utc")]
    return det.select(*[c for c in det.columns if c not in ("trading_hours", "working_days")], *times,
                      F.array_join("working_days", "|").alias("working_days"))


@register("job_exchange_holiday", with_views("""
SELECT n_name AS exchange_source_code, m.mapping_value AS exchange_uid, d.name AS holiday_name, d.type AS holiday_type,
       h.mapping_value AS holiday_type_id, d.date
FROM nation, LATERAL (SELECT 'New Year' AS name, 'official' AS type, DATE '2024-01-01' AS date UNION ALL
  SELECT 'Day ' || CAST(n_nationkey AS VARCHAR), 'bank', CAST(DATE '2024-02-01' + n_nationkey AS DATE)) d
LEFT JOIN m ON n_name = m.source_value LEFT JOIN h ON h.source_value = d.type""", "v_mapping", extra=_DETAIL_CTE))
def q_job_exchange_holiday(spark, sf_dir):
    """Written by exchange and read again."""
    hol = _detail(spark, sf_dir)[1]
    path = scratch_path(spark, "holiday")
    WR.write_partitioned(hol, path, ["exchange_uid"])
    return spark.read.parquet(path).select(*hol.columns)


# ------------------------------------------------------------ legacy quotes

_LISTINGS = """
SELECT DISTINCT l_partkey * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS id, 'M' || l_linestatus AS mic,
       CASE WHEN l_partkey % 11 <> 0 THEN CAST(l_partkey AS STRING) END AS ticker,
       CASE WHEN l_partkey % 3 <> 0 THEN 'vendor' END AS quote_source FROM {lineitem}"""
_MIC_MAP = "SELECT DISTINCT l_linestatus AS source_value, 'M' || l_linestatus AS mapping_value FROM {lineitem} WHERE l_linestatus = 'O'"
_LEG_CTE = ctes(l=_LISTINGS, m=_MIC_MAP)


@register("job_quote_legacy", with_views("""
SELECT l.id AS security_listing_id, strftime(CAST(q.date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date,
       q.open, q.high, q.low, q.close, q.adjusted_close AS adj_close, q.volume, CAST(1 AS BIGINT) AS interval_id
FROM l JOIN m ON m.mapping_value = l.mic JOIN v_quote q ON q.security_code = l.ticker AND q.exchange_code = m.source_value
WHERE l.quote_source = 'vendor'""", "v_quote", extra=_LEG_CTE))
def q_job_quote_legacy(spark, sf_dir):
    listings, mics, q = frame(spark, sf_dir, _LISTINGS), frame(spark, sf_dir, _MIC_MAP), v_quote(spark, sf_dir)
    path, columns = scratch_path(spark, "legacy-quotes"), ("security_listing_id bigint, date string, open double, high double, low double, "
                                                           "close double, adj_close double, volume bigint, interval_id bigint")
    # what the first run finds is the table that the second one appends to
    early, _ = J.job_quote_legacy(listings, mics, q.where(F.col("date") < F.lit(_dt.date(1998, 1, 1))), spark.createDataFrame([], columns), "vendor")
    WR.append_table(early, path)
    WR.append_table(J.job_quote_legacy(listings, mics, q, spark.read.schema(columns).parquet(path), "vendor")[0], path)
    return spark.read.schema(columns).parquet(path)


@register("job_quote_legacy_rejects", with_views("""
SELECT l.id, l.mic, l.ticker FROM l LEFT JOIN m ON m.mapping_value = l.mic
WHERE l.quote_source = 'vendor' AND (m.source_value IS NULL OR l.ticker IS NULL)""", extra=_LEG_CTE))
def q_job_quote_legacy_rejects(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    target = q.select(F.lit(0).cast("bigint").alias("security_listing_id"), F.lit("").alias("date"), "open", "high", "low", "close",
                      F.col("close").alias("adj_close"), "volume", F.lit(1).cast("bigint").alias("interval_id"))
    _table, rejects = J.job_quote_legacy(frame(spark, sf_dir, _LISTINGS), frame(spark, sf_dir, _MIC_MAP), q, target, "vendor")
    return rejects.select("id", "mic", "ticker")


# ------------------------------------------------------------ read views

_SEC = "code, name, type, exchange_code, isin, currency, id, size"


@register("view_security_list", with_views(f"""
SELECT {_SEC} FROM v_security WHERE type IN ('SMALL', 'PROMO') AND isin IS NULL
ORDER BY size DESC, id LIMIT 25 OFFSET 25""", "v_security"))
def q_view_security_list(spark, sf_dir):
    return J.view_list(v_security(spark, sf_dir), {"type": ["SMALL", "PROMO"], "isin": "NULL"}, SECURITY_FILTERS,
                       page=2, page_size=25, order=[("size", "DESC")], unique_key="id", search_cols=["name"])


@register("view_security_count", with_views("""
SELECT count(*) AS count FROM v_security WHERE type IN ('SMALL', 'PROMO') AND isin IS NULL""", "v_security"))
def q_view_security_count(spark, sf_dir):
    return J.view_count(v_security(spark, sf_dir), {"type": ["SMALL", "PROMO"], "isin": "NULL"}, SECURITY_FILTERS)


@register("view_security_choices", with_views("""
SELECT CASE WHEN isin IS NULL THEN 'NULL' ELSE 'NOT_NULL' END AS key, count(*) AS count
FROM v_security WHERE type IN ('SMALL', 'PROMO') GROUP BY 1""", "v_security"))
def q_view_security_choices(spark, sf_dir):
    return J.view_choices(v_security(spark, sf_dir), "isin", _CHOICES, {"type": ["SMALL", "PROMO"]},
                          SECURITY_FILTERS)


_LOG_COLS = "id, created, level, service, event, message, user_id, value"


@register("view_logs", with_views(f"""
SELECT {_LOG_COLS} FROM v_log WHERE level IN ('ERROR', 'PURCHASE') ORDER BY created DESC, id LIMIT 25 OFFSET 50""",
                                  "v_log"))
def q_view_logs(spark, sf_dir):
    logs = FL.log_filter(v_log(spark, sf_dir), {"level": ["ERROR", "PURCHASE"], "page": 3, "pageSize": 25})
    return FL.sort_skip_limit(logs, page=3, page_size=25)


@register("view_logs_count", with_views("""
SELECT count(*) AS count FROM v_log WHERE service = 'S3'""", "v_log"))
def q_view_logs_count(spark, sf_dir):
    return FL.log_filter(v_log(spark, sf_dir), {"service": "S3"}).agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------ late oracles
# fund_all is registered with the nested queries; its oracle is the union of
# the sixteen category oracles.
ORACLE["fund_all"] = _fund_union_sql()
