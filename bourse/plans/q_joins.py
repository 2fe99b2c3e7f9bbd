"""Registered queries for SURVEY 2.4 (joins)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import lookup as L
from ..operators import timeseries as ts
from .dates import lit
from .fixtures import (QUOTE_AS_OF, table, v_exchange, v_figi, v_listing, v_mapping, v_quote, v_security,
                       with_views)
from .registry import register

_SEC_MAP_SQL = ("SELECT source_value, mapping_value FROM v_mapping WHERE product = 'security' "
                "AND source = 'vendor' AND field = 'exchange_code' AND is_active")
_EXC_MAP_SQL = ("SELECT source_value, mapping_value FROM v_mapping WHERE product = 'exchange' "
                "AND source = 'vendor' AND field = 'mic' AND is_active")


def _sec_map(spark, d):
    return L.mapping_slice(v_mapping(spark, d), "security", "vendor", "exchange_code")


def _exc_map(spark, d):
    return L.mapping_slice(v_mapping(spark, d), "exchange", "vendor", "mic")


@register("lookup_join", with_views("""
SELECT s.code, COALESCE(m.mapping_value, s.exchange_code) AS exchange_code
FROM v_security s LEFT JOIN m ON s.exchange_code = m.source_value""", "v_security", "v_mapping",
                                    extra={"m": _SEC_MAP_SQL}))
def q_lookup_join(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "exchange_code")
    return L.lookup_join(s, _sec_map(spark, sf_dir), "exchange_code")


@register("reverse_lookup_join", with_views("""
SELECT c.exchange_code, COALESCE(m.source_value, c.exchange_code) AS source_exchange_code
FROM (SELECT DISTINCT COALESCE(m.mapping_value, s.exchange_code) AS exchange_code
      FROM v_security s LEFT JOIN m ON s.exchange_code = m.source_value) c
LEFT JOIN (SELECT DISTINCT source_value, mapping_value FROM m WHERE mapping_value IS NOT NULL) m
  ON c.exchange_code = m.mapping_value""", "v_security", "v_mapping", extra={"m": _SEC_MAP_SQL}))
def q_reverse_lookup_join(spark, sf_dir):
    m = _sec_map(spark, sf_dir)
    codes = L.lookup_join(v_security(spark, sf_dir).select("exchange_code"), m, "exchange_code").distinct()
    return L.reverse_lookup_join(codes, m, "exchange_code", "source_exchange_code")


@register("multi_lookup_join", with_views("""
SELECT e.id, COALESCE(m1.mapping_value, e.mic) AS mic, COALESCE(m2.mapping_value, e.name) AS name_code,
       COALESCE(m3.mapping_value, e.name) AS region_code
FROM v_exchange e LEFT JOIN m m1 ON e.mic = m1.source_value
LEFT JOIN m m2 ON e.name = m2.source_value
LEFT JOIN (SELECT r_name AS source_value, 'R' || CAST(r_regionkey AS VARCHAR) AS mapping_value FROM region) m3
  ON e.name = m3.source_value""", "v_exchange", "v_mapping", extra={"m": _EXC_MAP_SQL}))
def q_multi_lookup_join(spark, sf_dir):
    e = v_exchange(spark, sf_dir).select("id", "mic", "name", F.col("name").alias("name_code"),
                                         F.col("name").alias("region_code"))
    m = _exc_map(spark, sf_dir)
    regions = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("source_value"),
        F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("mapping_value"))
    out = L.multi_lookup_join(e, [(m, "mic", "mic"), (m, "name_code", "name_code"), (regions, "region_code",
                                                                                        "region_code")])
    return out.drop("name")


# Three exchange sources derived from nation: the base (all nations), a second
# source for even keys and a third for multiples of three.
def _ex_sources(spark, d):
    n = table(spark, d, "nation")
    k = F.col("n_nationkey")
    iso = n.select(F.col("n_name").alias("uid"), F.col("n_name").alias("mic"), F.col("n_name").alias("name"),
                   F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("country"))
    eod = n.where(k % 2 == 0).select(F.col("n_name").alias("uid"), F.lower("n_name").alias("name"),
                                      F.concat(F.lit("E"), F.col("n_regionkey").cast("string")).alias("country"),
                                      (k % 4).cast("int").alias("is_virtual"))
    msk = n.where(k % 3 == 0).select(F.col("n_name").alias("uid"), F.concat(F.lit("msk "), F.col("n_name")).alias("name"),
                                      F.concat(F.lit("A"), k.cast("string")).alias("acronym"),
                                      F.lit(None).cast("int").alias("is_virtual"))
    return {"iso": iso, "eod": eod, "msk": msk}


_EX_SRC_SQL = {
    "iso": "SELECT n_name AS uid, n_name AS mic, n_name AS name, 'C' || CAST(n_regionkey AS VARCHAR) AS country "
           "FROM nation",
    "eod": "SELECT n_name AS uid, lower(n_name) AS name, 'E' || CAST(n_regionkey AS VARCHAR) AS country, "
           "CAST(n_nationkey % 4 AS INTEGER) AS is_virtual FROM nation WHERE n_nationkey % 2 = 0",
    "msk": "SELECT n_name AS uid, 'msk ' || n_name AS name, 'A' || CAST(n_nationkey AS VARCHAR) AS acronym, "
           "CAST(NULL AS INTEGER) AS is_virtual FROM nation WHERE n_nationkey % 3 = 0",
}


@register("precedence_merge", with_views("""
SELECT iso.uid, iso.mic, COALESCE(msk.name, eod.name, iso.name) AS name, msk.acronym AS acronym,
       COALESCE(eod.country, iso.country) AS country,
       COALESCE(CAST(COALESCE(eod.is_virtual, msk.is_virtual) AS INTEGER), 0) <> 0 AS is_virtual
FROM iso LEFT JOIN eod ON iso.uid = eod.uid LEFT JOIN msk ON iso.uid = msk.uid""", extra=_EX_SRC_SQL))
def q_precedence_merge(spark, sf_dir):
    src = _ex_sources(spark, sf_dir)
    return L.precedence_merge(src["iso"], src, "uid", {
        "mic": ["iso", "eod", "msk"],
        "name": ["msk", "eod", "iso"],
        "acronym": ["msk", "iso"],
        "country": ["msk", "eod", "iso"],
        "is_virtual": ["eod", "msk"],
    }, bool_cols=["is_virtual"])


@register("self_join_parent", with_views("""
SELECT e.id, e.mic, e.name, e.operating_exchange_id, p.mic AS operating_mic, p.name AS operating_name
FROM v_exchange e LEFT JOIN v_exchange p ON e.operating_exchange_id = p.id""", "v_exchange"))
def q_self_join_parent(spark, sf_dir):
    return L.self_join_parent(v_exchange(spark, sf_dir), "id", "operating_exchange_id", ["mic", "name"])


@register("detail_join", with_views("""
SELECT e.id, e.mic, d.n_suppliers, d.balance
FROM v_exchange e LEFT JOIN (SELECT CAST(s_nationkey AS BIGINT) + 100 AS id, count(*) AS n_suppliers,
                                    round(max(s_acctbal), 2) AS balance
                             FROM supplier GROUP BY s_nationkey) d ON e.id = d.id""", "v_exchange"))
def q_detail_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    d = s.groupBy((F.col("s_nationkey").cast("bigint") + 100).alias("id")).agg(
        F.count(F.lit(1)).alias("n_suppliers"), F.round(F.max("s_acctbal"), 2).alias("balance"))
    return v_exchange(spark, sf_dir).select("id", "mic").join(d, "id", "left")


@register("star_left_chain", with_views("""
SELECT l.security_id, l.exchange_id, p.p_name AS name, p.p_type AS type, s.s_name AS exchange_name,
       n.n_name AS country
FROM v_listing l LEFT JOIN part p ON l.security_id = p.p_partkey
LEFT JOIN supplier s ON l.exchange_id = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""", "v_listing"))
def q_star_left_chain(spark, sf_dir):
    l = v_listing(spark, sf_dir)
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("security_id"), F.col("p_name").alias("name"),
                                            F.col("p_type").alias("type"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("exchange_id"),
                                                F.col("s_name").alias("exchange_name"), "s_nationkey")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"),
                                              F.col("n_name").alias("country"))
    return (l.join(p, "security_id", "left").join(s, "exchange_id", "left").join(n, "s_nationkey", "left")
            .drop("s_nationkey"))


@register("left_join_not_null", """
SELECT c.c_custkey AS entity_id, c.c_name AS name, o.o_orderkey AS security_id, o.o_orderstatus AS status
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey WHERE o.o_orderkey IS NOT NULL""")
def q_left_join_not_null(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders")
    # written as the reference does; Catalyst turns it into an inner join
    j = c.join(o, o.o_custkey == c.c_custkey, "left").where(F.col("o_orderkey").isNotNull())
    return j.select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name"),
                    F.col("o_orderkey").alias("security_id"), F.col("o_orderstatus").alias("status"))


@register("inner_join_keys", with_views("""
SELECT a.security_code, a.exchange_code, a.first_date, b.last_date
FROM (SELECT security_code, exchange_code, min(date) AS first_date FROM v_quote GROUP BY ALL) a
JOIN (SELECT security_code, exchange_code, max(date) AS last_date FROM v_quote WHERE volume >= 20 GROUP BY ALL) b
  ON a.security_code = b.security_code AND a.exchange_code = b.exchange_code""", "v_quote"))
def q_inner_join_keys(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    a = q.groupBy(*ts.KEYS).agg(F.min("date").alias("first_date"))
    b = q.where(F.col("volume") >= 20).groupBy(*ts.KEYS).agg(F.max("date").alias("last_date"))
    return a.join(b, list(ts.KEYS), "inner")


_MTD = _dt.date(QUOTE_AS_OF.year, QUOTE_AS_OF.month, 1)


@register("cross_join", with_views(f"""
SELECT k.security_code, k.exchange_code, CAST(c.range AS DATE) AS date
FROM (SELECT DISTINCT security_code, exchange_code FROM v_quote) k
CROSS JOIN range({lit(_MTD)}, {lit(QUOTE_AS_OF)}, INTERVAL 1 DAY) c""", "v_quote"))
def q_cross_join(spark, sf_dir):
    keys = v_quote(spark, sf_dir).select(*ts.KEYS).distinct()
    return keys.select(*ts.KEYS, F.explode(ts._day_seq(F.lit(_MTD), F.lit(QUOTE_AS_OF))).alias("date"))


_DECADE = _dt.date(QUOTE_AS_OF.year - 10, QUOTE_AS_OF.month, QUOTE_AS_OF.day)


# Every key times every day of ten years, summed up per key and year: the rows
# themselves are keys times 3,652 days.
@register("cross_join_ten_years", with_views(f"""
SELECT k.security_code, k.exchange_code, CAST(year(c.range) AS INTEGER) AS year, count(*) AS n_days,
       CAST(min(c.range) AS DATE) AS first_day, CAST(max(c.range) AS DATE) AS last_day
FROM (SELECT DISTINCT security_code, exchange_code FROM v_quote) k
CROSS JOIN range({lit(_DECADE)}, {lit(QUOTE_AS_OF)}, INTERVAL 1 DAY) c GROUP BY ALL""", "v_quote"))
def q_cross_join_ten_years(spark, sf_dir):
    days = spark.range(1).select(F.explode(ts._day_seq(F.lit(_DECADE), F.lit(QUOTE_AS_OF))).alias("date"))
    return L.cross_join_agg(v_quote(spark, sf_dir).select(*ts.KEYS), days.select("date", F.year("date").alias("year")), ["year"],
                            [F.count("*").alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day")])


@register("interval_self_join", with_views("""
SELECT b.security_code, b.exchange_code, b.date, b.adjusted_close,
       CAST(b.date - INTERVAL 1 MONTH AS DATE) AS reference_date, r.adjusted_close AS reference_adjusted_close
FROM v_quote b LEFT JOIN v_quote r ON r.security_code = b.security_code AND r.exchange_code = b.exchange_code
 AND r.date = CAST(b.date - INTERVAL 1 MONTH AS DATE)""", "v_quote"))
def q_interval_self_join(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    return L.interval_self_join(q, ts.KEYS, "date", "adjusted_close", F.add_months(F.col("date"), -1))


@register("lateral_left_join", with_views("""
SELECT e.id, e.mic, e.name,
       CASE WHEN p.id IS NOT NULL
            THEN CAST(json_object('id', p.id, 'mic', p.mic, 'name', p.name) AS VARCHAR) END AS operating_exchange
FROM v_exchange e LEFT JOIN v_exchange p ON e.operating_exchange_id = p.id""", "v_exchange"))
def q_lateral_left_join(spark, sf_dir):
    e = v_exchange(spark, sf_dir)
    return L.lateral_parent_json(e, "id", "operating_exchange_id", ["id", "mic", "name"],
                                 "operating_exchange").select("id", "mic", "name", "operating_exchange")


@register("scalar_subquery_agg", with_views(f"""
SELECT k.security_code, k.exchange_code,
       COALESCE(CAST(a.quotes AS VARCHAR), '[]') AS quotes
FROM (SELECT DISTINCT security_code, exchange_code FROM v_quote) k
LEFT JOIN (SELECT security_code, exchange_code,
                  to_json(list({{'close': CAST(close AS VARCHAR), 'date': date}} ORDER BY date)) AS quotes
           FROM v_quote GROUP BY ALL) a
  ON k.security_code = a.security_code AND k.exchange_code = a.exchange_code""", "v_quote"))
def q_scalar_subquery_agg(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    keys = q.select(*ts.KEYS).distinct()
    quotes = q.select(*ts.KEYS, F.col("close").cast("string").alias("close"), "date")
    return L.scalar_subquery_agg(keys, quotes, list(ts.KEYS), ["close", "date"], "date", "quotes")


@register("scalar_subquery_agg_chunks", with_views("""
SELECT security_code, exchange_code, chunk, count(*) AS n, CAST(to_json(list({'close': close, 'date': date} ORDER BY date, close)) AS VARCHAR) AS quotes
FROM (SELECT security_code, exchange_code, CAST(close AS VARCHAR) AS close, date,
             (row_number() OVER (PARTITION BY security_code, exchange_code ORDER BY date, CAST(close AS VARCHAR)) - 1) // 4 AS chunk FROM v_quote) GROUP BY 1, 2, 3""", "v_quote"))
def q_scalar_subquery_agg_chunks(spark, sf_dir):
    """The children of a parent as numbered arrays of four rows."""
    quotes = v_quote(spark, sf_dir).select(*ts.KEYS, F.col("close").cast("string").alias("close"), "date")
    return L.child_chunks(quotes, list(ts.KEYS), ["close", "date"], "date", "quotes", size=4)


@register("anti_join_missing", with_views("""
SELECT s.code, s.isin FROM v_security s
WHERE NOT EXISTS (SELECT 1 FROM v_figi f WHERE f.ticker_source = s.code)""", "v_security", "v_figi"))
def q_anti_join_missing(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "isin")
    f = v_figi(spark, sf_dir).select(F.col("ticker_source").alias("code")).where(F.col("code").isNotNull())
    return L.anti_join_missing(s, f, "code")


_FIGI_COLS = ["figi", "composite_figi"]


@register("dual_key_union_join", with_views("""
SELECT s.code, s.isin, f.figi, f.composite_figi FROM v_security s
  LEFT JOIN (SELECT * FROM v_figi WHERE isin_source IS NOT NULL) f ON s.isin = f.isin_source
UNION
SELECT s.code, s.isin, f.figi, f.composite_figi FROM v_security s
  LEFT JOIN (SELECT * FROM v_figi WHERE ticker_source IS NOT NULL) f ON s.code = f.ticker_source""",
                                            "v_security", "v_figi"))
def q_dual_key_union_join(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "isin")
    return L.dual_key_union_join(s, v_figi(spark, sf_dir), "isin", "code", "isin_source", "ticker_source",
                                 _FIGI_COLS)


@register("fallback_match", with_views("""
SELECT s.code, s.isin, f.figi, f.composite_figi, 'isin' AS matched_by
FROM v_security s JOIN v_figi f ON s.isin = f.isin_source
UNION ALL
SELECT s.code, s.isin, f.figi, f.composite_figi, 'ticker'
FROM v_security s JOIN v_figi f ON s.code = f.ticker_source
WHERE NOT EXISTS (SELECT 1 FROM v_figi g WHERE g.isin_source = s.isin)
UNION ALL
SELECT s.code, s.isin, NULL, NULL, NULL FROM v_security s
WHERE NOT EXISTS (SELECT 1 FROM v_figi g WHERE g.isin_source = s.isin)
  AND NOT EXISTS (SELECT 1 FROM v_figi g WHERE g.ticker_source = s.code)""", "v_security", "v_figi"))
def q_fallback_match(spark, sf_dir):
    s = v_security(spark, sf_dir).select("code", "isin")
    return L.fallback_match(s, v_figi(spark, sf_dir), "isin", "code", "isin_source", "ticker_source", _FIGI_COLS)


# Requests = securities in batches of 60 ordered by code; responses carry the
# same (batch, position) key and are matched by it.
@register("positional_join", with_views("""
SELECT r.code, r.batch_id, r.seq, p.figi
FROM (SELECT code, (rn - 1) // 60 AS batch_id, (rn - 1) % 60 AS seq
      FROM (SELECT code, row_number() OVER (ORDER BY code) AS rn FROM v_security)) r
LEFT JOIN (SELECT 'F' || code AS figi, (rn - 1) // 60 AS batch_id, (rn - 1) % 60 AS seq
           FROM (SELECT code, row_number() OVER (ORDER BY code) AS rn FROM v_security) WHERE id_even) p
  USING (batch_id, seq)""".replace("WHERE id_even", "WHERE CAST(code AS BIGINT) % 2 = 0"), "v_security"))
def q_positional_join(spark, sf_dir):
    from ..operators.aggregates import row_number_key
    s = row_number_key(v_security(spark, sf_dir).select("code"), ["code"], "rn")
    req = s.select("code", F.floor(F.col("rn") / 60).cast("bigint").alias("batch_id"),
                   (F.col("rn") % 60).cast("bigint").alias("seq"))
    resp = req.where(F.col("code").cast("bigint") % 2 == 0).select(
        F.concat(F.lit("F"), F.col("code")).alias("figi"), "batch_id", "seq")
    return L.positional_join(req, resp).select("code", "batch_id", "seq", "figi")


@register("explode_response", with_views("""
SELECT CAST(p.p_partkey AS VARCHAR) AS code, 'F' || CAST(l.security_id AS VARCHAR) || '-' ||
       CAST(l.exchange_id AS VARCHAR) AS figi, CAST(l.exchange_id AS VARCHAR) AS exchCode
FROM part p JOIN v_listing l ON l.security_id = p.p_partkey""", "v_listing"))
def q_explode_response(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("code"), "p_partkey")
    matches = v_listing(spark, sf_dir).groupBy("security_id").agg(F.collect_list(F.struct(
        F.concat(F.lit("F"), F.col("security_id").cast("string"), F.lit("-"),
                 F.col("exchange_id").cast("string")).alias("figi"),
        F.col("exchange_id").cast("string").alias("exchCode"))).alias("data"))
    resp = p.join(matches, p.p_partkey == matches.security_id, "left")
    matched, _unmatched = L.explode_response(resp, "data", keep=["code"])
    return matched
