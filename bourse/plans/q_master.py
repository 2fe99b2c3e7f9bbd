"""Registered queries of the security master: FIGI matching with
a response table and a second attempt, the three keyed tables, and the jobs
that read them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import jobs as J
from .both import ctes, frame, key_cte
from .fixtures import with_views
from .registry import register

_K, _CODE = "p_partkey", "CAST(p_partkey AS STRING)"
_B = "CAST(replace(p_brand, 'Brand#', '') AS INT)"
_CLASS = "CAST(floor(p_partkey / 2) AS BIGINT)"
_SHARE = f"'S' || CAST({_CLASS} AS STRING)"
_VENUE = f"'G' || CAST({_B} % 10 AS STRING)"

RAW = f"""
SELECT {_CODE} AS Code, CASE WHEN {_K} % 5 <> 0 THEN 'IS' || {_CODE} END AS Isin, p_name AS Name, p_type AS Type,
       'NATION_' || CAST({_K} % 25 AS STRING) AS Country, CASE WHEN p_size % 10 = 0 THEN 'EUR' ELSE 'USD' END AS Currency,
       p_brand AS Exchange FROM {{part}}"""
TYPE_MAP = """
SELECT DISTINCT p_type AS source_value, CAST(length(p_type) AS STRING) AS mapping_value FROM {part} WHERE p_type <> 'MEDIUM'"""
COUNTRY_MAP = """
SELECT n_name AS source_value, 'C' || CAST(n_nationkey AS STRING) AS mapping_value FROM {nation} WHERE n_nationkey % 2 = 0"""
EXCHANGE_MAP = f"""
SELECT DISTINCT p_brand AS source_value, 'X' || CAST({_B} % 10 AS STRING) AS mapping_value FROM {{part}} WHERE {_B} % 2 = 0"""
FIGI_EXCHANGE_MAP = f"""
SELECT DISTINCT {_VENUE} AS source_value, 'X' || CAST({_B} % 10 AS STRING) AS mapping_value FROM {{part}} WHERE {_B} % 10 < 8"""
FIGI = f"""
SELECT CASE WHEN {_K} % 3 = 0 THEN {_CODE} END AS ticker_source,
       CASE WHEN {_K} % 4 = 0 AND {_K} % 5 <> 0 THEN 'IS' || {_CODE} END AS isin_source, 'F' || {_CODE} AS figi,
       CASE WHEN {_K} % 10 <> 9 THEN {_SHARE} END AS share_class_figi,
       CASE WHEN {_K} % 6 = 0 THEN 'T' || {_CODE} ELSE {_CODE} END AS ticker_figi,
       {_VENUE} AS exchange_code_figi, p_name AS name_figi
FROM {{part}} WHERE {_K} % 3 = 0 OR {_K} % 4 = 0"""


def _answer(kind: str, value: str, figi: str, venue: str, where: str) -> str:
    return (f"SELECT '{kind}' AS idType, {value} AS idValue, {figi} AS figi, {_SHARE} AS share_class_figi, "
            f"{_CODE} AS ticker_figi, {venue} AS exchange_code_figi, p_name AS name_figi FROM {{part}} WHERE {where}")


# Some ISINs have one match, some two, some a warning only; some tickers have one.
ANSWERS = "\nUNION ALL\n".join([
    _answer("ID_ISIN", f"'IS' || {_CODE}", f"'N' || {_CODE} || 'a'", _VENUE, f"{_K} % 7 IN (1, 2) AND {_K} % 5 <> 0"),
    _answer("ID_ISIN", f"'IS' || {_CODE}", f"'N' || {_CODE} || 'b'", f"'G' || CAST(({_B} + 1) % 10 AS STRING)", f"{_K} % 7 = 2 AND {_K} % 5 <> 0"),
    _answer("ID_ISIN", f"'IS' || {_CODE}", "CAST(NULL AS STRING)", _VENUE, f"{_K} % 7 = 4 AND {_K} % 5 <> 0"),
    _answer("TICKER", _CODE, f"'N' || {_CODE} || 'c'", _VENUE, f"{_K} % 7 IN (2, 3)"),
])
KEYS = {
    "security": f"SELECT DISTINCT {_SHARE} AS uid, {_CLASS} + 1000 AS surrogate_key FROM {{part}} WHERE {_CLASS} % 3 = 0",
    "security_ticker": f"SELECT {_SHARE} || '_' || {_CODE} AS uid, {_K} AS surrogate_key FROM {{part}} WHERE {_K} % 9 = 0",
    "security_listing": f"SELECT 'F' || {_CODE} AS uid, {_K} AS surrogate_key FROM {{part}} WHERE {_K} % 8 = 0",
    "exchange": f"SELECT DISTINCT 'X' || CAST({_B} % 10 AS STRING) AS uid, CAST({_B} % 10 + 1 AS BIGINT) AS surrogate_key FROM {{part}} WHERE {_B} % 10 < 6",
    "entity_isin": f"SELECT 'IS' || {_CODE} AS uid, {_K} AS surrogate_key FROM {{part}} WHERE {_K} % 2 = 0 AND {_K} % 5 <> 0",
}


def _responses(spark, d):
    """One row per request: its matches as an array, empty for a warning."""
    match = F.struct(*J.FIGI_COLUMNS)
    return frame(spark, d, ANSWERS).groupBy("idType", "idValue").agg(
        F.collect_list(F.when(F.col("figi").isNotNull(), match)).alias("data"))


def _maps(spark, d):
    return {n: frame(spark, d, s) for n, s in [("type", TYPE_MAP), ("country", COUNTRY_MAP), ("exchange", EXCHANGE_MAP),
                                               ("figi_exchange", FIGI_EXCHANGE_MAP)]}


_FIGI = ", ".join(J.FIGI_COLUMNS)
_BY_ISIN, _BY_TICKER = "f.isin_source = p.isin", "f.ticker_source = p.ticker"
_CTE = ctes(raw=RAW, type_map=TYPE_MAP, country_map=COUNTRY_MAP, exchange_map=EXCHANGE_MAP,
            figi_exchange_map=FIGI_EXCHANGE_MAP, figi_table=FIGI, answers=ANSWERS) | {
    "pre": "SELECT r.Code AS ticker, r.Isin AS isin, r.Name AS name, r.Type AS security_type, "
           "CAST(t.mapping_value AS INTEGER) AS security_type_id, c.mapping_value AS country, r.Currency AS currency, "
           "r.Exchange AS exchange_source_code, e.mapping_value AS exchange_uid, 'vendor' AS source FROM raw r "
           "JOIN type_map t ON t.source_value = r.Type LEFT JOIN country_map c ON c.source_value = r.Country "
           "LEFT JOIN exchange_map e ON e.source_value = r.Exchange",
    "miss1": f"SELECT p.* FROM pre p WHERE NOT EXISTS (SELECT 1 FROM figi_table f WHERE {_BY_ISIN}) "
             f"AND NOT EXISTS (SELECT 1 FROM figi_table f WHERE {_BY_TICKER})",
    "ans1": f"SELECT p.isin, p.ticker, {_FIGI} FROM miss1 p JOIN answers a ON a.idValue = COALESCE(p.isin, p.ticker) AND "
            "a.idType = CASE WHEN p.isin IS NOT NULL THEN 'ID_ISIN' ELSE 'TICKER' END WHERE a.figi IS NOT NULL",
    "ans2": f"SELECT p.isin, p.ticker, {_FIGI} FROM miss1 p JOIN answers a ON a.idValue = p.ticker AND a.idType = 'TICKER' "
            "WHERE p.isin IS NOT NULL AND a.figi IS NOT NULL AND p.ticker NOT IN (SELECT ticker FROM ans1)",
    "new_figi": f"SELECT DISTINCT isin AS isin_source, ticker AS ticker_source, {_FIGI} FROM "
                "(SELECT * FROM ans1 UNION ALL SELECT * FROM ans2)",
    "known_figi": f"SELECT isin_source, ticker_source, {_FIGI} FROM figi_table UNION ALL SELECT * FROM new_figi",
    "matched": f"SELECT p.*, {_FIGI} FROM pre p JOIN known_figi f ON {_BY_ISIN} UNION "
               f"SELECT p.*, {_FIGI} FROM pre p JOIN known_figi f ON {_BY_TICKER}",
}


def _match(spark, d):
    m = _maps(spark, d)
    pre, _ = J.security_pre_figi(frame(spark, d, RAW), m["type"], m["country"], m["exchange"], "vendor")
    return J.job_figi_match(pre, frame(spark, d, FIGI), _responses(spark, d))


@register("job_figi_match", with_views("SELECT * FROM matched", extra=_CTE))
def q_job_figi_match(spark, sf_dir):
    return _match(spark, sf_dir)[0]


@register("job_figi_missing", with_views(
    f"SELECT p.* FROM pre p WHERE NOT EXISTS (SELECT 1 FROM known_figi f WHERE {_BY_ISIN}) "
    f"AND NOT EXISTS (SELECT 1 FROM known_figi f WHERE {_BY_TICKER})", extra=_CTE))
def q_job_figi_missing(spark, sf_dir):
    return _match(spark, sf_dir)[1]


@register("job_figi_new_mappings", with_views("SELECT * FROM new_figi", extra=_CTE))
def q_job_figi_new_mappings(spark, sf_dir):
    return _match(spark, sf_dir)[2]


@register("job_figi_requests", with_views(
    "SELECT *, COALESCE(isin, ticker) AS idValue, CASE WHEN isin IS NOT NULL THEN 'ID_ISIN' ELSE 'TICKER' END AS idType "
    "FROM miss1", extra=_CTE))
def q_job_figi_requests(spark, sf_dir):
    return _match(spark, sf_dir)[3]


# ------------------------------------------------------------ the three tables

_TABLES = _CTE | ctes(**{f"{n}_known": s for n, s in KEYS.items()}) | {
    "post": "SELECT m.ticker_figi AS ticker, m.isin, m.security_type_id, m.name_figi, m.figi, m.share_class_figi AS security_uid, "
            "m.share_class_figi || '_' || m.ticker_figi AS security_ticker_uid, x.mapping_value AS exchange_uid, "
            "CASE WHEN m.ticker = m.ticker_figi AND m.exchange_uid = x.mapping_value THEN m.source END AS quote_source, "
            "CASE WHEN m.ticker = m.ticker_figi AND m.exchange_uid = x.mapping_value THEN m.currency END AS currency "
            "FROM matched m JOIN figi_exchange_map x ON x.source_value = m.exchange_code_figi WHERE m.share_class_figi IS NOT NULL",
    "security_keys": key_cte("security_known", "post", "security_uid"),
    "ticker_keys": key_cte("security_ticker_known", "post", "security_ticker_uid"),
    "listing_keys": key_cte("security_listing_known", "post", "figi"),
    "security_t": "SELECT k.surrogate_key AS id, security_uid AS figi, min(security_type_id) AS security_type_id, min(name_figi) AS name, "
                  "list_sort(list_distinct(list(name_figi))) AS names, min(isin) AS isin FROM post JOIN security_keys k "
                  "ON k.uid = security_uid GROUP BY ALL",
    "ticker_t": "SELECT DISTINCT t.surrogate_key AS id, s.surrogate_key AS security_id, ticker, security_ticker_uid FROM post "
                "JOIN ticker_keys t ON t.uid = security_ticker_uid JOIN security_keys s ON s.uid = security_uid",
    "listing_t": "SELECT l.surrogate_key AS id, figi, t.surrogate_key AS security_ticker_id, e.surrogate_key AS exchange_id, quote_source, "
                 "currency FROM (SELECT security_ticker_uid, figi, exchange_uid, max(quote_source) AS quote_source, "
                 "max(currency) AS currency FROM post GROUP BY ALL) g JOIN ticker_keys t ON t.uid = security_ticker_uid "
                 "JOIN listing_keys l ON l.uid = figi JOIN exchange_known e ON e.uid = exchange_uid",
}


def _master(spark, d):
    return J.job_security_master(frame(spark, d, RAW), _maps(spark, d), frame(spark, d, FIGI), _responses(spark, d),
                                 {n: frame(spark, d, s) for n, s in KEYS.items()}, "vendor")


@register("job_security_master_security", with_views("""
SELECT s.id, s.figi, s.security_type_id, s.name, array_to_string(list_filter(names, lambda x: x <> name), '|') AS aliases, s.isin,
       e.surrogate_key AS entity_isin_id FROM security_t s LEFT JOIN entity_isin_known e ON e.uid = s.isin""", extra=_TABLES))
def q_job_security_master_security(spark, sf_dir):
    return _master(spark, sf_dir).security.select(
        "id", "figi", "security_type_id", "name", F.array_join("name_figi_alias", "|").alias("aliases"), "isin", "entity_isin_id")


@register("job_security_master_ticker", with_views("SELECT * FROM ticker_t", extra=_TABLES))
def q_job_security_master_ticker(spark, sf_dir):
    return _master(spark, sf_dir).ticker


@register("job_security_master_listing", with_views("SELECT * FROM listing_t", extra=_TABLES))
def q_job_security_master_listing(spark, sf_dir):
    return _master(spark, sf_dir).listing


@register("job_security_master", with_views("""
SELECT l.id, l.figi, t.ticker, t.security_id, s.name, s.security_type_id, l.exchange_id, l.quote_source, l.currency
FROM listing_t l JOIN ticker_t t ON l.security_ticker_id = t.id JOIN security_t s ON t.security_id = s.id""", extra=_TABLES))
def q_job_security_master(spark, sf_dir):
    """The three tables of the job, joined by their keys."""
    m = _master(spark, sf_dir)
    t = m.ticker.select(F.col("id").alias("security_ticker_id"), "security_id", "ticker")
    s = m.security.select(F.col("id").alias("security_id"), "name", "security_type_id")
    return m.listing.join(t, "security_ticker_id").join(s, "security_id").select(
        "id", "figi", "ticker", "security_id", "name", "security_type_id", "exchange_id", "quote_source", "currency")


@register("job_security_master_rejects", with_views("""
SELECT 'no type' AS reason, Code AS ticker FROM raw WHERE Type NOT IN (SELECT source_value FROM type_map)
UNION ALL SELECT 'no exchange', ticker_figi FROM matched WHERE share_class_figi IS NOT NULL
  AND exchange_code_figi NOT IN (SELECT source_value FROM figi_exchange_map)""", extra=_CTE))
def q_job_security_master_rejects(spark, sf_dir):
    m = _maps(spark, sf_dir)
    pre, no_type = J.security_pre_figi(frame(spark, sf_dir, RAW), m["type"], m["country"], m["exchange"], "vendor")
    matched = J.job_figi_match(pre, frame(spark, sf_dir, FIGI), _responses(spark, sf_dir))[0]
    _post, no_exchange = J.security_post_figi(matched, m["figi_exchange"])
    return no_type.select(F.lit("no type").alias("reason"), "ticker").unionByName(
        no_exchange.select(F.lit("no exchange").alias("reason"), "ticker"))
