"""Registered queries for the read views of SURVEY 2.16 beyond the lists: one
row, children, a listing with its quotes, counts and choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..operators import aggregates as A
from ..operators import filters as FL
from ..operators import lookup as L
from . import jobs as J
from .both import ctes, frame
from .fixtures import v_entity, v_exchange, v_log, v_quote, v_security, with_views
from .registry import register

SECURITY = """
SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 5 <> 0 THEN 'IS' || CAST(p_partkey AS STRING) END AS isin,
       'S' || CAST(p_partkey AS STRING) AS figi, p_type AS security_type_id FROM {part}"""
TICKER = "SELECT p_partkey + 5 AS id, CAST(p_partkey AS STRING) AS ticker, p_partkey AS security_id FROM {part}"
LISTING = """
SELECT DISTINCT l_partkey * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS id,
       'F' || l_linestatus || CAST(l_partkey AS STRING) AS figi, l_partkey + 5 AS security_ticker_id,
       100 + l_partkey % 25 AS exchange_id, CASE WHEN l_partkey % 3 <> 0 THEN 'vendor' END AS quote_source,
       CASE WHEN l_partkey % 3 <> 0 THEN 'USD' END AS currency FROM {lineitem}"""
ENTITY_ISIN = """
SELECT DISTINCT o_custkey AS entity_id, l_partkey AS id, 'IS' || CAST(l_partkey AS STRING) AS isin
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey"""
_CTE = ctes(security=SECURITY, ticker=TICKER, listing=LISTING, entity_isin=ENTITY_ISIN)

#: The rows that the "one" views ask for.
ENTITY, EXCHANGE, SECURITY_ID, LISTING_ID, LOG = 85, 103, 7, 15, 42


# ------------------------------------------------------------ entities

_ENTITY_FILTERS = {"status": ("status", P.INCLUDES), "country": ("legal_address_country", P.EQUAL)}
_ENTITY_COLS = "id, lei, name, legal_address_country, status"


@register("view_entity_one", with_views(f"SELECT {_ENTITY_COLS} FROM v_entity WHERE id = {ENTITY}", "v_entity"))
def q_view_entity_one(spark, sf_dir):
    return J.view_one(v_entity(spark, sf_dir), "id", ENTITY)


@register("view_entity_securities", with_views(f"""
SELECT s.name, e.isin, s.figi, s.security_type_id FROM entity_isin e JOIN security s ON s.isin = e.isin
WHERE e.entity_id = {ENTITY}""", extra=_CTE))
def q_view_entity_securities(spark, sf_dir):
    s = frame(spark, sf_dir, SECURITY).select("isin", "name", "figi", "security_type_id", F.col("id").alias("security_id"))
    rows = J.view_children(frame(spark, sf_dir, ENTITY_ISIN), "entity_id", ENTITY, [(s, "isin")],
                           ["name", "isin", "figi", "security_type_id", "security_id"])
    return rows.where(F.col("security_id").isNotNull()).drop("security_id")


@register("view_entity_securities_count", with_views(
    f"SELECT count(*) AS count FROM entity_isin WHERE entity_id = {ENTITY}", extra=_CTE))
def q_view_entity_securities_count(spark, sf_dir):
    return J.view_count(frame(spark, sf_dir, ENTITY_ISIN), {"entityId": ENTITY}, {"entityId": ("entity_id", P.EQUAL)})


@register("view_entity_count", with_views(
    "SELECT count(*) AS count FROM v_entity WHERE status IN ('BUILDING', 'MACHINERY')", "v_entity"))
def q_view_entity_count(spark, sf_dir):
    return J.view_count(v_entity(spark, sf_dir), {"status": ["BUILDING", "MACHINERY"]}, _ENTITY_FILTERS)


@register("view_entity_choices", with_views("""
SELECT legal_address_country AS key, count(*) AS count FROM v_entity WHERE status IN ('BUILDING', 'MACHINERY')
GROUP BY 1""", "v_entity"))
def q_view_entity_choices(spark, sf_dir):
    return J.view_choices(v_entity(spark, sf_dir), "legal_address_country", {"legal_address_country": "values"},
                          {"status": ["BUILDING", "MACHINERY"]}, _ENTITY_FILTERS)


# ------------------------------------------------------------ exchanges

_EXCHANGE_FILTERS = {"minId": ("id", P.GREATER_EQUAL), "exchangeId": ("exchange_id", P.EQUAL)}


@register("view_exchange_one", with_views(f"""
SELECT e.id, e.mic, e.name,
       CASE WHEN p.id IS NOT NULL THEN CAST(json_object('id', p.id, 'mic', p.mic, 'name', p.name) AS VARCHAR) END
       AS operating_exchange
FROM v_exchange e LEFT JOIN v_exchange p ON e.operating_exchange_id = p.id WHERE e.id = {EXCHANGE}""", "v_exchange"))
def q_view_exchange_one(spark, sf_dir):
    e = L.lateral_parent_json(v_exchange(spark, sf_dir), "id", "operating_exchange_id", ["id", "mic", "name"],
                              "operating_exchange")
    return J.view_one(e.select("id", "mic", "name", "operating_exchange"), "id", EXCHANGE)


@register("view_exchange_securities", with_views(f"""
SELECT t.security_id, l.security_ticker_id, l.id AS security_listing_id, t.ticker, s.name, s.isin, s.security_type_id
FROM listing l LEFT JOIN ticker t ON l.security_ticker_id = t.id LEFT JOIN security s ON t.security_id = s.id
WHERE l.exchange_id = {EXCHANGE}""", extra=_CTE))
def q_view_exchange_securities(spark, sf_dir):
    t = frame(spark, sf_dir, TICKER).withColumnRenamed("id", "security_ticker_id")
    s = frame(spark, sf_dir, SECURITY).withColumnRenamed("id", "security_id").drop("figi")
    rows = frame(spark, sf_dir, LISTING).withColumnRenamed("id", "security_listing_id")
    return J.view_children(rows, "exchange_id", EXCHANGE, [(t, "security_ticker_id"), (s, "security_id")],
                           ["security_id", "security_ticker_id", "security_listing_id", "ticker", "name", "isin", "security_type_id"])


@register("view_exchange_securities_count", with_views(
    f"SELECT count(*) AS count FROM listing WHERE exchange_id = {EXCHANGE}", extra=_CTE))
def q_view_exchange_securities_count(spark, sf_dir):
    return J.view_count(frame(spark, sf_dir, LISTING), {"exchangeId": EXCHANGE}, _EXCHANGE_FILTERS)


@register("view_exchange_count", with_views("SELECT count(*) AS count FROM v_exchange WHERE id >= 3", "v_exchange"))
def q_view_exchange_count(spark, sf_dir):
    return J.view_count(v_exchange(spark, sf_dir), {"minId": 3}, _EXCHANGE_FILTERS)


@register("view_exchange_choices", with_views("""
SELECT CASE WHEN operating_exchange_id IS NULL THEN 'NULL' ELSE 'NOT_NULL' END AS key, count(*) AS count
FROM v_exchange WHERE id >= 3 GROUP BY 1""", "v_exchange"))
def q_view_exchange_choices(spark, sf_dir):
    return J.view_choices(v_exchange(spark, sf_dir), "operating_exchange_id", {"operating_exchange_id": "nulls"},
                          {"minId": 3}, _EXCHANGE_FILTERS)


# ------------------------------------------------------------ securities and listings

@register("view_security_one", with_views(f"""
SELECT code, name, type, exchange_code, isin, currency, id, size FROM v_security WHERE id = {SECURITY_ID}""", "v_security"))
def q_view_security_one(spark, sf_dir):
    return J.view_one(v_security(spark, sf_dir), "id", SECURITY_ID)


_EXCHANGE_JSON = "CASE WHEN e.id IS NOT NULL THEN CAST(json_object('id', e.id, 'name', e.name, 'mic', e.mic) AS VARCHAR) END AS exchange"


@register("view_security_listings", with_views(f"""
SELECT l.id, l.figi, t.ticker, l.quote_source, l.currency, {_EXCHANGE_JSON}
FROM listing l LEFT JOIN ticker t ON l.security_ticker_id = t.id LEFT JOIN v_exchange e ON l.exchange_id = e.id
WHERE t.security_id = {SECURITY_ID} ORDER BY l.quote_source, l.id LIMIT 25""", "v_exchange", extra=_CTE))
def q_view_security_listings(spark, sf_dir):
    rows = J.view_listing(frame(spark, sf_dir, LISTING), frame(spark, sf_dir, TICKER), v_exchange(spark, sf_dir))
    page = J.view_list(rows, {"id": SECURITY_ID}, {"id": ("security_id", P.EQUAL)}, 1, 25, [("quote_source", "ASC")], "id")
    return page.select("id", "figi", "ticker", "quote_source", "currency", "exchange")


@register("view_listing_one", with_views(f"""
SELECT l.id, l.figi, t.ticker, l.quote_source, l.currency, {_EXCHANGE_JSON},
       COALESCE((SELECT CAST(to_json(list({{'close': CAST(close AS VARCHAR), 'date': date, 'high': CAST(high AS VARCHAR),
                                           'low': CAST(low AS VARCHAR), 'adj_close': CAST(adjusted_close AS VARCHAR)}} ORDER BY date)) AS VARCHAR)
                 FROM v_quote WHERE CAST(security_code AS BIGINT) * 2 + CASE WHEN exchange_code = 'O' THEN 1 ELSE 0 END = {LISTING_ID}), '[]') AS quotes
FROM listing l LEFT JOIN ticker t ON l.security_ticker_id = t.id LEFT JOIN v_exchange e ON l.exchange_id = e.id
WHERE l.id = {LISTING_ID}""", "v_exchange", "v_quote", extra=_CTE))
def q_view_listing_one(spark, sf_dir):
    q = v_quote(spark, sf_dir)
    q = q.select((F.col("security_code").cast("bigint") * 2 + (F.col("exchange_code") == "O").cast("int")).alias("security_listing_id"),
                 "date", *[F.col(c).cast("string").alias(c) for c in ("close", "high", "low")],
                 F.col("adjusted_close").cast("string").alias("adj_close"), F.lit(1).alias("interval_id"))
    return J.view_one_listing(frame(spark, sf_dir, LISTING), frame(spark, sf_dir, TICKER), v_exchange(spark, sf_dir), q, LISTING_ID)


# ------------------------------------------------------------ logs

@register("view_log_one", with_views(f"SELECT * FROM v_log WHERE id = {LOG}", "v_log"))
def q_view_log_one(spark, sf_dir):
    return J.view_one(v_log(spark, sf_dir), "id", LOG)


@register("view_log_choices", with_views("SELECT DISTINCT level FROM v_log WHERE service IN ('S1', 'S3')", "v_log"))
def q_view_log_choices(spark, sf_dir):
    """Choices of one field under the other filters: its own is left out."""
    return A.distinct_values(v_log(spark, sf_dir), "level", {"service": ["S1", "S3"], "level": "ERROR"})


@register("view_log_choices_count", with_views(
    "SELECT count(DISTINCT level) AS count FROM v_log WHERE service = 'S1'", "v_log"))
def q_view_log_choices_count(spark, sf_dir):
    return A.distinct_count(FL.log_filter(v_log(spark, sf_dir), {"service": "S1"}), "level")
