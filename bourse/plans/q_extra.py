"""Registered queries for the remaining SURVEY 2 rows: generic reshape
operators, path merging, list splitting, the full-text filter placeholder,
the quote-source rule and the four list views."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import fundamentals as FU
from ..operators import lookup as L
from ..operators import nested as N
from ..operators import setops as S
from ..session import scratch_path
from . import jobs as J
from .docs import DOC_BASE_SQL, cents_sql, v_doc
from .fixtures import table, v_entity, v_exchange, v_listing, v_quote, v_security, with_views
from .q_relational import SECURITY_FILTERS
from .q_search import _grams_sql, _sim_sql, _toks_sql
from .registry import register

_NULLS = ("CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS DATE) AS period, "
          "CAST(NULL AS VARCHAR) AS period_type, CAST(NULL AS DATE) AS published_at")


def _parsed(spark, sf_dir, cols):
    return FU.parsed_common_stock(v_doc(spark, sf_dir), columns=cols)


@register("struct_to_metrics", with_views(f"""
SELECT 'splits' AS category, f.metric,
       CASE f.metric WHEN 'LastSplitFactor' THEN '2:1' WHEN 'LastSplitDate' THEN strftime(od, '%Y-%m-%d')
                     WHEN 'PayoutRatio' THEN CAST(o_custkey % 100 AS VARCHAR) END AS value,
       {_NULLS}, exchange_code, security_code
FROM o CROSS JOIN (VALUES ('LastSplitFactor'), ('LastSplitDate'), ('PayoutRatio')) f(metric)""",
                                         extra=DOC_BASE_SQL))
def q_struct_to_metrics(spark, sf_dir):
    # no field list: every key present in the object becomes a metric
    return N.struct_to_metrics(_parsed(spark, sf_dir, ["SplitsDividends"]), "SplitsDividends", "splits",
                               None, FU.ID_COLS)


@register("records_to_metrics", with_views(f"""
SELECT 'income_statement' AS category, f.metric,
       CASE f.metric WHEN 'totalRevenue' THEN CAST({cents_sql('l_extendedprice')} AS VARCHAR)
                     WHEN 'netIncome' THEN CAST({cents_sql('l_discount')} AS VARCHAR) END AS value,
       'USD' AS currency, CAST(date_trunc('year', sd) AS DATE) AS period, 'yearly' AS period_type,
       CAST(sd + 30 AS DATE) AS published_at, exchange_code, security_code
FROM l CROSS JOIN (VALUES ('totalRevenue'), ('netIncome')) f(metric)""", extra=DOC_BASE_SQL))
def q_records_to_metrics(spark, sf_dir):
    return N.records_to_metrics(_parsed(spark, sf_dir, ["is_y"]), "is_y", "income_statement", "yearly",
                                id_cols=FU.ID_COLS)


@register("nested_to_json_value", with_views(f"""
SELECT 'general' AS category, 'officers' AS metric,
       CAST(to_json(list({{'Name': 'Clerk ' || CAST(l_suppkey AS VARCHAR), 'Title': 'T' || CAST(l_linenumber AS VARCHAR)}}
                         ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS VARCHAR) AS value,
       {_NULLS}, exchange_code, security_code FROM l GROUP BY exchange_code, security_code""", extra=DOC_BASE_SQL))
def q_nested_to_json_value(spark, sf_dir):
    return N.nested_to_json_value(_parsed(spark, sf_dir, []), "Officers", "officers", "general", ["Name", "Title"],
                                  FU.ID_COLS)


@register("merge_files", with_views("""
SELECT security_code, exchange_code, date, adjusted_close FROM v_quote""", "v_quote"))
def q_merge_files(spark, sf_dir):
    q = v_quote(spark, sf_dir).select("security_code", "exchange_code", "date", "adjusted_close")
    a, b, c = (scratch_path(spark, f"part-{i}") for i in range(3))
    cut1, cut2 = F.lit(_dt.date(1997, 1, 1)), F.lit(_dt.date(1999, 1, 1))
    q.where(F.col("date") < cut1).write.parquet(a)
    q.where((F.col("date") >= cut1) & (F.col("date") < cut2)).write.parquet(b)
    q.where(F.col("date") >= cut2).write.parquet(c)
    return S.merge_files(spark, [[a], [b, [c]]])


@register("split_list", """
SELECT p_partkey, len(string_split(p_name, ' ')) AS n_words, string_split(p_name, ' ')[1] AS first_word,
       string_split(p_name, ' ')[2] AS second_word FROM part""")
def q_split_list(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    w = N.split_list(F.col("p_name"), " ")
    return p.select("p_partkey", F.size(w).cast("bigint").alias("n_words"), F.get(w, 0).alias("first_word"),
                    F.get(w, 1).alias("second_word"))


_SEC = "code, name, type, exchange_code, isin, currency, id, size"


def _search_view_sql(query_word: str, extra_where: str = "TRUE") -> str:
    return with_views(f"""
SELECT {_SEC}, rank, similarity FROM (
  SELECT s.*, f.rank, f.similarity FROM v_security s JOIN (
    SELECT id, CASE WHEN m THEN len(list_filter(toks, lambda x: x IN ('{query_word}'))) / len(toks) ELSE 0.0 END
           AS rank, sim AS similarity
    FROM (SELECT t.id, t.toks, (s LIKE '% {query_word} %') AS m, sim, p
          FROM (SELECT id, toks, ' ' || array_to_string(toks, ' ') || ' ' AS s,
                       {_sim_sql(_grams_sql('toks'), query_word)} AS sim FROM t) t
          JOIN (SELECT id, ({extra_where}) AS p FROM v_security) USING (id))
    WHERE (p AND m) OR sim >= 0.05) f ON s.id = f.id
  WHERE {extra_where})
ORDER BY rank DESC, similarity DESC, id LIMIT 25""", "v_security",
                      extra={"t": f"SELECT p_partkey AS id, {_toks_sql('p_name')} AS toks FROM part"})


@register("pred_full_text", _search_view_sql("ring"))
def q_pred_full_text(spark, sf_dir):
    """A FULL_TEXT_SEARCH filter adds no predicate of its own; it switches
    the list view to the search plan."""
    return J.view_list(v_security(spark, sf_dir), {"search": "ring"}, SECURITY_FILTERS, page=1, page_size=25,
                       order=[("name", "ASC")], unique_key="id", search_cols=["name"])


@register("view_security", _search_view_sql("bolt", "size >= 20"))
def q_view_security(spark, sf_dir):
    return J.view_list(v_security(spark, sf_dir), {"search": "bolt", "minSize": 20}, SECURITY_FILTERS, page=1,
                       page_size=25, order=[("name", "ASC")], unique_key="id", search_cols=["name"])


@register("view_exchange", with_views("""
SELECT e.id, e.mic, e.name,
       CASE WHEN p.id IS NOT NULL THEN CAST(json_object('id', p.id, 'mic', p.mic, 'name', p.name) AS VARCHAR) END
       AS operating_exchange
FROM v_exchange e LEFT JOIN v_exchange p ON e.operating_exchange_id = p.id
WHERE e.id >= 100 ORDER BY e.name, e.id LIMIT 10 OFFSET 10""", "v_exchange"))
def q_view_exchange(spark, sf_dir):
    from ..functions import predicates as P
    e = L.lateral_parent_json(v_exchange(spark, sf_dir), "id", "operating_exchange_id", ["id", "mic", "name"],
                              "operating_exchange").select("id", "mic", "name", "operating_exchange")
    return J.view_list(e, {"minId": 100}, {"minId": ("id", P.GREATER_EQUAL)}, page=2, page_size=10,
                       order=[("name", "ASC")], unique_key="id")


@register("view_entity", with_views("""
SELECT id, lei, name, legal_address_country, status FROM v_entity
WHERE status IN ('BUILDING', 'MACHINERY') AND legal_address_country <> 'NATION_3'
ORDER BY name, id LIMIT 25 OFFSET 25""", "v_entity"))
def q_view_entity(spark, sf_dir):
    from ..functions import predicates as P
    fs = {"status": ("status", P.INCLUDES), "notCountry": ("legal_address_country", P.NOT_EQUAL)}
    return J.view_list(v_entity(spark, sf_dir), {"status": ["BUILDING", "MACHINERY"], "notCountry": "NATION_3"}, fs,
                       page=2, page_size=25, order=[("name", "ASC")], unique_key="id")


@register("view_listing", with_views("""
SELECT l.security_id, l.exchange_id, p.p_name AS name, s.s_name AS exchange_name
FROM v_listing l LEFT JOIN part p ON l.security_id = p.p_partkey LEFT JOIN supplier s ON l.exchange_id = s.s_suppkey
ORDER BY l.security_id, l.exchange_id LIMIT 25 OFFSET 100""", "v_listing"))
def q_view_listing(spark, sf_dir):
    lst = v_listing(spark, sf_dir)
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("security_id"), F.col("p_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("exchange_id"),
                                                F.col("s_name").alias("exchange_name"))
    rows = lst.join(p, "security_id", "left").join(s, "exchange_id", "left").select(
        "security_id", "exchange_id", "name", "exchange_name")
    lst_v = rows.withColumn("_k", F.col("security_id") * 1_000_000 + F.col("exchange_id"))
    return J.view_list(lst_v, {}, {}, page=5, page_size=25, order=[("security_id", "ASC"), ("exchange_id", "ASC")],
                       unique_key="_k").drop("_k")


@register("reference_quote_source", with_views("""
SELECT s.code, f.figi,
       CASE WHEN s.code = f.ticker_source AND (s.exchange_code = x.mic_figi OR x.operating_mic = x.mic_figi)
            THEN 'vendor' END AS quote_source,
       CASE WHEN s.code = f.ticker_source AND (s.exchange_code = x.mic_figi OR x.operating_mic = x.mic_figi)
            THEN s.currency END AS currency
FROM v_security s JOIN v_figi f ON 'F' || s.code = f.figi
JOIN (SELECT code, CASE WHEN id % 2 = 0 THEN exchange_code ELSE 'OTHER' END AS mic_figi,
             CASE WHEN id % 5 = 1 THEN 'OTHER' ELSE 'OP' END AS operating_mic FROM v_security) x
  ON x.code = s.code""", "v_security", "v_figi"))
def q_reference_quote_source(spark, sf_dir):
    from .fixtures import v_figi
    s = v_security(spark, sf_dir)
    x = s.select("code", F.when(F.col("id") % 2 == 0, F.col("exchange_code")).otherwise(F.lit("OTHER"))
                 .alias("mic_figi"),
                 F.when(F.col("id") % 5 == 1, F.lit("OTHER")).otherwise(F.lit("OP")).alias("operating_mic"))
    f = v_figi(spark, sf_dir)
    j = s.join(f, F.concat(F.lit("F"), s.code) == f.figi).join(x, "code")
    qs, cur = C.reference_quote_source(F.col("code"), F.col("ticker_source"), F.col("exchange_code"),
                                       F.col("mic_figi"), F.col("operating_mic"), F.lit("vendor"), F.col("currency"))
    return j.select("code", "figi", qs.alias("quote_source"), cur.alias("currency"))
