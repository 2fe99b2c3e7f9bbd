"""Registered queries for SURVEY 2.3 (projections, filters, predicates),
2.5 (aggregations), 2.6 (windows), 2.7 (sort / page) and 2.8 (set ops)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import predicates as P
from ..operators import aggregates as A
from ..operators import filters as FL
from ..operators import projections as PR
from ..operators import setops as S
from .dates import lit
from .fixtures import (QUOTE_AS_OF, table, v_exchange, v_log, v_quote, v_security, with_views)
from .registry import register

# Filter set of the security view: request key -> (column, operator).
SECURITY_FILTERS = {
    "code": ("code", P.EQUAL),
    "notCode": ("code", P.NOT_EQUAL),
    "isin": ("isin", P.INCLUDES_NULL),
    "isinNull": ("isin", P.NULL),
    "isinNotNull": ("isin", P.NOT_NULL),
    "type": ("type", P.INCLUDES),
    "notType": ("type", P.EXCLUDES),
    "exchange": ("exchange_code", P.INCLUDES),
    "name": ("name", P.LIKE),
    "minSize": ("size", P.GREATER_EQUAL),
    "aboveSize": ("size", P.GREATER),
    "maxSize": ("size", P.LESS_EQUAL),
    "belowSize": ("size", P.LESS),
    "search": ("name", P.FULL_TEXT_SEARCH),
}

_SEC_COLS = "code, name, type, exchange_code, isin, currency, id, size"


def _sec(spark, d):
    return v_security(spark, d)


def _sec_sql(where: str) -> str:
    return with_views(f"SELECT {_SEC_COLS} FROM v_security WHERE {where}", "v_security")


def _register_pred(name, filters, where):
    @register(name, _sec_sql(where))
    def _q(spark, sf_dir, _f=filters):
        return FL.filter_set(_sec(spark, sf_dir), _f, SECURITY_FILTERS)
    return _q


# ------------------------------------------------------------------ 2.3

_register_pred("filter_set", {"type": ["SMALL", "LARGE", "PROMO"], "minSize": 10, "isin": "NOT_NULL",
                              "name": "Ring", "unknownKey": 1, "notCode": "4", "search": "x"},
               "type IN ('SMALL','LARGE','PROMO') AND size >= 10 AND isin IS NOT NULL "
               "AND name LIKE '%ring%' AND code <> '4'")
_register_pred("pred_null", {"isinNull": True}, "isin IS NULL")
_register_pred("pred_not_null", {"isinNotNull": True}, "isin IS NOT NULL")
_register_pred("pred_includes", {"exchange": ["Brand#1", "Brand#7", "Brand#13"]},
               "exchange_code IN ('Brand#1','Brand#7','Brand#13')")
_register_pred("pred_excludes", {"notType": ["SMALL", "ECONOMY"]}, "type NOT IN ('SMALL','ECONOMY')")
_register_pred("pred_includes_null", {"isin": ["NULL", "NOT_NULL"]}, "(isin IS NULL OR isin IS NOT NULL)")
_register_pred("pred_equal", {"code": "42"}, "code = '42'")
_register_pred("pred_not_equal", {"notCode": "42"}, "code <> '42'")
_register_pred("pred_greater_equal", {"minSize": 25}, "size >= 25")
_register_pred("pred_greater", {"aboveSize": 25}, "size > 25")
_register_pred("pred_less_equal", {"maxSize": 25}, "size <= 25")
_register_pred("pred_less", {"belowSize": 25}, "size < 25")
_register_pred("pred_like", {"name": "Bolt"}, "name LIKE '%bolt%'")


@register("filter_objects", _sec_sql("type = 'SMALL' AND size > 0 AND size <= 40 AND isin IS NOT NULL "
                                     "AND exchange_code IN ('Brand#2','Brand#4')"))
def q_filter_objects(spark, sf_dir):
    items = [
        {"column": "type", "operator": "EQUAL", "value": "SMALL"},
        {"column": "size", "operator": "HIGHER", "value": 0},          # 0 is a real value
        {"column": "size", "operator": "LOWER_EQUAL", "value": 40},
        {"column": "isin", "operator": "IS_NOT_NULL"},
        {"column": "exchange_code", "operator": "IN", "value": ["Brand#2", "Brand#4"]},
        {"column": "name", "operator": "EQUAL", "value": None},         # None skips
    ]
    return FL.filter_objects(_sec(spark, sf_dir), items)


@register("filter_in", _sec_sql("exchange_code IN ('Brand#3','Brand#5') AND type IN ('MEDIUM','LARGE')"))
def q_filter_in(spark, sf_dir):
    return FL.filter_in(_sec(spark, sf_dir), {"exchange_code": ["Brand#3", "Brand#5"], "type": ["MEDIUM", "LARGE"]})


@register("exclude_codes", with_views(
    "SELECT id, mic, name, operating_exchange_id FROM v_exchange WHERE mic NOT IN ('NATION_1', 'NATION_2')",
    "v_exchange"))
def q_exclude_codes(spark, sf_dir):
    return FL.exclude_codes(v_exchange(spark, sf_dir), "mic", ["NATION_1", "NATION_2"])


_LOG_FROM = _dt.datetime(2024, 1, 5)
_LOG_UNTIL = _dt.datetime(2024, 1, 20, 12)

_LOG_COLS = "id, created, level, service, event, message, user_id, value"


@register("log_filter", with_views(
    f"SELECT {_LOG_COLS} FROM v_log WHERE level IN ('ERROR', 'CLICK') AND service = 'S1' "
    f"AND created >= TIMESTAMP '{_LOG_FROM}' AND created <= TIMESTAMP '{_LOG_UNTIL}'", "v_log"))
def q_log_filter(spark, sf_dir):
    f = {"level": ["ERROR", "CLICK"], "service": "S1", "fromTs": _LOG_FROM, "untilTs": _LOG_UNTIL,
         "page": 2, "pageSize": 10}
    return FL.log_filter(v_log(spark, sf_dir), f)


@register("sentinel_to_null", with_views(
    "SELECT code, name, type, exchange_code, isin, NULLIF(NULLIF(currency, 'Unknown'), '') AS currency, "
    "id, size FROM v_security", "v_security"))
def q_sentinel_to_null(spark, sf_dir):
    return C.sentinel_to_null(_sec(spark, sf_dir))


@register("project_rename", """
SELECT c_name AS lei, c_name AS legal_name, n_name AS legal_address_country, c_mktsegment AS status,
       CAST(c_acctbal AS VARCHAR) AS registration_value
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q_project_rename(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # vendor-style frame with dotted column names
    raw = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_name").alias("LEI"),
        F.col("c_name").alias("Entity.LegalName"),
        F.col("n_name").alias("Entity.LegalAddress.Country"),
        F.col("c_mktsegment").alias("Entity.EntityStatus"),
        F.col("c_acctbal").cast("string").alias("Registration.Value"),
    )
    return PR.project_rename(raw, {
        "LEI": "lei", "Entity.LegalName": "legal_name", "Entity.LegalAddress.Country": "legal_address_country",
        "Entity.EntityStatus": "status", "Registration.Value": "registration_value"})


def _raw_quote(spark, sf_dir):
    """v_quote in the vendor's file layout (capitalized names)."""
    q = v_quote(spark, sf_dir)
    return q.select(F.col("date").alias("Date"), F.col("exchange_code").alias("exchange"),
                    F.col("security_code").alias("security"), F.col("open").alias("Open"),
                    F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                    F.col("adjusted_close").alias("Adjusted_close"), F.col("volume").cast("double").alias("Volume"))


@register("normalize_quote_history", with_views(f"""
SELECT date, security_code, exchange_code, open, high, low, close, adjusted_close,
       CAST(volume AS BIGINT) AS volume, CAST(year(date) AS INTEGER) AS year, TIMESTAMP '2001-06-30 06:00:00' AS loaded_at
FROM v_quote WHERE date < {lit(QUOTE_AS_OF)}""", "v_quote"))
def q_normalize_quote_history(spark, sf_dir):
    return PR.normalize_quote_history(_raw_quote(spark, sf_dir), QUOTE_AS_OF,
                                      loaded_at=_dt.datetime(2001, 6, 30, 6, 0, 0))


@register("normalize_quote_update", with_views("""
SELECT date, security_code, exchange_code, open, high, low, close, adjusted_close,
       CAST(volume AS BIGINT) AS volume, CAST(year(date) AS INTEGER) AS year
FROM v_quote""", "v_quote"))
def q_normalize_quote_update(spark, sf_dir):
    raw = _raw_quote(spark, sf_dir).withColumnRenamed("security", "Code")
    return PR.normalize_quote_update(raw)


@register("normalize_quote_legacy", with_views("""
SELECT strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date, open, high, low, close,
       adjusted_close AS adj_close, volume, CAST(7 AS BIGINT) AS security_listing_id,
       CAST(1 AS BIGINT) AS interval_id
FROM v_quote""", "v_quote"))
def q_normalize_quote_legacy(spark, sf_dir):
    q = v_quote(spark, sf_dir).drop("security_code", "exchange_code")
    return PR.normalize_quote_legacy(q, listing_id=7, interval_id=1)


@register("force_schema", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, TRY_CAST(p_name AS INTEGER) AS p_name,
       TRY_CAST(p_brand AS VARCHAR) AS p_brand, CAST(p_size AS DOUBLE) AS p_size,
       TRY_CAST(regexp_replace(p_brand, '^Brand#', '') AS BIGINT) AS brand_no
FROM part""")
def q_force_schema(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_size",
        F.regexp_replace("p_brand", "^Brand#", "").alias("brand_no"))
    return PR.force_schema(p, {"p_partkey": "string", "p_name": "int", "p_size": "double", "brand_no": "bigint"})


@register("case_id_type", with_views("""
SELECT code AS ticker, isin,
       CASE WHEN isin IS NOT NULL THEN isin WHEN code IS NOT NULL THEN code END AS idValue,
       CASE WHEN isin IS NOT NULL THEN 'ID_ISIN' WHEN code IS NOT NULL THEN 'TICKER' END AS idType
FROM v_security""", "v_security"))
def q_case_id_type(spark, sf_dir):
    s = _sec(spark, sf_dir).select(F.col("code").alias("ticker"), "isin")
    return PR.case_id_type(s)


@register("case_id_type_second_attempt", with_views("""
SELECT code AS ticker, isin, code AS idValue, 'TICKER' AS idType FROM v_security WHERE isin IS NOT NULL""",
                                                    "v_security"))
def q_case_id_type_second(spark, sf_dir):
    s = _sec(spark, sf_dir).select(F.col("code").alias("ticker"), "isin")
    return PR.case_id_type_second_attempt(s)


@register("derive_with_aliases", with_views("""
SELECT code, exchange_code, code || '_' || exchange_code AS security_uid,
       security_uid || '_' || type AS security_ticker_uid,
       IF(currency = 'USD', 'vendor', NULL) AS quote_source,
       IF(quote_source IS NOT NULL, currency, NULL) AS currency
FROM v_security""", "v_security"))
def q_derive_with_aliases(spark, sf_dir):
    return PR.derive_with_aliases(_sec(spark, sf_dir))


@register("drop_columns", with_views("SELECT * EXCLUDE (isin, size) FROM v_security", "v_security"))
def q_drop_columns(spark, sf_dir):
    return _sec(spark, sf_dir).drop("isin", "size")


@register("slugify_type", with_views("""
SELECT code, replace(lower(type), ' ', '_') AS type, replace(exchange_code, ' ', '_') AS exchange_code,
       replace(lower(name), ' ', '_') AS name_slug
FROM v_security""", "v_security"))
def q_slugify_type(spark, sf_dir):
    s = _sec(spark, sf_dir)
    return s.select("code", C.slugify(F.col("type")).alias("type"),
                    C.underscore_spaces(F.col("exchange_code")).alias("exchange_code"),
                    C.slugify(F.col("name")).alias("name_slug"))


@register("title_case", """
SELECT p_partkey, p_name, p_title FROM (
  SELECT p_partkey, p_name,
         list_aggr(list_transform(regexp_extract_all(upper(p_name) || '''S A.B-C ' || p_brand,
                                                     '(\\p{L}+|[^\\p{L}]+)'),
                                  lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') AS p_title
  FROM part)""")
def q_title_case(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    text = F.concat(F.upper("p_name"), F.lit("'S A.B-C "), F.col("p_brand"))
    return p.select("p_partkey", "p_name", C.title_case(text).alias("p_title"))


@register("null_self_reference", """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS mic,
       CAST(NULLIF(n_regionkey, n_nationkey) AS BIGINT) AS operating_exchange_id FROM nation""")
def q_null_self_reference(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("mic"),
                    C.null_self_reference(F.col("n_regionkey"), F.col("n_nationkey")).cast("bigint")
                    .alias("operating_exchange_id"))


@register("us_composite_code", with_views("""
SELECT code, CASE WHEN exchange_code IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'US' ELSE exchange_code END
       AS exchange_code FROM v_security""", "v_security"))
def q_us_composite_code(spark, sf_dir):
    s = _sec(spark, sf_dir)
    return s.select("code", C.us_composite_code(F.col("exchange_code"), ["Brand#1", "Brand#2", "Brand#3"])
                    .alias("exchange_code"))


@register("build_request_key", with_views("""
SELECT code, exchange_code, code || '.' || exchange_code AS request_key,
       'exchange=' || exchange_code || '/security=' || code AS path
FROM v_security""", "v_security"))
def q_build_request_key(spark, sf_dir):
    s = _sec(spark, sf_dir)
    return s.select("code", "exchange_code", C.request_key(F.col("code"), F.col("exchange_code")).alias("request_key"),
                    C.hive_path([("exchange", F.col("exchange_code")), ("security", F.col("code"))]).alias("path"))


# ------------------------------------------------------------------ 2.5

@register("count_rows", _sec_sql.__call__("size >= 10 AND type IN ('SMALL','LARGE')")
          .replace(f"SELECT {_SEC_COLS} FROM", "SELECT count(*) AS count FROM"))
def q_count_rows(spark, sf_dir):
    return A.count_rows(_sec(spark, sf_dir), {"minSize": 10, "type": ["SMALL", "LARGE"]}, SECURITY_FILTERS)


@register("value_counts", with_views("""
SELECT exchange_code AS key, count(*) AS count FROM v_security WHERE size >= 5 GROUP BY exchange_code""",
                                     "v_security"))
def q_value_counts(spark, sf_dir):
    return A.value_counts(_sec(spark, sf_dir), "exchange_code", {"minSize": 5}, SECURITY_FILTERS)


@register("value_counts_lineitem", """
SELECT CAST(l_suppkey AS BIGINT) AS key, count(*) AS count FROM lineitem GROUP BY l_suppkey""")
def q_value_counts_lineitem(spark, sf_dir):
    return A.value_counts(table(spark, sf_dir, "lineitem"), "l_suppkey")


@register("null_counts", with_views("""
SELECT CASE WHEN isin IS NULL THEN 'NULL' ELSE 'NOT_NULL' END AS key, count(*) AS count
FROM v_security WHERE type <> 'SMALL' GROUP BY 1""", "v_security"))
def q_null_counts(spark, sf_dir):
    return A.null_counts(_sec(spark, sf_dir), "isin", {"notType": ["SMALL"]}, SECURITY_FILTERS)


_CHOICES = {"type": "values", "exchange_code": "values", "isin": "nulls"}


@register("filter_choices", with_views("""
SELECT type AS key, count(*) AS count FROM v_security WHERE isin IS NOT NULL GROUP BY type""", "v_security"))
def q_filter_choices(spark, sf_dir):
    return A.filter_choices(_sec(spark, sf_dir), "type", _CHOICES, {"isinNotNull": True}, SECURITY_FILTERS)


@register("distinct_values", with_views("""
SELECT DISTINCT service FROM v_log WHERE level = 'ERROR'""", "v_log"))
def q_distinct_values(spark, sf_dir):
    return A.distinct_values(v_log(spark, sf_dir), "service", {"level": "ERROR", "service": "S2", "page": 1})


@register("distinct_rows", with_views("SELECT DISTINCT security_code, exchange_code FROM v_quote", "v_quote"))
def q_distinct_rows(spark, sf_dir):
    return A.distinct_rows(v_quote(spark, sf_dir), ["security_code", "exchange_code"])


@register("max_per_group", with_views("""
SELECT exchange_code, type, max(isin) AS isin, max(currency) AS currency, max(name) AS name
FROM v_security GROUP BY exchange_code, type""", "v_security"))
def q_max_per_group(spark, sf_dir):
    return A.max_per_group(_sec(spark, sf_dir), ["exchange_code", "type"], ["isin", "currency", "name"])


@register("distinct_count", "SELECT count(DISTINCT l_partkey) AS count FROM lineitem")
def q_distinct_count(spark, sf_dir):
    return A.distinct_count(table(spark, sf_dir, "lineitem"), "l_partkey")


@register("collect_aliases", with_views("""
SELECT figi, type, name, array_to_string(list_filter(names, lambda x: x <> name), '|') AS aliases, isins[1] AS isin
FROM (SELECT 'F' || exchange_code AS figi, min(type) AS type, min(name) AS name,
             list_sort(list_distinct(list(name))) AS names,
             list_sort(list_distinct(list(isin) FILTER (WHERE isin IS NOT NULL))) AS isins
      FROM v_security GROUP BY 1)""", "v_security"))
def q_collect_aliases(spark, sf_dir):
    s = _sec(spark, sf_dir).withColumn("figi", F.concat(F.lit("F"), F.col("exchange_code")))
    out = A.collect_aliases(s, "figi")
    return out.select("figi", "type", "name", F.array_join("aliases", "|").alias("aliases"), "isin")


@register("collect_aliases_rows", with_views("""
SELECT DISTINCT figi, name, alias FROM (SELECT 'F' || exchange_code AS figi, name AS alias, min(name) OVER (PARTITION BY exchange_code) AS name FROM v_security)
WHERE alias <> name""", "v_security"))
def q_collect_aliases_rows(spark, sf_dir):
    """A venue has as many names as the table: one row for each."""
    s = _sec(spark, sf_dir).withColumn("figi", F.concat(F.lit("F"), F.col("exchange_code")))
    return A.alias_rows(s, "figi")


@register("group_to_batches", with_views("""
SELECT exchange_code, type, batch, count(*) AS n_items, array_to_string(list_sort(list(code)), ',') AS codes
FROM (SELECT exchange_code, type, code,
             CAST((row_number() OVER (PARTITION BY exchange_code, type ORDER BY code) - 1) // 5 AS BIGINT) AS batch
      FROM v_security)
GROUP BY exchange_code, type, batch""", "v_security"))
def q_group_to_batches(spark, sf_dir):
    b = A.group_to_batches(_sec(spark, sf_dir), ["exchange_code", "type"], ["code"], max_items=5)
    return b.select("exchange_code", "type", "batch", F.size("items").cast("bigint").alias("n_items"),
                    F.array_join(F.transform("items", lambda x: x["code"]), ",").alias("codes"))


@register("slice_batches", with_views("""
SELECT code, CAST((row_number() OVER (ORDER BY code) - 1) // 60 AS BIGINT) AS batch_id FROM v_security""",
                                      "v_security"))
def q_slice_batches(spark, sf_dir):
    return A.slice_batches(_sec(spark, sf_dir).select("code"), 60, ["code"])


@register("slice_batches_per_exchange", with_views("""
SELECT code, exchange_code,
       CAST((row_number() OVER (PARTITION BY exchange_code ORDER BY code) - 1) // 50 AS BIGINT) AS batch_id
FROM v_security""", "v_security"))
def q_slice_batches_per_exchange(spark, sf_dir):
    return A.slice_batches(_sec(spark, sf_dir).select("code", "exchange_code"), 50, ["code"],
                           partition_by=["exchange_code"])


@register("map_lookup_rate", with_views("""
SELECT count(*) FILTER (WHERE isin IS NOT NULL) AS matched, count(*) FILTER (WHERE isin IS NULL) AS missing
FROM v_security""", "v_security"))
def q_map_lookup_rate(spark, sf_dir):
    return A.map_lookup_rate(_sec(spark, sf_dir), F.col("isin").isNotNull())


# ------------------------------------------------------------------ 2.6

@register("row_number_key", """
SELECT l_orderkey, l_linenumber, CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS BIGINT)
       AS row_id FROM lineitem""")
def q_row_number_key(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return A.row_number_key(li, ["l_orderkey", "l_linenumber"])


@register("is_unique_flag", """
SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) = 1 AS is_unique FROM (
  SELECT p_partkey, p_name || CASE WHEN p_partkey % 41 = 0 THEN '#' || CAST(p_partkey AS VARCHAR) ELSE '' END
         AS p_name FROM part)""")
def q_is_unique_flag(spark, sf_dir):
    from ..operators.quality import unique_flag
    p = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 41 == 0,
                                          F.concat(F.lit("#"), F.col("p_partkey").cast("string")))
                 .otherwise(F.lit(""))).alias("p_name"))
    return unique_flag(p, "p_name")


# ------------------------------------------------------------------ 2.7

@register("order_rows", with_views("""
SELECT code, isin, size FROM v_security ORDER BY isin ASC NULLS LAST, size DESC""", "v_security"))
def q_order_rows(spark, sf_dir):
    return FL.order_rows(_sec(spark, sf_dir).select("code", "isin", "size"), [("isin", "ASC"), ("size", "DESC")])


@register("paginate", with_views(f"""
SELECT {_SEC_COLS} FROM v_security WHERE size >= 10
ORDER BY name ASC NULLS LAST, id ASC LIMIT 25 OFFSET 50""", "v_security"))
def q_paginate(spark, sf_dir):
    s = FL.filter_set(_sec(spark, sf_dir), {"minSize": 10}, SECURITY_FILTERS)
    return FL.paginate(s, page=3, page_size=25, order=[("name", "ASC")], unique_key=["id"])


@register("paginate_page_zero", with_views(f"""
SELECT {_SEC_COLS} FROM v_security ORDER BY id LIMIT 10""", "v_security"))
def q_paginate_page_zero(spark, sf_dir):
    return FL.paginate(_sec(spark, sf_dir), page=0, page_size=10, unique_key=["id"])


@register("sort_skip_limit", with_views(f"""
SELECT {_LOG_COLS} FROM v_log ORDER BY created DESC, id LIMIT 25 OFFSET 25""", "v_log"))
def q_sort_skip_limit(spark, sf_dir):
    return FL.sort_skip_limit(v_log(spark, sf_dir), page=2, page_size=25)


@register("head_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def q_head_n(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return FL.head_n(o, 200, [("o_totalprice", "DESC"), ("o_orderkey", "ASC")])


@register("check_cardinality", "SELECT r_regionkey, r_name FROM region WHERE r_regionkey = 3")
def q_check_cardinality(spark, sf_dir):
    r = table(spark, sf_dir, "region").where(F.col("r_regionkey") == 3)
    return FL.check_cardinality(r, 0, 1)


# ------------------------------------------------------------------ 2.8

#: The nine windows of the performance job, by their first day.
_PERIODS = [("YEAR_TO_DATE", _dt.date(2001, 1, 1)), ("MONTH_TO_DATE", _dt.date(2001, 6, 1)),
            ("LAST_3_MONTH", _dt.date(2001, 3, 30)), ("LAST_12_MONTH", _dt.date(2000, 6, 30)),
            ("LAST_6_MONTH", _dt.date(2000, 12, 30)), ("LAST_1_MONTH", _dt.date(2001, 5, 30)),
            ("LAST_2_YEAR", _dt.date(1999, 6, 30)), ("LAST_5_YEAR", _dt.date(1996, 6, 30)),
            ("LAST_10_YEAR", _dt.date(1991, 6, 30))]


@register("union_all_periods", with_views("\nUNION ALL\n".join(
    f"SELECT security_code, exchange_code, '{name}' AS period, count(*) AS n_quotes FROM v_quote "
    f"WHERE date >= {lit(start)} AND date <= {lit(QUOTE_AS_OF)} GROUP BY ALL" for name, start in _PERIODS), "v_quote"))
def q_union_all_periods(spark, sf_dir):
    return S.union_all_periods(v_quote(spark, sf_dir), _PERIODS, QUOTE_AS_OF)


@register("union_distinct", """
SELECT CAST(l_partkey AS VARCHAR) AS code FROM lineitem WHERE l_returnflag = 'R'
UNION
SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size < 10""")
def q_union_distinct(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").cast("string").alias("code"))
    b = table(spark, sf_dir, "part").where(F.col("p_size") < 10).select(F.col("p_partkey").cast("string").alias("code"))
    return S.union_distinct(a, b)


@register("concat_frames", """
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_name, CAST(s_nationkey AS BIGINT) FROM supplier""")
def q_concat_frames(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"),
                                                F.col("c_name").alias("name"),
                                                F.col("c_nationkey").cast("bigint").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("bigint").alias("nation"),
                                                F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"),
                                                F.col("s_name").alias("name"))
    return S.concat_frames([c, s])


@register("append_virtual_exchange", """
SELECT DISTINCT p_brand AS code FROM part UNION ALL SELECT 'INDX'""")
def q_append_virtual_exchange(spark, sf_dir):
    codes = table(spark, sf_dir, "part").select(F.col("p_brand").alias("code")).distinct()
    return S.append_virtual_exchange(codes, "code", "INDX")
