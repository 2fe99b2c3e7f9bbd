"""Registered queries for SURVEY 2.9 (nested data, JSON, reshape) and the
sixteen fundamental categories."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import fundamentals as FU
from ..operators import nested as N
from .docs import DOC_BASE_SQL, cents_sql, v_doc
from .fixtures import table, v_exchange, v_security, with_views
from .registry import register

_NULLS = ("CAST(NULL AS VARCHAR) AS currency, CAST(NULL AS DATE) AS period, "
          "CAST(NULL AS VARCHAR) AS period_type, CAST(NULL AS DATE) AS published_at")


def _metric_values(names) -> str:
    return "(VALUES " + ", ".join(f"('{n}')" for n in names) + ") f(metric)"


def _struct_sql(category: str, fields, cases: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in cases.items())
    return with_views(f"""
SELECT '{category}' AS category, f.metric, CASE f.metric {whens} END AS value, {_NULLS},
       exchange_code, security_code
FROM o CROSS JOIN {_metric_values(fields)}""", extra=DOC_BASE_SQL)


_PERIODS = "(VALUES ('year', 'yearly'), ('quarter', 'quarterly')) p(g, pt)"


def _records_sql(category: str, cases: dict[str, str], *, periods: str = _PERIODS, currency: str = "'USD'",
                 published: str = "CAST(sd + 30 AS DATE)") -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in cases.items())
    return with_views(f"""
SELECT '{category}' AS category, f.metric, CASE f.metric {whens} END AS value, {currency} AS currency,
       CAST(date_trunc(p.g, sd) AS DATE) AS period, p.pt AS period_type, {published} AS published_at,
       exchange_code, security_code
FROM l CROSS JOIN {_metric_values(cases)} CROSS JOIN {periods}""", extra=DOC_BASE_SQL)


def _fund(name, sql):
    @register(name, sql)
    def _q(spark, sf_dir, _name=name):
        return FU.fund_category(v_doc(spark, sf_dir), _name)
    return _q


_GEN_METRICS = [f for g in FU.GENERAL_FIELDS for f in (FU.ADDRESS_FIELDS if g == "AddressData" else [g])]

_fund("fund_general", _struct_sql("general", _GEN_METRICS, {
    "Code": "security_code", "Type": "'Common Stock'", "Name": "'Order ' || security_code",
    "Exchange": "o_orderpriority", "CurrencyCode": "'USD'", "CountryISO": "o_orderstatus",
    "ISIN": "'IS' || CAST(o_custkey AS VARCHAR)",
    "IsDelisted": "CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END",
    "FullTimeEmployees": "CAST(o_custkey AS VARCHAR)",
    "Street": "'Street ' || CAST(o_custkey AS VARCHAR)", "City": "'City ' || CAST(o_custkey % 10 AS VARCHAR)",
    "Country": "'C' || CAST(o_custkey % 3 AS VARCHAR)"}))

_fund("fund_listing", with_views(f"""
SELECT 'general' AS category, 'listing' AS metric,
       '[{{"Code":"' || security_code || '","Exchange":"L' || CAST(o_custkey % 5 AS VARCHAR) || '"}}]' AS value,
       {_NULLS}, exchange_code, security_code FROM o""", extra=DOC_BASE_SQL))

_fund("fund_people", with_views(f"""
SELECT 'general' AS category, 'people' AS metric,
       CAST(to_json(list({{'Name': 'Clerk ' || CAST(l_suppkey AS VARCHAR), 'Title': 'T' || CAST(l_linenumber AS VARCHAR),
                          'YearBorn': CAST(1950 + l_linenumber AS VARCHAR)}}
                         ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate)) AS VARCHAR) AS value,
       {_NULLS}, exchange_code, security_code FROM l GROUP BY exchange_code, security_code""", extra=DOC_BASE_SQL))

_fund("fund_balance_sheet", _records_sql("balance_sheet", {
    "totalAssets": f"CAST({cents_sql('l_extendedprice')} AS VARCHAR)",
    "totalLiab": "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"}))
_fund("fund_income_statement", _records_sql("income_statement", {
    "totalRevenue": f"CAST({cents_sql('l_extendedprice')} AS VARCHAR)",
    "netIncome": f"CAST({cents_sql('l_discount')} AS VARCHAR)"}))
_fund("fund_cash_flow", _records_sql("cash_flow_statement", {
    "freeCashFlow": f"CAST({cents_sql('l_tax')} AS VARCHAR)"}))
_fund("fund_outstanding_shares", _records_sql("outstanding_shares", {
    "shares": "CAST(CAST(l_quantity AS BIGINT) * 1000 AS VARCHAR)"},
    currency="CAST(NULL AS VARCHAR)", published="CAST(NULL AS DATE)"))
_fund("fund_earning_history", _records_sql("earning_history", {
    "epsActual": "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)", "currency": "'USD'"},
    periods="(VALUES ('quarter', 'quarterly')) p(g, pt)", currency="CAST(NULL AS VARCHAR)",
    published="CAST(sd + 45 AS DATE)"))
_fund("fund_earning_trend", _records_sql("earning_trend", {
    "period": "'0q'", "growth": "CAST(l_linenumber AS VARCHAR)"},
    periods="(VALUES ('quarter', 'quarterly')) p(g, pt)", currency="CAST(NULL AS VARCHAR)",
    published="CAST(NULL AS DATE)"))
_fund("fund_earning_per_share", _records_sql("earning_per_share", {
    "epsActual": f"CAST({cents_sql('l_extendedprice')} AS VARCHAR)"},
    periods="(VALUES ('year', 'yearly')) p(g, pt)", currency="CAST(NULL AS VARCHAR)",
    published="CAST(NULL AS DATE)"))

_fund("fund_highlight", _struct_sql("highlight", FU.HIGHLIGHT_FIELDS, {
    "MarketCapitalization": f"CAST({cents_sql('o_totalprice')} AS VARCHAR)",
    "EBITDA": "CAST(o_custkey * 10 AS VARCHAR)", "MostRecentQuarter": "strftime(od, '%Y-%m-%d')"}))
_fund("fund_valuation", _struct_sql("valuation", FU.VALUATION_FIELDS, {
    "TrailingPE": "CAST(o_orderkey % 50 AS VARCHAR)"}))
_fund("fund_share_stat", _struct_sql("share_stat", FU.SHARE_STAT_FIELDS, {
    "SharesOutstanding": "CAST(o_custkey * 1000 AS VARCHAR)"}))
_fund("fund_technical", _struct_sql("technical", FU.TECHNICAL_FIELDS, {
    "Beta": "CAST(o_orderkey % 7 AS VARCHAR)"}))
_fund("fund_dividend", _struct_sql("dividend", FU.DIVIDEND_FIELDS, {
    "PayoutRatio": "CAST(o_custkey % 100 AS VARCHAR)"}))
_fund("fund_share_split", _struct_sql("share_split", FU.SHARE_SPLIT_FIELDS, {
    "LastSplitFactor": "'2:1'", "LastSplitDate": "strftime(od, '%Y-%m-%d')"}))


@register("fund_all")
def q_fund_all(spark, sf_dir):
    """All sixteen categories in one job (rows-only check; each category has
    its own oracle above)."""
    return FU.fund_all(v_doc(spark, sf_dir))


# ------------------------------------------------------------- generic reshape

_COMP_SCHEMA = T.StructType([
    T.StructField("General", T.MapType(T.StringType(), T.StringType())),
    T.StructField("Components", T.MapType(T.StringType(), T.StructType([
        T.StructField("Code", T.StringType()), T.StructField("Name", T.StringType()),
        T.StructField("Exchange", T.StringType()), T.StructField("Sector", T.StringType())]))),
])

_MEMBERS_SQL = """
SELECT CAST(l_partkey AS VARCHAR) AS security_code, 'Part ' || CAST(l_partkey AS VARCHAR) AS security_name,
       l_linestatus AS exchange_code, l_returnflag AS sector, CAST(o_orderkey AS VARCHAR) AS index_code,
       'Order ' || CAST(o_orderkey AS VARCHAR) AS index_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@register("map_values_explode", _MEMBERS_SQL)
def q_map_values_explode(spark, sf_dir):
    d = v_doc(spark, sf_dir).select(F.from_json("doc_text", _COMP_SCHEMA).alias("d")).select("d.*")
    keep = [N.map_get(F.col("General"), "Code").alias("index_code"),
            N.map_get(F.col("General"), "Name").alias("index_name")]
    m = N.map_values_explode(d, "Components", keep)
    return m.select(F.col("Code").alias("security_code"), F.col("Name").alias("security_name"),
                    F.col("Exchange").alias("exchange_code"), F.col("Sector").alias("sector"),
                    "index_code", "index_name")


@register("unpivot_struct_members", _MEMBERS_SQL)
def q_unpivot_struct_members(spark, sf_dir):
    docs = v_doc(spark, sf_dir)
    # the members' names are data: no key set becomes columns
    d = docs.select(F.explode(F.array(F.from_json("doc_text", _COMP_SCHEMA))).alias("d")).select(
        N.map_get(F.col("d.General"), "Code").alias("index_code"),
        N.map_get(F.col("d.General"), "Name").alias("index_name"), F.col("d.Components").alias("Components"))
    long = N.unpivot_map_members(d, "Components", ["index_code", "index_name"])
    return long.select(F.col("member.Code").alias("security_code"), F.col("member.Name").alias("security_name"),
                       F.col("member.Exchange").alias("exchange_code"), F.col("member.Sector").alias("sector"),
                       "index_code", "index_name")


_ADDR_SCHEMA = T.StructType([T.StructField("General", T.StructType([
    T.StructField("Code", T.StringType()),
    T.StructField("AddressData", T.StructType([T.StructField(f, T.StringType()) for f in FU.ADDRESS_FIELDS]))]))])


@register("struct_unnest", """
SELECT CAST(o_orderkey AS VARCHAR) AS Code, 'Street ' || CAST(o_custkey AS VARCHAR) AS Street,
       'City ' || CAST(o_custkey % 10 AS VARCHAR) AS City, CAST(NULL AS VARCHAR) AS State,
       'C' || CAST(o_custkey % 3 AS VARCHAR) AS Country, CAST(NULL AS VARCHAR) AS ZIP FROM orders""")
def q_struct_unnest(spark, sf_dir):
    d = v_doc(spark, sf_dir).select(F.from_json("doc_text", _ADDR_SCHEMA).alias("d")).select("d.General.*")
    return N.struct_unnest(d, "AddressData")


@register("deep_get", """
SELECT o_orderkey AS doc_id, CAST(o_orderkey AS VARCHAR) AS code, 'USD' AS bs_currency,
       CAST(NULL AS VARCHAR) AS missing, CAST(o_custkey * 10 AS VARCHAR) AS ebitda,
       'City ' || CAST(o_custkey % 10 AS VARCHAR) AS city FROM orders""")
def q_deep_get(spark, sf_dir):
    d = v_doc(spark, sf_dir)
    t = F.col("doc_text")
    return d.select("doc_id", N.deep_get(t, ["General", "Code"]).alias("code"),
                    N.deep_get(t, ["Financials", "Balance_Sheet", "currency_symbol"]).alias("bs_currency"),
                    N.deep_get(t, ["General", "Missing", "Key"]).alias("missing"),
                    N.deep_get(t, ["Highlights", "EBITDA"]).alias("ebitda"),
                    N.deep_get(t, ["General", "AddressData", "City"]).alias("city"))


def _exchange_json(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    doc = F.struct(
        F.col("n_name").alias("name"), F.col("n_name").alias("mic"),
        F.struct(F.concat(F.lit("CUR"), F.col("n_regionkey").cast("string")).alias("code")).alias("currency"),
        F.struct(F.concat(F.lit("TZ/"), k.cast("string")).alias("timezone")).alias("timezone"),
        F.struct(F.format_string("%02d:30:00", F.lit(8) + k % 3).alias("Open"),
                 F.format_string("%02d:00:00", F.lit(16) + k % 2).alias("Close"),
                 F.format_string("%02d:30:00", F.lit(13) + k % 3).alias("OpenUTC"),
                 F.format_string("%02d:00:00", F.lit(21) + k % 2).alias("CloseUTC"),
                 F.when(k % 2 == 0, F.lit("Mon,Tue,Wed,Thu,Fri")).otherwise(F.lit("Sun,Mon,Tue,Wed,Thu,Fri"))
                 .alias("WorkingDays")).alias("TradingHours"))
    return n.select(F.to_json(doc).alias("t"))


_EXCH_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("mic", T.StringType()),
    T.StructField("currency", T.StructType([T.StructField("code", T.StringType())])),
    T.StructField("timezone", T.StructType([T.StructField("timezone", T.StringType())])),
    T.StructField("TradingHours", T.StructType([T.StructField(f, T.StringType()) for f in
                                                ["Open", "Close", "OpenUTC", "CloseUTC", "WorkingDays"]])),
])


@register("struct_field", """
SELECT n_name AS mic, 'CUR' || CAST(n_regionkey AS VARCHAR) AS currency,
       'TZ/' || CAST(n_nationkey AS VARCHAR) AS timezone FROM nation""")
def q_struct_field(spark, sf_dir):
    d = _exchange_json(spark, sf_dir).select(F.from_json("t", _EXCH_SCHEMA).alias("d"))
    return d.select(F.col("d.mic").alias("mic"), F.col("d.currency.code").alias("currency"),
                    F.col("d.timezone.timezone").alias("timezone"))


@register("build_struct", """
SELECT n_name AS mic, (8 + n_nationkey % 3) * 60 + 30 AS open_minutes, (16 + n_nationkey % 2) * 60 AS close_minutes,
       (21 + n_nationkey % 2) * 60 AS close_utc_minutes,
       CASE WHEN n_nationkey % 2 = 0 THEN 5 ELSE 6 END AS n_working_days,
       CASE WHEN n_nationkey % 2 = 0 THEN 'Mon' ELSE 'Sun' END AS first_day FROM nation""")
def q_build_struct(spark, sf_dir):
    from ..functions.dates import try_parse_time
    d = _exchange_json(spark, sf_dir).select(F.from_json("t", _EXCH_SCHEMA).alias("d"))
    th = F.col("d.TradingHours")
    hours = F.struct(*[try_parse_time(th[f]).alias(f) for f in ["Open", "Close", "OpenUTC", "CloseUTC"]])
    s = d.select(F.col("d.mic").alias("mic"), hours.alias("hours"),
                 N.split_list(th["WorkingDays"]).alias("days"))

    def minutes(c):
        return (F.hour(c) * 60 + F.minute(c)).cast("int")
    return s.select("mic", minutes(F.col("hours.Open")).alias("open_minutes"),
                    minutes(F.col("hours.Close")).alias("close_minutes"),
                    minutes(F.col("hours.CloseUTC")).alias("close_utc_minutes"),
                    F.size("days").alias("n_working_days"), N.first_or_null(F.col("days")).alias("first_day"))


@register("array_ops", """
SELECT l_orderkey, count(*) AS n_parts, count(DISTINCT l_partkey) AS n_distinct,
       count(DISTINCT l_partkey) FILTER (WHERE l_partkey >= 1000) AS n_big,
       min(l_partkey) AS first_part FROM lineitem GROUP BY l_orderkey""")
def q_array_ops(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("parts"))
    dist = F.array_distinct("parts")
    return g.select("l_orderkey", F.size("parts").cast("bigint").alias("n_parts"),
                    F.size(dist).cast("bigint").alias("n_distinct"),
                    F.size(F.filter(dist, lambda x: x >= 1000)).cast("bigint").alias("n_big"),
                    N.first_or_null(F.array_sort(dist)).alias("first_part"))


@register("json_object", with_views("""
SELECT id, CAST(json_object('id', id, 'mic', mic, 'name', name) AS VARCHAR) AS exchange FROM v_exchange""",
                                    "v_exchange"))
def q_json_object(spark, sf_dir):
    e = v_exchange(spark, sf_dir)
    return e.select("id", F.to_json(F.struct("id", "mic", "name"), {"ignoreNullFields": "false"}).alias("exchange"))


@register("row_to_json", with_views("""
SELECT code, CAST(to_json({'code': code, 'name': name, 'isin': isin, 'size': size}) AS VARCHAR) AS row_json
FROM v_security""", "v_security"))
def q_row_to_json(spark, sf_dir):
    s = v_security(spark, sf_dir)
    return s.select("code", F.to_json(F.struct("code", "name", "isin", "size"),
                                      {"ignoreNullFields": "false"}).alias("row_json"))


@register("json_array_agg", """
SELECT l_orderkey, CAST(to_json(list(l_partkey ORDER BY l_partkey)) AS VARCHAR) AS parts
FROM lineitem GROUP BY l_orderkey""")
def q_json_array_agg(spark, sf_dir):
    # one JSON array per order (an order has a bounded number of lines)
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list("l_partkey"))).alias("parts"))
