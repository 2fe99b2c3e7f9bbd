"""``v_doc``: one vendor-style fundamental JSON document per order, built by
Spark from orders + lineitem (FIXTURES.md section 2). The oracle SQL in
``q_nested`` computes the flat metric rows straight from the tables, so the
check covers document building, parsing and reshaping together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .fixtures import table


def _cents(c: Column) -> Column:
    """``round(c * 100)`` as a number; below 2^52 the halves are exact, so that
    they are told without the decimal text that ``round`` goes through."""
    x = c * 100
    a = F.abs(x)
    whole = F.floor(a)
    up = whole + F.when(a - whole >= 0.5, 1).otherwise(0)
    return F.when(a < float(2**52), F.when(x < 0, -up).otherwise(up)).otherwise(F.round(x).cast("bigint"))


def _day(c: Column) -> Column:
    """A date as ``yyyy-MM-dd``; the plain cast says the same of all years
    of four digits and costs far less."""
    return F.when(F.year(c).between(1, 9999), c.cast("string")).otherwise(F.date_format(c, "yyyy-MM-dd"))


def _inner(text: Column) -> Column:
    """The members of a JSON object's text, without its braces, cut off by
    bytes: no characters are counted."""
    return F.substring(text.cast("binary"), F.lit(2), F.octet_length(text) - 2).cast("string")


def _text(name: str, c: Column | str) -> Column:
    """``"name":"value"`` of text that needs no escapes, NULL of NULL."""
    return F.concat(F.lit(f'"{name}":"'), c, F.lit('"'))


def _number(name: str, c: Column | str) -> Column:
    return F.concat(F.lit(f'"{name}":'), (F.col(c) if isinstance(c, str) else c).cast("string"))


def _sections() -> dict[str, Column]:
    """The record of one line in every section of its order's document, as
    JSON text. Dates and numbers need no escapes: their members are put
    together as they are, without those that are NULL."""
    def members(*ms):
        return F.concat(F.lit("{"), F.concat_ws(",", *ms), F.lit("}"))

    usd = F.lit('"currency_symbol":"USD"')
    return {
        "components": F.to_json(F.struct(
            F.col("part_s").alias("Code"), F.concat(F.lit("Part "), "part_s").alias("Name"),
            F.col("l_linestatus").alias("Exchange"), F.col("l_returnflag").alias("Sector"))),
        "officers": members(F.concat(F.lit('"Name":"Clerk '), F.col("l_suppkey").cast("string"), F.lit('"')),
                            F.concat(F.lit('"Title":"T'), F.col("l_linenumber").cast("string"), F.lit('"')),
                            _number("YearBorn", F.lit(1950) + F.col("l_linenumber"))),
        "bs": members("m_date", "m_filing", usd, _number("totalAssets", "ext_c"), _number("totalLiab", "qty")),
        "inc": members("m_date", "m_filing", usd, _number("totalRevenue", "ext_c"), _number("netIncome", "disc_c")),
        "cf": members("m_date", "m_filing", usd, _number("freeCashFlow", "tax_c")),
        "os": members(_text("date", "year_s"), _text("dateFormatted", "ship_s"), _number("shares", F.col("qty") * 1000)),
        "eh": members(_text("reportDate", "report_s"), "m_date", _number("epsActual", "qty"), F.lit('"currency":"USD"')),
        "et": members("m_date", F.lit('"period":"0q"'), _number("growth", "l_linenumber")),
        "ea": members("m_date", _number("epsActual", "ext_c")),
    }


def v_doc(spark, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    # Only the plain values of a line are shuffled. Its records are written as
    # JSON text where the lines of its order stand together, in order, so that
    # a document is put together from the texts of its lines.
    li = table(spark, sf_dir, "lineitem").where(F.col("l_orderkey").isNotNull()).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_linestatus", "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("qty"),
        _cents(F.col("l_extendedprice")).alias("ext_c"), _cents(F.col("l_discount")).alias("disc_c"),
        _cents(F.col("l_tax")).alias("tax_c"))
    order = [c for c in li.columns if c != "l_orderkey"]
    # The plain values are few bytes beside the documents made of them: merged
    # by their bytes, the tasks would be too few and uneven for that work.
    li = li.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    by_order = W.partitionBy("l_orderkey").orderBy(*order)
    day = F.to_date("l_shipdate")
    li = li.select("*", F.row_number().over(by_order).alias("n")).select(
        "*", _day(day).alias("ship_s"), _day(F.date_add(day, 30)).alias("filing_s"),
        _day(F.date_add(day, 45)).alias("report_s"), F.year("l_shipdate").cast("string").alias("year_s"),
        F.col("l_partkey").cast("string").alias("part_s"))
    li = li.withColumns({"m_date": _text("date", "ship_s"), "m_filing": _text("filing_date", "filing_s")})
    key = F.concat(F.lit('"'), (F.col("n") - 1).cast("string"), F.lit('":'))
    sections = _sections()
    texts = li.select("l_orderkey", *order, "n",
                      F.struct(*[F.concat(key, r).alias(n) for n, r in sections.items()]).alias("s"))
    whole = by_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    lines = texts.select("l_orderkey", "n", F.collect_list("s").over(whole).alias("ls")).where("n = 1").select(
        "l_orderkey", *[F.array_join(F.col(f"ls.{n}"), ",").alias(n) for n in sections])
    # The per-order side grows with the data: a shuffle join, never a broadcast.
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    order_day = _day(F.to_date("o_orderdate"))

    def members(*names: tuple[str, str], first: str = ","):
        """``"name":{...}`` of the sections; nothing where there are no lines."""
        pieces = [p for i, (name, c) in enumerate(names)
                  for p in (F.lit(f'{"}," if i else first}"{name}":{{'), F.col(c))]
        return F.coalesce(F.concat(*pieces, F.lit("}")), F.lit(""))

    general = _inner(F.to_json(F.struct(
        k.cast("string").alias("Code"),
        F.when(F.col("o_orderstatus") == "O", F.lit("ETF")).otherwise(F.lit("Common Stock")).alias("Type"),
        F.concat(F.lit("Order "), k.cast("string")).alias("Name"),
        F.col("o_orderpriority").alias("Exchange"),
        F.lit("USD").alias("CurrencyCode"),
        F.col("o_orderstatus").alias("CountryISO"),
        F.concat(F.lit("IS"), cust.cast("string")).alias("ISIN"),
        (k % 2 == 0).alias("IsDelisted"),
        cust.alias("FullTimeEmployees"),
        F.struct(F.concat(F.lit("Street "), cust.cast("string")).alias("Street"),
                 F.concat(F.lit("City "), (cust % 10).cast("string")).alias("City"),
                 F.concat(F.lit("C"), (cust % 3).cast("string")).alias("Country")).alias("AddressData"),
        F.create_map(F.lit("0"), F.struct(k.cast("string").alias("Code"),
                                          F.concat(F.lit("L"), (cust % 5).cast("string")).alias("Exchange")))
        .alias("Listings"))))
    flat = _inner(F.to_json(F.struct(
        F.struct(_cents(F.col("o_totalprice")).alias("MarketCapitalization"), (cust * 10).alias("EBITDA"),
                 order_day.alias("MostRecentQuarter")).alias("Highlights"),
        F.struct((k % 50).alias("TrailingPE")).alias("Valuation"),
        F.struct((cust * 1000).alias("SharesOutstanding")).alias("SharesStats"),
        F.struct((k % 7).alias("Beta")).alias("Technicals"),
        F.struct(F.lit("2:1").alias("LastSplitFactor"), order_day.alias("LastSplitDate"),
                 (cust % 100).alias("PayoutRatio")).alias("SplitsDividends"))))

    def periodic(name: str, c: str) -> list[Column]:
        return [F.lit(f'"{name}":{{"currency_symbol":"USD"'), members(("yearly", c), ("quarterly", c)), F.lit("}")]

    text = F.concat(
        F.lit('{"General":{'), general, members(("Officers", "officers")), F.lit("},"), flat,
        members(("Components", "components")),
        F.lit(',"Financials":{'), *periodic("Balance_Sheet", "bs"), F.lit(","), *periodic("Income_Statement", "inc"),
        F.lit(","), *periodic("Cash_Flow", "cf"),
        F.lit('},"outstandingShares":{'), members(("annual", "os"), ("quarterly", "os"), first=""),
        F.lit('},"Earnings":{'), members(("History", "eh"), ("Trend", "et"), ("Annual", "ea"), first=""),
        F.lit("}}"))
    return j.select(k.alias("doc_id"), text.alias("doc_text"))


# ----------------------------------------------------------------- oracle SQL
# The flat rows the documents must produce, from the tables directly.

DOC_BASE_SQL = {
    "o": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, "
         "CAST(o_orderdate AS DATE) AS od, CAST(o_orderkey AS VARCHAR) AS security_code, "
         "o_orderpriority AS exchange_code FROM orders WHERE o_orderstatus <> 'O'",
    "l": "SELECT l.*, CAST(l_shipdate AS DATE) AS sd, o.security_code, o.exchange_code "
         "FROM lineitem l JOIN o ON l.l_orderkey = o.o_orderkey",
}


def cents_sql(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"
