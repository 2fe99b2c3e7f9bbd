"""Building, parsing and reshaping of documents; trigram sets (findings of
round 3)."""

import datetime as dt
import json
import re

from bourse.functions.dates import try_parse_date
from bourse.operators import fundamentals as FU
from bourse.operators import lookup as L
from bourse.operators import nested as N
from bourse.operators import search as SE
from bourse.plans.docs import _cents, v_doc
from bourse.plans.jobs import job_index_member
from bourse.plans.q_jobs import q_job_fundamental_rejects
from bourse.plans.q_joins import q_cross_join_ten_years
from pyspark.sql import functions as F


def _tables(spark, path, lines, orders):
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                                  "o_orderpriority string").write.parquet(f"{path}/orders.parquet")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_shuffle_plain_values_and_keep_their_text(spark, tmp_path):
    t = dt.datetime(1999, 2, 28, 7)
    _tables(spark, str(tmp_path), [(1, 5, 6, 2, 3.0, 1.5, 0.1, 0.02, 'a"b', "F", t), (1, 4, None, 1, 1.0, 2.0, None, 0.0, None, "\\", None),
                                   (1, 5, 6, 2, 3.0, 1.5, 0.1, 0.02, 'a"b', "F", t), (None, 9, 9, 9, 9.0, 9.0, 0.0, 0.0, "N", "O", t)],
            [(1, 10, "F", 9.99, t, '1-"U"'), (2, None, None, None, None, None), (None, 3, "O", 1.0, t, "x"), (1, 11, "O", 1.0, t, "y")])
    docs = v_doc(spark, str(tmp_path))
    plan = _plan(docs)
    # records are text before they are gathered, no map is built of an order
    assert "map_from_entries" not in plan and "lambdafunction" not in plan
    got = {(r.doc_id, json.loads(r.doc_text)["General"].get("FullTimeEmployees")): json.loads(r.doc_text) for r in docs.collect()}
    assert set(got) == {(1, 10), (1, 11), (2, None), (None, 3)}
    d = got[(1, 10)]
    first, last = {"date": "1999-02-28", "filing_date": "1999-03-30"}, {"currency_symbol": "USD"}
    assert d["Components"] == {"0": {"Code": "4", "Name": "Part 4", "Exchange": "\\"},
                               **{k: {"Code": "5", "Name": "Part 5", "Exchange": "F", "Sector": 'a"b'} for k in "12"}}
    assert d["Financials"]["Income_Statement"]["yearly"] == d["Financials"]["Income_Statement"]["quarterly"] == {
        "0": {**last, "totalRevenue": 200}, **{k: {**first, **last, "totalRevenue": 150, "netIncome": 10} for k in "12"}}
    assert d["General"]["Officers"]["0"] == {"Title": "T1", "YearBorn": 1951} and d["General"]["Exchange"] == '1-"U"'
    bare = got[(2, None)]
    assert bare["outstandingShares"] == bare["Earnings"] == bare["Highlights"] == {} and "Components" not in bare
    assert bare["Financials"]["Cash_Flow"] == {"currency_symbol": "USD"} and "Officers" not in bare["General"]


def test_only_possible_common_stock_is_parsed(spark):
    texts = ['{"General":{"Code":"A","Type":"Common Stock","Exchange":"X"},"Valuation":{"TrailingPE":1}}',
             '{"General":{"Code":"B","Type":"Common\\u0020Stock","Exchange":"X"},"Valuation":{"TrailingPE":2}}',
             '{"General":{"Code":"C","Type":"ETF","Exchange":"X"},"Valuation":{"TrailingPE":3}}', "Common Stock", None]
    docs = spark.createDataFrame([(t,) for t in texts], "doc_text string")
    rows = FU.fund_category(docs, "fund_valuation")
    assert re.search(r"from_json\(.*CASE WHEN .*contains", _plan(rows), re.I)
    got = {(r.security_code, r.value) for r in rows.where("metric = 'TrailingPE'").collect()}
    assert got == {("A", "1"), ("B", "2")} and rows.count() == 2 * len(FU.VALUATION_FIELDS)


def test_a_sub_object_is_parsed_once_for_its_fields(spark):
    docs = spark.createDataFrame([('{"General":{"Code":"A","Type":"Common Stock","AddressData":{"Street":"S","ZIP":"1"}}}',)], "doc_text string")
    rows = FU.fund_category(docs, "fund_general")
    generate = [g for g in _plan(rows).splitlines() if "Generate inline" in g]
    assert len(generate) == 1 and generate[0].count("AddressData") == 1
    got = [(r.metric, r.value) for r in rows.collect()]
    names = [f for g in FU.GENERAL_FIELDS for f in (FU.ADDRESS_FIELDS if g == "AddressData" else [g])]
    assert [m for m, _ in got] == names
    assert {m: v for m, v in got if v} == {"Code": "A", "Type": "Common Stock", "Street": "S", "ZIP": "1"}


def test_usual_dates_are_cast_and_others_parsed(spark):
    texts = ["2001-02-28", "2001-02-30", "0000-01-01", "0001-01-01", "2001-2-3", " 2001-02-03", "2001-02-03\n", "2001-02-03T00:00:00", "+12345-01-01", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", try_parse_date(F.col("t"), "yyyy-MM-dd").cast("string").alias("a"),
                    F.to_date(F.try_to_timestamp("t", F.lit("yyyy-MM-dd"))).cast("string").alias("b"))
    assert "cast(t" in _plan(got).lower()
    for r in got.collect():
        assert r.a == r.b, r


def test_a_text_is_split_once_for_its_similarity(spark):
    df = spark.createDataFrame([(1, "Ab ab, cd"), (2, "..."), (3, ""), (4, None)], "id long, t string")
    out = SE.trigram_similarity(df, "id", "t", "ab ce", threshold=0.0)
    assert _plan(out).count("regexp_extract_all(") == _plan(out).count("split(lower(") == 1
    # '  a' ' ab' 'ab ' are shared, '  c' too; 'ce ' and ' ce' against 'cd ' and ' cd'
    assert {r.id: r.similarity for r in out.collect()} == {1: 4 / 8, 2: 0.0, 3: 0.0, 4: 0.0}


def test_ten_years_of_days_are_grouped_by_a_number_of_their_key(spark, tmp_path):
    t = dt.datetime(1999, 2, 28, 7)
    _tables(spark, str(tmp_path), [(1, part, 6, n, 3.0, 1.5, 0.1, 0.02, "N", status, t)
                                   for n, (part, status) in enumerate([(5, "F"), (5, "F"), (5, None), (None, "O"), (None, None)])], [])
    out = q_cross_join_ten_years(spark, str(tmp_path))
    groups = re.findall(r"Aggregate \[([^\]]*)\]", _plan(out))
    assert groups and not any("security_code" in g for g in groups)
    rows = out.collect()
    assert {(r.security_code, r.exchange_code) for r in rows} == {("5", "F"), ("5", None), (None, "O"), (None, None)}
    assert len(rows) == 4 * 11 and sum(r.n_days for r in rows) == 4 * 3653
    assert {(r.n_days, r.first_day, r.last_day) for r in rows if r.year == 1996} == {(366, dt.date(1996, 1, 1), dt.date(1996, 12, 31))}


def test_a_cross_join_is_dealt_to_tasks_by_its_keys(spark):
    left = spark.range(10).selectExpr("if(id = 3, null, string(id)) k").union(spark.createDataFrame([("1",), (None,)], "k string"))
    right = spark.createDataFrame([(7, "a"), (9, "a"), (1, "b")], "v int, g string")
    out = L.cross_join_agg(left, right, ["g"], [F.sum("v").alias("s")], keys_per_task=2)
    assert out.columns == ["k", "g", "s"]
    keys = [str(i) if i != 3 else None for i in range(10)]
    assert sorted(map(str, out.collect())) == sorted(str(r) for r in spark.createDataFrame([(k, g, s) for k in keys for g, s in (("a", 16), ("b", 1))], "k string, g string, s long").collect())
    assert "RepartitionByExpression [_key" in _plan(out) and re.search(r"RepartitionByExpression \[_key#\d+L\], 6", _plan(out))


def test_a_text_without_a_key_is_not_parsed_for_it(spark):
    texts = ['{"a":{"b":1.50}}', '{"a":{"c":2}}', '{"a":{"\\u0062":3}}', '{"a":{"b":null}}', "{'a':{'b':'x'}}", '{"b":{"a":5}}', '{"a":{"b":6}', "", "b a", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for path in (["a", "b"], ["a"], ["a", "*"], ["*"], []):
        plain = F.get_json_object("t", "$" + "".join(f"['{k}']" for k in path))
        got = df.select("i", N.deep_get(F.col("t"), path).alias("v"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.select("i", plain).collect())), path
    assert "Contains(t#" in _plan(df.select(N.deep_get(F.col("t"), ["a", "b"])))


def test_documents_are_dealt_to_all_partitions_and_few_lines_go_through_to_json(spark, tmp_path):
    t = dt.datetime(1999, 12, 31, 7)
    _tables(spark, str(tmp_path), [(1, None, None, None, None, None, None, None, None, None, None), (2, 5, 6, 2, 3.0, -1.005, 0.285, 0.02, "\u00e9", "F", t)],
            [(1, 10, "F", 9.99, t, "x"), (2, 10, "F", 9.99, t, "\u00e9}")])
    docs = v_doc(spark, str(tmp_path))
    plan = _plan(docs)
    n = spark.conf.get("spark.sql.shuffle.partitions")
    assert re.search(rf"RepartitionByExpression \[l_orderkey#\d+L\], {n}\b", plan)
    # the members, whose text may need escapes, and twice each (text and its length) General and the flat sections
    assert plan.count("StructsToJsonEvaluator(") == 1 + 2 * 2
    one, two = [json.loads(r.doc_text) for r in docs.orderBy("doc_id").collect()]
    assert one["Components"] == one["General"]["Officers"] == one["Earnings"]["Annual"] == {"0": {}}
    assert one["Financials"]["Cash_Flow"]["yearly"] == {"0": {"currency_symbol": "USD"}}
    assert one["Earnings"]["Trend"] == {"0": {"period": "0q"}} and one["Earnings"]["History"] == {"0": {"currency": "USD"}}
    assert two["Components"]["0"]["Sector"] == "\u00e9" and two["General"]["Exchange"] == "\u00e9}"
    assert two["Financials"]["Income_Statement"]["yearly"]["0"] == {
        "date": "1999-12-31", "filing_date": "2000-01-30", "currency_symbol": "USD", "totalRevenue": -100, "netIncome": 28}


def test_cents_are_rounded_as_by_round(spark):
    values = [0.0, -0.0, 0.005, -0.005, 0.015, 0.285, -0.285, 1.005, 2.675, 0.49999999999999994 / 100, 104949.5, -0.125, 0.375, 45035996273704.97,
              -45035996273704.955, 90071992547409.93, 123456789012.345, None]
    df = spark.createDataFrame([(v,) for v in values + [i / 1000 for i in range(-3000, 3000, 5)]], "v double")
    for r in df.select("v", _cents(F.col("v")).alias("a"), F.round(F.col("v") * 100).cast("bigint").alias("b")).collect():
        assert r.a == r.b, r


def test_the_code_of_rejected_documents_only_is_read(spark, tmp_path):
    t = dt.datetime(1999, 12, 31, 7)
    _tables(spark, str(tmp_path), [(5, 5, 6, 2, 3.0, 1.0, 0.1, 0.02, "N", "F", t)],
            [(k, 10, "F", 9.99, t, "x") for k in (1, 5, 7, 35, 36, 5, -7)] + [(None, 10, "F", 9.99, t, "x")])
    out = q_job_fundamental_rejects(spark, str(tmp_path))
    plan = _plan(out)
    assert "get_json_object" in plan.splitlines()[0] and plan.count("get_json_object") == 1
    assert sorted(map(tuple, out.collect())) == [("-7", "no General"), ("35", "cut"), ("5", "cut"), ("5", "cut"), ("7", "no General")]


def test_index_members_carry_only_what_the_job_reads(spark):
    doc = '{"General":{"Code":"I","Name":"Index","CurrencyCode":"USD","CountryISO":"U"},"Components":{"0":{"Code":"A","Name":"a","Exchange":"X","Sector":{"s":[1]}},"1":{}}}'
    docs = spark.createDataFrame([(doc,), (doc.replace('"I"', '"J"'),), (doc[:-1],)], "doc_text string")
    members, rejects = job_index_member(docs, spark.createDataFrame([("I",)], "code string"))
    assert "Sector" not in _plan(members)
    assert sorted(map(tuple, members.collect()), key=str) == [("A", "a", "X", "U", "USD", "I", "Index"), (None, None, None, "U", "USD", "I", "Index")]
    assert [r.doc_text for r in rejects.collect()] == [doc[:-1]]
