"""Matching, searching and as-of lookups on small frames against plain
versions, and checks of their plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from bourse.operators import fundamentals as FU
from bourse.operators import lookup as L
from bourse.operators import search as SE
from bourse.operators import timeseries as TS
from bourse.plans import jobs as J
from bourse.plans.docs import v_doc
from bourse.sinks import merge as M

D = dt.date
SEC = "isin string, ticker string, name string"
REF = "isin_source string, ticker_source string, figi string"


def test_fallback_match_fans_out_and_keeps_nulls(spark):
    df = spark.createDataFrame([("I1", "T1", "a"), ("I2", "T2", "b"), (None, "T3", "c"), (None, None, "d"), ("I9", "T9", "e")], SEC)
    ref = spark.createDataFrame([("I1", None, "F1"), ("I1", None, "F2"), (None, "T1", "F3"), (None, "T2", "F4"),
                                 (None, "T3", "F5"), (None, None, "F6")], REF)
    out = L.fallback_match(df, ref, "isin", "ticker", "isin_source", "ticker_source", ["figi"])
    assert {(r.name, r.figi, r.matched_by) for r in out.collect()} == {
        ("a", "F1", "isin"), ("a", "F2", "isin"), ("b", "F4", "ticker"), ("c", "F5", "ticker"), ("d", None, None), ("e", None, None)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join Left", plan)) == 2 and "Anti" not in plan

    matched, missing = L.dual_key_matches(df, ref, "isin", "ticker", "isin_source", "ticker_source", ["figi"])
    assert sorted((r.name, r.figi) for r in matched.collect()) == [("a", "F1"), ("a", "F2"), ("a", "F3"), ("b", "F4"), ("c", "F5")]
    assert sorted(r.name for r in missing.collect()) == ["d", "e"]


def test_figi_second_attempt_by_ticker(spark):
    sec = spark.createDataFrame([("I1", "T1", "known"), ("I2", "T2", "by isin"), ("I3", "T3", "by ticker"), ("I4", "T4", "nowhere"),
                                 (None, "T5", "no isin")], SEC)
    cols = "figi string, share_class_figi string, ticker_figi string, exchange_code_figi string, name_figi string"
    figi = spark.createDataFrame([("I1", None, "F1", "S", "T", "X", "n")], f"isin_source string, ticker_source string, {cols}")
    one = [("F", "S", "T", "X", "n")]
    answers = spark.createDataFrame([("ID_ISIN", "I2", one), ("ID_ISIN", "I3", []), ("TICKER", "T3", one), ("TICKER", "T5", one),
                                     ("TICKER", "T2", one * 2)], f"idType string, idValue string, data array<struct<{cols.replace(' string', ':string')}>>")
    matched, missing, found, requests = J.job_figi_match(sec, figi, answers)
    assert sorted(r.name for r in matched.collect()) == ["by isin", "by ticker", "known", "no isin"]
    assert [r.name for r in missing.collect()] == ["nowhere"]
    assert sorted(r.ticker_source for r in found.collect()) == ["T2", "T3", "T5"]
    assert sorted(r.idValue for r in requests.collect()) == ["I2", "I3", "I4", "T5"]


@pytest.mark.parametrize("query", ["red", "red blue", '"red blue"', "red or green", "-red", "red -blue", '-"red blue"', "green -red or blue", "none"])
def test_row_match_is_index_match(spark, query):
    texts = ["red blue", "blue red", "red and blue", "Red, BLUE! red", "green", "", None, "redblue", "blue green red blue"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    by_index = SE.fts_match(SE.fts_index(df, "id", ["t"]), query, universe=df)
    by_row = df.select("id", SE.match_row(F.concat_ws(" ", "t"), query).alias("rank")).where("rank is not null")
    got = lambda d: {r.id: round(r["rank"], 9) for r in d.collect()}
    assert got(by_row) == got(by_index)


def test_asof_join_nulls_ties_and_hot_key(spark):
    left = spark.createDataFrame([(i, "A", "X", D(2024, 1, 1) + dt.timedelta(days=i % 40)) for i in range(400)]
                                 + [(1000, None, "X", D(2024, 1, 5)), (1001, "A", "X", None), (1002, "B", "X", D(2024, 1, 5))],
                                 "n long, security_code string, exchange_code string, ref date")
    quotes = [("A", "X", D(2024, 1, 3), 1.0), ("A", "X", D(2024, 1, 3), 2.0), ("A", "X", D(2024, 1, 20), None), ("A", "X", D(2024, 2, 1), 4.0),
              (None, "X", D(2024, 1, 1), 9.0)]
    right = spark.createDataFrame(quotes, "security_code string, exchange_code string, date date, adjusted_close double")
    out = {r.n: r for r in TS.asof_join_backward(left, right, ["security_code", "exchange_code"], "ref", "date", ["adjusted_close"]).collect()}
    assert len(out) == 403
    for r in out.values():
        prior = [(q[2], q[3]) for q in quotes if r.ref and q[0] == r.security_code and q[0] and q[2] <= r.ref]
        day = max((p[0] for p in prior), default=None)
        best = max((p[1] for p in prior if p[0] == day and p[1] is not None), default=None)
        assert (r.date_matched, r.adjusted_close) == (day, best)


def test_lead_ignore_nulls_crosses_segments(spark):
    q = spark.createDataFrame([("A", D(2023, 1, 31), 1.0), ("A", D(2023, 2, 1), None), ("A", D(2023, 6, 1), 3.0), ("A", D(2024, 1, 1), 4.0)],
                              "k string, d date, v double")
    out = TS.lead_ignore_nulls(q, "v", ["k"], "d", "earlier").orderBy("d").collect()
    assert [r.earlier for r in out] == [None, 1.0, 1.0, 3.0]


def test_rows_to_insert_prunes_and_dedupes(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, p string, v double")
    s = spark.createDataFrame([(1, "a", 9.0), (3, "a", 5.0), (3, "a", 4.0), (4, "c", 6.0)], "k long, p string, v double")
    got = sorted(tuple(r) for r in M.rows_to_insert(t, s, ["k"], ["p"]).collect())
    assert got == [(3, "a", 4.0), (4, "c", 6.0)]


def test_documents_are_parsed_once(spark):
    plan = FU.fund_all(v_doc(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan()
    generators = [str(g) for g in plan.toString().splitlines() if "Generate explode(array(from_json" in g]
    others = [g for g in plan.toString().splitlines() if re.search(r"from_json\(.*doc_text", g) and "Generate explode" not in g]
    assert len(generators) == 1 and not others
