"""Hand-made frames for the edge cases of FIXTURES.md section 3, property
checks of the table-maintenance operators, and plan checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bourse.functions import columns as C
from bourse.functions import predicates as P
from bourse.operators import filters as FL
from bourse.operators import keys as K
from bourse.operators import nested as N
from bourse.operators import quality as Q
from bourse.operators import search as SE
from bourse.operators import timeseries as TS
from bourse.sinks import merge as M

D = dt.date


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


# ------------------------------------------------------------ time series

def quotes(spark, data):
    return spark.createDataFrame(data, "security_code string, exchange_code string, date date, adjusted_close double")


def test_performance_asof_zero_divisor_and_missing_reference(spark):
    q = quotes(spark, [("A", "X", D(2023, 12, 29), 0.0), ("A", "X", D(2024, 3, 1), 10.0),
                       ("B", "X", D(2024, 3, 1), 5.0)])
    out = TS.performance_asof(q, D(2024, 3, 1))
    got = {(r.security_code, r.period): r.performance for r in out.collect()}
    assert got[("A", "YEAR_TO_DATE")] is None          # base / 0 -> NULL, not an error
    assert ("B", "YEAR_TO_DATE") not in got            # no reference on or before Jan 1 -> no row
    assert got[("B", "MONTH_TO_DATE")] == 0.0


def test_performance_asof_empty_input(spark):
    assert TS.performance_asof(quotes(spark, []), D(2024, 1, 1)).count() == 0


def test_performance_exact_reference_before_calendar_and_month_ends(spark):
    q = quotes(spark, [("A", "X", D(2024, 2, 29), 2.0), ("A", "X", D(2024, 3, 28), 4.0),
                       ("A", "X", D(2024, 3, 29), None)])
    out = TS.performance_exact(q, D(2024, 3, 31), years=1, days=0)
    got = {r.period: (r.reference_date, r.reference_close, r.base_close) for r in out.collect()}
    assert got["LAST_1_MONTH"] == (D(2024, 2, 29), 2.0, 4.0)      # 31 Mar - 1 month clamps to 29 Feb
    assert got["LAST_2_YEAR"] == (None, None, 4.0)                 # before the calendar start
    assert got["MONTH_TO_DATE"][1] == 2.0                          # forward-filled from 29 Feb


def test_forward_fill_crosses_year_segments(spark):
    q = quotes(spark, [("A", "X", D(2020, 12, 31), 1.0), ("A", "X", D(2021, 1, 5), None),
                       ("A", "X", D(2022, 6, 1), None), ("A", "X", D(2022, 6, 2), 3.0),
                       ("B", "X", D(2021, 1, 1), None)])
    out = TS.forward_fill(q, ["security_code", "exchange_code"], "date", "adjusted_close")
    assert rows(out, "security_code", "date", "adjusted_close") == [
        ("A", D(2020, 12, 31), 1.0), ("A", D(2021, 1, 5), 1.0), ("A", D(2022, 6, 1), 1.0),
        ("A", D(2022, 6, 2), 3.0), ("B", D(2021, 1, 1), None)]


def test_missing_date_ranges_yesterday_today_future(spark):
    q = quotes(spark, [("A", "Y", D(2024, 5, 30), 1.0), ("A", "T", D(2024, 5, 31), 1.0),
                       ("A", "F", D(2024, 6, 9), 1.0), ("A", "G", D(2024, 5, 28), 1.0)])
    out = TS.missing_date_ranges(q, D(2024, 5, 31))
    assert rows(out, "exchange_code", "missing_date") == [("G", D(2024, 5, 29)), ("G", D(2024, 5, 30))]


def test_asof_join_equal_dates_and_before_first(spark):
    left = spark.createDataFrame([(1, "A", "X", D(2024, 1, 1)), (2, "A", "X", D(2024, 1, 5)),
                                  (3, "A", "X", D(2023, 12, 1))],
                                 "id int, security_code string, exchange_code string, ref date")
    right = quotes(spark, [("A", "X", D(2024, 1, 1), 7.0), ("A", "X", D(2024, 1, 3), 8.0)])
    out = TS.asof_join_backward(left, right, ["security_code", "exchange_code"], "ref", "date", ["adjusted_close"])
    assert rows(out, "id", "adjusted_close") == [(1, 7.0), (2, 8.0), (3, None)]


# ------------------------------------------------------------ columns, filters

def test_title_case(spark):
    df = spark.createDataFrame([("O'NEIL A.B. SMITH-JONES",), (None,)], "s string")
    got = [r[0] for r in df.select(C.title_case(F.col("s"))).collect()]
    assert got == ["O'Neil A.B. Smith-Jones", None]
    assert "O'NEIL A.B. SMITH-JONES".title() == got[0]


def test_filter_values_zero_false_empty_list(spark):
    df = spark.createDataFrame([(0, False, "a"), (1, True, "b"), (2, None, None)], "n int, f boolean, s string")
    fs = {"n": ("n", P.EQUAL), "f": ("f", P.EQUAL), "s": ("s", P.INCLUDES), "x": ("s", P.EXCLUDES)}
    assert df.where(P.filter_set_predicate({"n": 0}, fs)).count() == 1
    assert df.where(P.filter_set_predicate({"f": False}, fs)).count() == 1
    assert df.where(P.filter_set_predicate({"s": []}, fs)).count() == 0
    assert df.where(P.filter_set_predicate({"n": None, "unknown": 1}, fs)).count() == 3
    items = [{"column": "n", "operator": "EQUAL", "value": 0}, {"column": "s", "operator": "IS_NOT_NULL"}]
    assert FL.filter_objects(df, items).count() == 1


def test_sentinels(spark):
    df = spark.createDataFrame([("Unknown", "", 1), ("x", None, 2)], "a string, b string, n int")
    assert rows(C.sentinel_to_null(df), "a", "b", "n") == [("x", None, 2), (None, None, 1)]


def test_page_zero_and_ordering(spark):
    df = spark.range(10).withColumn("v", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")))
    p0 = FL.paginate(df, page=0, page_size=3, order=[("v", "ASC")], unique_key=["id"])
    assert [r.id for r in p0.collect()] == [1, 2, 4]          # NULLs sort last on ASC
    p2 = FL.paginate(df, page=2, page_size=3, order=[("v", "ASC")], unique_key=["id"])
    assert [r.id for r in p2.collect()] == [5, 7, 8]


def test_check_cardinality(spark):
    # nothing runs while the plan is built; the action fails
    two, none = FL.check_cardinality(spark.range(2), 0, 1), FL.check_cardinality(spark.range(0), 1, 1)
    with pytest.raises(Exception, match=r"expected 0\.\.1 rows, got 2\+"):
        two.collect()
    with pytest.raises(Exception, match=r"expected 1\.\.1 rows, got 0"):
        none.collect()
    assert FL.check_cardinality(spark.range(1), 1, 1).collect()[0].id == 0 and FL.check_cardinality(spark.range(0)).collect() == []


# ------------------------------------------------------------ search

def test_websearch_parse():
    q = SE.parse_websearch('"blue bolt" or red -"old ring" -x')
    assert [[(t.words, t.negated) for t in g] for g in q.groups] == [
        [(["blue", "bolt"], False)], [(["red"], False), (["old", "ring"], True), (["x"], True)]]


def test_fts_match_quotes_or_negation(spark):
    df = spark.createDataFrame([(1, "blue bolt"), (2, "bolt blue"), (3, "red ring"), (4, "red old ring"),
                                (5, "old red")], "id int, t string")
    idx = SE.fts_index(df, "id", ["t"])
    got = sorted(r.id for r in SE.fts_match(idx, '"blue bolt" or red -"old ring"').collect())
    assert got == [1, 3, 5]
    only_neg = sorted(r.id for r in SE.fts_match(idx, "-red", universe=df.select("id")).collect())
    assert only_neg == [1, 2]


def test_trigram_similarity_matches_definition(spark):
    df = spark.createDataFrame([(1, "word"), (2, "Words!"), (3, "")], "id int, t string")
    got = {r.id: r.similarity for r in SE.trigram_similarity(df, "id", "t", "word", threshold=0.0).collect()}
    a = set(SE.query_trigrams("word"))
    b = set(SE.query_trigrams("words"))
    assert got[1] == 1.0
    assert got[2] == pytest.approx(len(a & b) / len(a | b))
    assert got[3] == 0.0


# ------------------------------------------------------------ nested

def test_malformed_json_and_missing_map(spark):
    df = spark.createDataFrame([("{bad",), ('{"General": {"Code": "A"}}',), ('{"Other": 1}',)], "t string")
    ok, rej = N.parse_documents(df, "t", "General map<string,string>, Components map<string,string>",
                                required="General")
    assert ok.count() == 1 and rej.count() == 2
    m = ok.select(N.map_get(F.col("doc.Components"), "x").alias("v"), N.map_get(F.col("doc.General"), "Code")
                  .alias("c")).collect()[0]
    assert m.v is None and m.c == "A"


def test_struct_to_metrics_null_rows_and_empty_map(spark):
    df = spark.createDataFrame([("A", {"x": "1"}), ("B", {}), ("C", None)], "id string, m map<string,string>")
    out = N.struct_to_metrics(df, "m", "cat", ["x", "y"], ["id"])
    assert rows(out, "id", "metric", "value") == [("A", "x", "1"), ("A", "y", None)]


# ------------------------------------------------------------ keys, quality, merges

def test_surrogate_keys_bijection_and_stable(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "uid string")
    known = spark.createDataFrame([("b", 10)], "uid string, surrogate_key long")
    out, new = K.assign_surrogate_keys(df, known, "uid", "id")
    got = dict(rows(out.dropDuplicates(["uid"]), "uid", "id"))
    assert got == {"a": 11, "b": 10, "c": 12}                  # NULL uid gets no key and is dropped
    out2, new2 = K.assign_surrogate_keys(df, known.unionByName(new), "uid", "id")
    assert dict(rows(out2.dropDuplicates(["uid"]), "uid", "id")) == got and new2.count() == 0
    opt, _ = K.assign_surrogate_keys(df, known, "uid", "id", add_missing=False, optional=True)
    assert opt.count() == 5


def test_global_row_index_dense(spark):
    df = spark.range(0, 1000, 3).withColumn("k", F.col("id") * -1)
    idx = K.global_row_index(df, ["k"], "rn", num_partitions=7)
    got = rows(idx, "k", "rn")
    assert [r[1] for r in got] == list(range(len(got)))


def test_quality_split_is_a_partition(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "id int, s string")
    for fn, cols in ((Q.check_not_null, ["s"]), (Q.check_null, ["s"]), (Q.check_unique, ["id"])):
        valid, viol = fn(df, cols)
        assert valid.count() + viol.count() == df.count()
    _v, viol = Q.check_unique(df, ["id"])
    assert viol.count() == 2


def test_merge_insert_new_idempotent_and_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(1, "z"), (2, "b"), (2, "c")], "k int, v string")
    once = M.merge_insert_new(t, s, ["k"])
    twice = M.merge_insert_new(once, s, ["k"])
    assert rows(once, "k", "v") == rows(twice, "k", "v")
    assert len(rows(once, "k", "v")) == 4                       # duplicate source keys are all inserted
    assert M.merge_insert_new(t, s, ["k"], dedupe_source=True).count() == 3


def test_upsert_null_is_a_value_and_snapshot_keeps_keys(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    s = spark.createDataFrame([(1, None, "q"), (3, "c", "r")], "k int, v string, w string")
    out = M.upsert_columns(t, s, ["k"], set_from_source=["v"])
    assert rows(out, "k", "v", "w") == [(1, None, "x"), (2, "b", "y"), (3, "c", "r")]
    ts = dt.datetime(2020, 1, 1)
    cur = t.select("k", "v", F.lit(True).alias("is_active"), F.lit(ts).cast("timestamp_ntz").alias("active_from"),
                   F.lit(None).cast("timestamp_ntz").alias("active_until"),
                   F.lit(ts).cast("timestamp_ntz").alias("created_at"),
                   F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    snap = M.snapshot_refresh(cur, s.select("k", "v"), ["k"], dt.datetime(2024, 1, 1), ["v"])
    assert rows(snap, "k", "is_active") == [(1, True), (2, False), (3, True)]


# ------------------------------------------------------------ plans

@pytest.mark.parametrize("name", ["performance_asof", "performance_exact", "calendar_densify", "forward_fill",
                                  "asof_join_backward", "fts_search", "trigram_similarity", "dual_key_union_join",
                                  "snapshot_refresh", "fund_balance_sheet"])
def test_no_cartesian_or_row_python(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", ["normalize_quote_history", "snapshot_refresh", "log_filter", "scan_table",
                                  "normalize_logs"])
def test_session_time_zone_does_not_shift_results(spark, name):
    import __spark_entry__ as E
    from tools.oracle_check import compare, duck
    sf = "/root/testdata/sf0.001"
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, sf, name, E.queries()[name], E.oracle_sql()[name], duck(sf))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["status"] == "ok", r
