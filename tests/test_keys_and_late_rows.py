"""NULL and duplicate keys, mappings with several values, late files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.operators import lookup as L
from bourse.operators import quality as Q
from bourse.operators import search as SE
from bourse.plans import jobs as J
from bourse.session import scratch_path
from bourse.sinks import merge as M
from bourse.sinks import writers as WR
from bourse.streaming import streams as ST


def test_null_keys_that_repeat_are_violations(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4), ("b", 5)], "k string, v int")
    valid, bad = Q.check_unique(df, ["k"])
    assert [r.v for r in valid.collect()] == [3] and sorted(r.v for r in bad.collect()) == [1, 2, 4, 5]
    assert {r.v: r.is_unique for r in Q.unique_flag(df, "k").collect()} == {1: False, 2: False, 3: True, 4: False, 5: False}


def test_duplicate_source_keys_do_not_multiply_rows(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep"), (None, "null")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "a"), (3, "z"), (3, "y"), (None, "n1"), (None, "n2")], "k int, v string")
    up = sorted(((r.k, r.v) for r in M.upsert_columns(target, source, ["k"], ["v"]).collect()), key=str)
    assert up == sorted([(1, "a"), (2, "keep"), (3, "y"), (None, "null"), (None, "n1"), (None, "n2")], key=str)
    assert sorted(((r.k, r.v) for r in M.bulk_update_by_key(target, source, "k", ["v"]).collect()), key=str) == sorted([(1, "a"), (2, "keep"), (None, "null")], key=str)
    t = dt.datetime(2020, 1, 1)
    current = spark.createDataFrame([(1, "x", True, t, None, t, t)], "k int, v string, is_active boolean, active_from timestamp_ntz, "
                                    "active_until timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz")
    out = M.snapshot_refresh(current, spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string"), ["k"], dt.datetime(2021, 1, 1), ["v"]).collect()
    assert [(r.k, r.v) for r in out] == [(1, "a")]


def test_mapping_with_several_values_fans_out(spark):
    df = spark.createDataFrame([("a",), ("c",)], "code string")
    m = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x")], "source_value string, mapping_value string")
    assert sorted(r.code for r in L.lookup_join(df, m, "code").collect()) == ["c", "x", "y"]


def test_negated_words_alone_need_the_universe(spark):
    idx = SE.fts_index(spark.createDataFrame([(1, "red"), (2, "blue")], "id long, text string"), "id", ["text"])
    with pytest.raises(ValueError):
        SE.fts_match(idx, "-red")


def test_index_members_come_from_the_list_and_rejects_are_returned(spark):
    doc = '{"General":{"Code":"%s","Type":"%s","Name":"n"},"Components":{"0":{"Code":"m"}}}'
    docs = spark.createDataFrame([(doc % ("I1", "INDEX"),), (doc % ("I2", "ETF"),), ("{bad",)], "doc_text string")
    members, rejects = J.job_index_member(docs, spark.createDataFrame([("I1",)], "code string"))
    assert [(r.index_code, r.security_code) for r in members.collect()] == [("I1", "m")] and rejects.count() == 1


def test_late_file_in_a_later_trigger_keeps_its_row(spark):
    schema = T.StructType([T.StructField(n, t) for n, t in [("Date", T.DateType()), ("Code", T.StringType()), ("exchange", T.StringType()), ("Open", T.DoubleType()), ("High", T.DoubleType()),
                                                          ("Low", T.DoubleType()), ("Close", T.DoubleType()), ("Adjusted_close", T.DoubleType()), ("Volume", T.DoubleType())]])
    src, target, ckpt = (scratch_path(spark, n) for n in ("late-src", "late-table", "late-ckpt"))

    def put(day, code, close):
        spark.createDataFrame([(dt.date.fromisoformat(day), code, "X", 1.0, 1.0, 1.0, close, 1.0, 1.0)], schema).coalesce(1).write.mode("append").option("header", True).csv(src)

    from bourse.operators.projections import normalize_quote_update
    empty = normalize_quote_update(spark.createDataFrame([], schema))
    empty.write.parquet(target)
    put("2001-06-01", "a", 1.0)
    put("2001-06-02", "a", 2.0)
    ST.stream_quote_increment(spark, src, schema, target, ckpt, max_files_per_trigger=1)
    put("1999-06-02", "old", 3.0)
    put("2001-06-01", "a", 9.0)
    ST.stream_quote_increment(spark, src, schema, target, ckpt, max_files_per_trigger=1)
    got = sorted((str(r.date), r.security_code, r.close) for r in spark.read.parquet(target).collect())
    assert got == [("1999-06-02", "old", 3.0), ("2001-06-01", "a", 1.0), ("2001-06-02", "a", 2.0)]


def test_partitioned_write_splits_a_hot_value(spark):
    df = spark.range(300_000).select((F.col("id") % 10 < 8).cast("string").alias("p"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = scratch_path(spark, "hot-value")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        WR.write_partitioned(df, path, ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(path.removeprefix("file:").replace("//", "/") + "/p=true") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(path).count() == 300_000
