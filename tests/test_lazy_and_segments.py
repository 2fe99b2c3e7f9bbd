"""Segments of equal counts, checks inside the action, stored key registry,
CSV layouts, bounded child arrays."""

import random

import pytest
from pyspark.sql import functions as F

from bourse.operators import lookup as L
from bourse.operators import quality as Q
from bourse.operators import timeseries as TS
from bourse.operators.key_registry import KeyRegistry, slot
from bourse.sinks import writers as WR
from bourse.sources import readers as R


class Jobs:
    """How many jobs start inside the block."""

    def __init__(self, spark):
        self.sc = spark.sparkContext

    def __enter__(self):
        self.sc.setJobGroup("counted", "counted")
        return self

    def __exit__(self, *_):
        self.n = len(self.sc.statusTracker().getJobIdsForGroup("counted"))
        self.sc.setJobGroup("other", "other")


# ---- segments

def plain_fill(rows, strict):
    out, last = {}, {}
    for k, d, v, i in sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r)):
        if not strict and v is not None:
            last[k] = v
        out[i] = last.get(k)
        if strict and v is not None:
            last[k] = v
    return out


def test_segments_of_a_hot_key_and_day(spark):
    """Two thirds of the rows in one key, half of them on one day; ties, NULL
    keys, NULL days and runs of NULLs over several segments."""
    rng = random.Random(6)
    rows = []
    for i in range(3000):
        k = rng.choice(["hot", "hot", "hot", "b", "c", None])
        d = rng.choice(["2020-01-01"] * 5 + [f"2020-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", None])
        rows.append((k, d, rng.choice([None] * 30 + [float(i)]), i))
    df = spark.createDataFrame(rows, "k string, d string, v double, i int").withColumn("d", F.col("d").cast("date"))
    got = {r.i: r.w for r in TS.forward_fill(df, ["k"], "d", "v", "w").collect()}
    assert got == plain_fill(rows, False)
    led = TS.lead_ignore_nulls(df, "v", ["k"], "d", "earlier")
    assert led.columns == ["k", "d", "v", "i", "earlier"] and {r.i: r.earlier for r in led.collect()} == plain_fill(rows, True)
    assert TS.forward_fill(df.limit(0), ["k"], "d", "v").count() == 0


def test_segments_hold_about_as_many_rows(spark, monkeypatch):
    seen = []
    real = spark.read.__class__.parquet

    def parquet(self, *paths, **kw):
        out = real(self, *paths, **kw)
        if "/segments-" in str(paths[0]):
            seen.append(out)
        return out

    monkeypatch.setattr(spark.read.__class__, "parquet", parquet)
    df = spark.range(8000).select(F.lit("one").alias("k"), F.lit("2020-01-01").cast("date").alias("d"), F.when(F.col("id") % 9 == 0, F.col("id")).alias("v"), F.col("id").alias("i"))
    TS.forward_fill(df, ["k"], "d", "v")
    sizes = [r["count"] for r in seen[0].groupBy("_seg").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2 * 8000 / len(sizes) + 200


# ---- checks

def test_checks_run_inside_the_action(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (None, "b")], "id long, v string")
    with Jobs(spark) as jobs:
        valid, seen = Q.observe_checks(df, "c", not_null=["id", "v"], unique=["v"])
        late = Q.require_not_null(df, ["id", "v"])
        twice = Q.require_unique(df, ["v"])
        sizes = Q.require_result_size(df.select(F.lit(1).alias("batch_id")), df.limit(2).select(F.lit(1).alias("batch_id")))
    assert jobs.n == 0
    assert valid.count() == 0 and seen.get == {"rows": 4, "nulls_id": 1, "nulls_v": 1, "repeated": 2}
    for frame, said in ((late, "NULL in"), (twice, "repeated key"), (sizes, "batch_id 1: 2 answers to 4 requests")):
        with pytest.raises(Exception, match=said):
            frame.collect()
    assert Q.require_unique(Q.require_not_null(df.where("id < 3"), ["id"]), ["id"]).count() == 2
    fine = df.select(F.lit(1).alias("batch_id"))
    assert Q.require_result_size(fine, fine).collect()[0].ok


# ---- registry

def test_registry_numbers_without_jobs(spark, tmp_path):
    registry = KeyRegistry(spark, str(tmp_path / "r"), buckets=4)
    first = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "code string")
    out, new = registry.assign(first, "code", "key")
    assert registry.high() == 0 and out.count() == 3
    assert registry.commit(new) == 2 and registry.high() == 2
    more = spark.createDataFrame([(c,) for c in ["a", "c", "d", None, "e"]], "code string")
    with Jobs(spark) as jobs:
        out, new = registry.assign(more, "code", "key", optional=True)
    assert jobs.n == 0
    got = {r.code: r.key for r in out.collect()}
    known = {r.uid: r.surrogate_key for r in registry.keys().collect()}
    assert got["a"] == known["a"] and got[None] is None and sorted(got[k] for k in "cde") == [3, 4, 5]
    order = [r.uid for r in new.orderBy("surrogate_key").collect()]
    assert order == [r.uid for r in new.orderBy(slot(F.col("uid")), "uid").collect()]
    # the same uids get the same keys until they are committed, and none twice after
    assert {r.code: r.key for r in registry.assign(more, "code", "key", optional=True)[0].collect()} == got
    assert registry.commit(new) == 3 and registry.commit(registry.assign(more, "code")[1]) == 0 and registry.high() == 5
    assert KeyRegistry(spark, str(tmp_path / "none")).keys().count() == 0


# ---- CSV layouts

def test_many_files_of_two_layouts_are_two_scans(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"f{k}.csv").write_text("a,b\n" + "".join(f"{k},{i}\n" for i in range(3)) if k % 2 else "b,c,a\n" + f"x{k},y,z\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "bom.csv").write_bytes("﻿a,b\r\n1,2\r\n".encode())
    paths = [str(p) for p in tmp_path.glob("*.csv")]
    layouts = R.csv_layouts(spark, paths)
    assert {h: len(f) for h, f in layouts.items()} == {"a,b": 21, "b,c,a": 20}
    out = R.read_csv_inferred(spark, paths, required=["d"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and set(out.columns) == {"a", "b", "c", "d"}
    assert out.where("c is null").count() == 61 and R.read_csv_inferred(spark, [str(tmp_path / "empty.csv")], ["q"]).columns == ["q"]


# ---- child arrays

def test_children_of_a_hot_parent_are_many_bounded_rows(spark):
    child = spark.range(2500).select(F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2300, "b").alias("k"), (F.col("id") % 50).alias("o"), F.col("id").alias("v"))
    chunks = L.child_chunks(child, ["k"], ["o", "v"], "o", "rows", size=100)
    got = {(r.k, r.chunk): (r.n, r.rows) for r in chunks.collect()}
    assert {k: n for k, (n, _) in got.items()} == {("hot", i): 100 for i in range(20)} | {("b", i): 100 for i in range(3)} | {(None, i): 100 for i in range(2)}
    import json
    rows = [x for r in L.chunks_of(chunks, {"k": "hot"}).collect() for x in json.loads(r.rows)]
    assert [(x["o"], x["v"]) for x in rows] == sorted((i % 50, i) for i in range(2000))


def test_written_layouts_read_back(spark, tmp_path):
    a = str(tmp_path / "a")
    WR.write_format(spark.createDataFrame([("1", "x")], "a string, b string"), a, "csv")
    assert R.read_csv_inferred(spark, [a]).collect()[0].asDict() == {"a": "1", "b": "x"}


def test_dense_rows_are_not_shuffled(spark):
    """A key's days are made after its quotes were dealt out, for hot keys, keys without quotes in the window and NULL keys."""
    import datetime as dt
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(days=n)
    rows = [("a", "X", day(2), 1.0), ("a", "X", day(2), 2.0), ("a", "X", day(5), None), ("a", "X", day(-3), 9.0), ("a", "X", day(40), 9.0),
            ("b", "X", day(0), 3.0), ("b", "X", day(9), 4.0), ("c", "X", day(-1), 5.0), ("c", "X", day(-1), 5.0), ("d", "X", None, 6.0),
            (None, "X", day(3), 7.0), (None, "X", day(3), 8.0), ("e", None, day(3), 7.0)]
    q = spark.createDataFrame(rows, "security_code string, exchange_code string, date date, adjusted_close double")
    dense = TS.calendar_densify(q, day(0), day(10))
    keys = ["security_code", "exchange_code"]
    days = spark.createDataFrame([(day(n),) for n in range(10)], "date date")
    want = q.select(*keys).distinct().crossJoin(days).join(q, [*keys, "date"], "left").select(*dense.columns)
    assert dense.columns == [*keys, "date", "adjusted_close"]
    assert sorted(map(repr, dense.collect())) == sorted(map(repr, want.collect()))
    assert TS.calendar_densify(q, day(3), day(3)).count() == 0
    summed = dense.groupBy(*keys, F.year("date")).agg(F.count("*"))
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1, plan


def test_periods_are_counted_side_by_side(spark):
    """One row per key is aggregated, not one per key and period; empty periods have no row."""
    import datetime as dt
    from bourse.operators import setops as S
    day = lambda n: dt.date(2001, 1, 1) + dt.timedelta(days=n)
    rows = [("a", "X", day(1)), ("a", "X", day(8)), ("a", "X", day(11)), ("b", "X", day(1)), ("c", None, day(9)), ("d", "X", None)]
    q = spark.createDataFrame(rows, "security_code string, exchange_code string, date date")
    out = S.union_all_periods(q, [("ALL", day(0)), ("LAST", day(5))], day(10))
    assert out.columns == ["security_code", "exchange_code", "period", "n_quotes"]
    assert {tuple(r) for r in out.collect()} == {("a", "X", "ALL", 2), ("a", "X", "LAST", 1), ("b", "X", "ALL", 1), ("c", None, "ALL", 1), ("c", None, "LAST", 1)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("HashAggregate"), plan
