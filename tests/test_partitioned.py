"""Changes of partitioned tables: what is rewritten, what is kept, replayed epochs."""

import glob
import os

import pytest
from pyspark.sql import types as T

from bourse.sinks import merge as M
from bourse.sinks import partitioned as P
from bourse.sinks import writers as WR
from bourse.streaming import streams as ST

COLS = "id long, v string, p string, y int"


def files(path):
    return {f[len(path) + 1:] for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def rows(spark, path):
    return sorted(map(tuple, spark.read.schema(COLS).parquet(path).select("id", "v", "p", "y").collect()), key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    WR.write_partitioned(spark.createDataFrame([(1, "a", "01", 1), (2, "b", "01", 2), (3, "c", "02", 1), (4, "d", None, 1), (None, "n", "02", 1)], COLS), path, ["p", "y"])
    return path


def upsert(t, s):
    return M.upsert_columns(t, s, ["id"], set_from_source=[c for c in ("v", "p", "y") if c in s.columns])


def test_one_key_changes_one_folder(spark, table):
    before = files(table)
    done = P.change_partitions(table, spark.createDataFrame([(2, "B")], "id long, v string"), ["id"], upsert, ["p", "y"])
    assert done == [("01", "2")]
    assert (2, "B", "01", 2) in rows(spark, table) and len(rows(spark, table)) == 5
    kept = {f for f in before if not f.startswith("p=01/y=2/")}
    assert kept <= files(table) and before - kept and not (before - kept) & files(table)


def test_a_row_moves_and_its_folder_goes(spark, table):
    source = spark.createDataFrame([(3, "C", "03", 7), (9, "new", "01", 1)], COLS)
    P.change_partitions(table, source, ["id"], upsert, ["p", "y"])
    assert rows(spark, table) == [(None, "n", "02", 1), (1, "a", "01", 1), (2, "b", "01", 2), (3, "C", "03", 7), (4, "d", None, 1), (9, "new", "01", 1)]
    P.change_partitions(table, spark.createDataFrame([(2, "b", "01", 1)], COLS), ["id"], upsert, ["p", "y"])
    assert not os.path.exists(f"{table}/p=01/y=2") and (2, "b", "01", 1) in rows(spark, table)


def test_rows_that_land_in_an_unnamed_folder_lose_nothing(spark, table):
    """New keys without partition values go to the default folder, whose rows stay."""
    P.change_partitions(table, spark.createDataFrame([(8, "x")], "id long, v string"), ["id"], lambda t, s: M.upsert_columns(t, s, ["id"], ["v"]), ["p", "y"])
    assert (8, "x", None, None) in rows(spark, table) and (4, "d", None, 1) in rows(spark, table) and len(rows(spark, table)) == 6
    P.change_partitions(table, spark.createDataFrame([(7, "z")], "id long, v string"), ["id"], lambda t, s: M.upsert_columns(t, s, ["id"], ["v"]), ["p", "y"])
    assert {(7, "z", None, None), (8, "x", None, None)} <= set(rows(spark, table))


def test_nothing_touched_nothing_written(spark, table):
    before = files(table)
    assert P.change_partitions(table, spark.createDataFrame([], COLS), ["id"], upsert) == []
    assert P.change_partitions(table, spark.createDataFrame([(77, "q")], "id long, v string"), ["id"], lambda t, s: M.bulk_update_by_key(t, s, "id", ["v"])) == []
    assert files(table) == before
    with pytest.raises(ValueError):
        WR.append_table(spark.createDataFrame([(1, "a", "x", 1)], COLS), table + "-flat")
        P.change_partitions(table + "-flat", spark.createDataFrame([], COLS), ["id"], upsert)


def test_scan_is_pruned_by_literal_filters(spark, table, capsys):
    t = spark.read.schema(COLS).parquet(table)
    P.in_partitions(t, ["p", "y"], [("01", 2), (None, 1)]).explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    values = [("01", i) for i in range(P.MAX_TUPLES + 1)]
    assert {r.id for r in P.in_partitions(t, ["p", "y"], values).collect()} == {1, 2}
    assert P.partition_columns(spark, table) == ["p", "y"] and P.partition_columns(spark, table + "-none") == []


def test_append_new_keeps_files_and_layout(spark, table):
    before = files(table)
    source = spark.createDataFrame([(1, "dup", "01", 1), (5, "e", "01", 1), (5, "f", "01", 1), (6, "g", "04", 3)], COLS)
    for _ in range(2):
        P.append_new(table, source, ["id", "p", "y"])
    assert before < files(table) and [r for r in rows(spark, table) if r[0] in (1, 5, 6)] == [(1, "a", "01", 1), (5, "e", "01", 1), (6, "g", "04", 3)]


def test_replayed_epochs_insert_nothing(spark, table):
    batch = spark.createDataFrame([(5, "e", "01", 1), (None, "m", "01", 1), (1, "again", "01", 1)], COLS)
    assert P.append_epoch(table, batch, 0, "q", ["id"], ["p", "y"]) == 2
    assert P.append_epoch(table, batch, 0, "q", ["id"], ["p", "y"]) == -1
    # an attempt that wrote its rows and died before it said so
    log = P.EpochLog(spark, table, "q")
    log.begin(1)
    WR.append_table(spark.createDataFrame([(None, "k", "02", 1)], COLS), table, ["p", "y"])
    later = spark.createDataFrame([(None, "k", "02", 1), (None, "l", "02", 1), (6, "g", "09", 9)], COLS)
    assert P.append_epoch(table, later, 1, "q", ["id"], ["p", "y"]) == 2
    got = rows(spark, table)
    assert len(got) == 10 and sum(r[1] == "k" for r in got) == 1 and (6, "g", "09", 9) in got


def test_stream_appends_in_the_targets_folders(spark, tmp_path):
    schema = T.StructType([T.StructField(c, t) for c, t in [("Date", T.DateType()), ("Code", T.StringType()), ("exchange", T.StringType()), *[(c, T.DoubleType()) for c in
                           ("Open", "High", "Low", "Close", "Adjusted_close", "Volume")]]])
    src, target, ckpt = (str(tmp_path / n) for n in ("src", "target", "ckpt"))
    cols = "security_code string, date date, open double, high double, low double, close double, adjusted_close double, volume long, exchange_code string, year int"
    old = spark.sql("SELECT 'A' security_code, date'2020-01-02' date, 1d open, 1d high, 1d low, 1d close, 1d adjusted_close, 5L volume, 'X' exchange_code, 2020 year")
    WR.write_partitioned(old, target, ["exchange_code", "year"])
    new = [("2020-01-02", "A", "X", 9.0), ("2021-05-05", "B", "Y", 2.0)]
    spark.createDataFrame([(d, c, x, p, p, p, p, p, 7.0) for d, c, x, p in new], "Date string, Code string, exchange string, Open double, High double, Low double, Close double, Adjusted_close double, Volume double") \
        .write.option("header", True).csv(src)
    for _ in range(2):
        ST.stream_quote_increment(spark, src, schema, target, ckpt)
    got = {(r.security_code, str(r.date), r.exchange_code, r.year, r.close) for r in spark.read.schema(cols).parquet(target).collect()}
    assert got == {("A", "2020-01-02", "X", 2020, 1.0), ("B", "2021-05-05", "Y", 2021, 2.0)}
    assert any(f.startswith("exchange_code=Y/year=2021/") for f in files(target)) and not any("=" not in f for f in files(target))
    # a lost checkpoint replays the epoch
    ST.stream_quote_increment(spark, src, schema, target, ckpt + "2")
    assert spark.read.parquet(target).count() == 2
