"""What a stored index shuffles and keeps on disk (findings of round 4)."""

import pytest
from pyspark.sql import functions as F

from bourse.operators import search as SE
from bourse.operators import stored_index as SI


def _frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id long, text string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def unasked(spark):
    """No side of a join is sent to all tasks unless the code says so."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("sent, file_bytes", [(SI.SENT_IDS, SI.FILE_BYTES), (0, 1), (100, 700)])
def test_changes_shuffle_few_ids_and_no_postings(unasked, tmp_path, monkeypatch, sent, file_bytes):
    spark = unasked
    monkeypatch.setattr(SI, "SENT_IDS", sent)
    monkeypatch.setattr(SI, "FILE_BYTES", file_bytes)
    texts = {i: f"common w{i % 7} x{i} common" for i in range(60)} | {None: "nobody common"}
    index = SI.TextIndex(spark, str(tmp_path / "i"), buckets=8)
    index.put(_frame(spark, {k: v for k, v in texts.items() if k is None or k % 2 == 0}), "id", ["text"])
    index.put(_frame(spark, {k: v for k, v in texts.items() if k is not None and k % 2}), "id", ["text"])
    index.delete(_frame(spark, {3: "", 4: "", 999: ""}).select("id"))
    new = {5: "changed common words", 6: "", 70: None, 71: "more"}
    index.put(_frame(spark, new), "id", ["text"])
    # only ids that an earlier segment holds are superseded ones
    assert sorted((r.segment, r.id) for r in index._read("gone").collect()) == [(2, 3), (2, 4), (3, 5), (3, 6)]
    want = {k: v for k, v in texts.items() if k not in (3, 4)} | new

    def same():
        rebuilt = SE.fts_index(_frame(spark, want), "id", ["text"])
        assert sorted(map(str, index.tokens().collect())) == sorted(map(str, rebuilt.collect()))
        assert sorted(map(str, index.rows().select("id").collect())) == sorted(f"Row(id={k})" for k in want)

    same()
    written = []
    write = SI.StoredIndex._write

    def watched(self, number, postings, *rest):
        written.append((_plan(postings), postings.rdd.getNumPartitions()))
        write(self, number, postings, *rest)

    monkeypatch.setattr(SI.StoredIndex, "_write", watched)
    assert ("SortMergeJoin" in _plan(index.postings())) == (not sent)
    index.compact()
    same()
    plan, tasks = written[0]
    assert ("SortMergeJoin" in plan) == (not sent)
    if sent:
        # folders stay where they are read, in more than one task where they are many bytes
        assert "BroadcastHashJoin" in plan and (tasks > 2) == (file_bytes == 700)
    terms = spark.read.parquet(str(tmp_path / "i" / "postings")).groupBy("term").agg(F.countDistinct("bucket").alias("n"))
    assert terms.where("n > 1").count() == 0 and index.segments() == [4]


def test_postings_are_written_without_a_shuffle_and_leave_whole_folders(spark, tmp_path, monkeypatch):
    plans = []
    folders = SI.StoredIndex._write_folders

    def watched(self, postings, path):
        plans.append(_plan(postings))
        folders(self, postings, path)

    monkeypatch.setattr(SI.StoredIndex, "_write_folders", watched)
    index = SI.TextIndex(spark, str(tmp_path / "i"), buckets=4)
    index.put(_frame(spark, {i: f"common x{i}" for i in range(200)}), "id", ["text"])
    # the texts are dealt by id, postings are not shuffled; what the tasks wrote is gone
    assert [p.count("Exchange") for p in plans] == [1, 0] and not (tmp_path / "i" / "_runs").exists()
    for bucket in (tmp_path / "i" / "postings" / "segment=0").glob("bucket=*"):
        assert len(list(bucket.glob("*.parquet"))) <= 2
    assert index.tokens().count() == 400
    # an index of texts without words has rows
    index.put(_frame(spark, {i: "" for i in range(200)}), "id", ["text"])
    assert index.tokens().count() == 0 and index.rows().count() == 200
    index.compact()
    assert index.tokens().count() == 0 and index.rows().count() == 200


def test_the_rows_of_an_index_are_made_without_a_shuffle(spark):
    docs = spark.range(100).selectExpr("id doc_id", "concat('one two ', id) text").repartition(16)
    rows = SI.word_postings(docs, "doc_id", ["text"])[1]
    assert _plan(rows).count("Exchange") == _plan(docs).count("Exchange") == 1
    assert {r["size"] for r in rows.collect()} == {3} and rows.count() == 100


def test_a_first_segment_supersedes_nothing(spark, tmp_path):
    index = SI.GramIndex(spark, str(tmp_path / "g"), buckets=4)
    index.put(_frame(spark, {1: "blue bolts", 2: "red"}), "id", "text")
    assert index._read("gone") is None and index.rows().count() == 2
    index.delete(_frame(spark, {7: ""}).select("id"))
    index.delete(_frame(spark, {2: ""}).select("id"))
    assert [r.id for r in index.rows().collect()] == [1] and [r.id for r in index.similar("red blue", 0.1).collect()] == [1]
    index.compact()
    assert [r.id for r in index.rows().collect()] == [1] and [r.id for r in index.similar("red blue", 0.1).collect()] == [1]
