"""Cover rank against all extents; stored indexes after changes, what their queries read."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from bourse.operators import search as SE
from bourse.operators import stored_index as SI


def brute_rank(text, words):
    toks = SE._py_tokens(text)
    hits = [(i, t) for i, t in enumerate(toks) if t in words]
    matched = {t for _, t in hits}
    covers = [b[0] - a[0] + 1 for a, b in itertools.combinations_with_replacement(hits, 2) if {t for i, t in hits if a[0] <= i <= b[0]} == matched]
    return len(matched) / min(covers) if matched else 0.0


def test_cover_rank_is_the_shortest_extent(spark):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(0, 40))) for i in range(150)} | {900: "", 901: "a", 902: "b x x a x b a", 903: "a b c"}
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    idx = SE.fts_index(df, "id", ["text"])
    got = {r.id: r.rank for r in SE.fts_rank(idx, "a or b or c").collect()}
    want = {i: brute_rank(t, {"a", "b", "c"}) for i, t in texts.items() if {"a", "b", "c"} & set(t.split())}
    assert got == pytest.approx(want) and got[903] == 1.0 and got[902] == 1.0
    row = {r.id: r.rank for r in df.select("id", SE.cover_row(F.col("text"), "a or b or c").alias("rank")).collect()}
    assert {i: r for i, r in row.items() if r is not None} == pytest.approx(want)
    # only negated words: matched texts have no rank
    assert {r.id: r.rank for r in SE.fts_rank(idx, "-a", df.select("id")).collect()} == {i: 0.0 for i, t in texts.items() if "a" not in t.split()}


def test_index_after_changes_is_a_rebuilt_one(spark, tmp_path):
    docs = {i: f"common w{i % 5} x{i}" for i in range(40)}
    df = lambda d: spark.createDataFrame([(k, v) for k, v in d.items()], "id long, text string")
    index = SI.TextIndex(spark, str(tmp_path / "i"), buckets=8)
    assert index.match("common").count() == 0 and index.rows().count() == 0
    index.put(df(docs), "id", ["text"])
    index.delete(df({3: "", 4: "", 999: ""}).select("id"))
    new = {4: "again common", 5: "changed words", 50: "", 51: None}
    index.put(df(new), "id", ["text"])
    want = {k: v for k, v in docs.items() if k != 3} | new
    key = lambda r: (r[0], r[2])

    def same():
        rebuilt = SE.fts_index(df(want), "id", ["text"])
        assert sorted(map(tuple, index.tokens().collect()), key=key) == sorted(map(tuple, rebuilt.collect()), key=key)
        assert {r.id for r in index.rows().collect()} == set(want)
        assert {r.id for r in index.match("common -w1").collect()} == {i for i, t in want.items() if "common" in (t or "").split() and "w1" not in t.split()}
        assert {r.id for r in index.match("-common").collect()} == {i for i, t in want.items() if "common" not in (t or "").split()}

    same()
    index.compact()
    same()
    assert index.segments() == [3] and SI.TextIndex(spark, str(tmp_path / "i")).buckets == 8
    # a job that dies before its manifest is published changes nothing
    index._write(9, *SI.word_postings(df({77: "common"}), "id", ["text"]), None)
    same()


def test_a_query_reads_the_folders_of_its_words(spark, tmp_path, capsys):
    index = SI.TextIndex(spark, str(tmp_path / "i"), buckets=16)
    index.put(spark.createDataFrame([(i, f"t{i} common") for i in range(50)], "id long, text string"), "id", ["text"])
    index.match("t7").explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0] and "In(term" in plan or "EqualTo(term" in plan
    files = index.postings(["t7"]).select(F.input_file_name()).distinct().count()
    assert files == 1 and [r.id for r in index.match("t7").collect()] == [7]


@pytest.mark.parametrize("threshold", [0.05, 0.3, 1.0])
def test_gram_index_gives_the_row_wise_rows(spark, tmp_path, threshold):
    rng = random.Random(1)
    words = ["blue", "bolts", "bolt", "blues", "red", "table", "bleu", "été"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))) for i in range(300)] + [(900, None), (901, "blue bolts"), (902, "BOLTS, blue"), (903, "x " * 200)]
    df = spark.createDataFrame(texts, "id long, text string")
    index = SI.GramIndex(spark, str(tmp_path / "g"), buckets=16)
    index.put(df, "id", "text")
    want = {r.id: r.similarity for r in SE.trigram_similarity(df, "id", "text", "blue bolts", threshold).collect()}
    assert {r.id: r.similarity for r in index.similar("blue bolts", threshold).collect()} == pytest.approx(want)
    q = SE.query_trigrams("blue bolts")
    if threshold >= 0.3:
        # rows too small or too large to reach the threshold are not read
        assert index.postings(q, 3, 40).select("id").distinct().count() <= index.postings(q).select("id").distinct().count()
        assert 903 not in {r.id for r in index.postings(q, 3, 40).collect()}
    with pytest.raises(ValueError):
        index.similar("x", 0)


def test_words_are_grouped_where_texts_are_split(spark):
    """Texts are dealt out by id; their words are not shuffled once more."""
    docs = spark.createDataFrame([(1, "one two one"), (2, ""), (3, None), (4, "two")], "doc_id long, text string")
    postings, rows = SI.word_postings(docs, "doc_id", ["text"])
    got = {(r["id"], r["term"], tuple(r["positions"]), r["size"]) for r in postings.collect()}
    assert got == {(1, "one", (1, 3), 3), (1, "two", (2,), 3), (4, "two", (1,), 1)}
    assert sorted((r["id"], r["size"]) for r in rows.collect()) == [(1, 3), (2, 0), (3, 0), (4, 1)]
    plan = SI.word_postings(docs, "doc_id", ["text"])[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
