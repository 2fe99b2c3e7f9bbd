"""The pipeline stage by stage against plain versions, and the registration."""

import math

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bourse.llm import pii, queries, toxicity
from bourse.llm.common import stage, table

from . import brute

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries())
    assert [n for n in queries.QUERIES if n.startswith("op")] == [n for k in range(1, 14) for n in queries.QUERIES if n.startswith(f"op{k}_")]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLE[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, got.select(cols).collect()), key=key) == sorted(want.project(", ".join(cols)).fetchall(), key=key)


def test_url_sql_follows_links_as_the_query_does(spark, tmp_path):
    """Chains of canonical links and refreshes, allow before block."""
    link = '<head><link rel="canonical" href="{}"><title>x</title>'
    refresh = "<meta http-equiv=refresh content='0; url={}'>"
    rows = [(1, "http://a.org/x", link.format("http://b.net/y")), (2, "http://c.com/z", refresh.format("http://A.org/x#f")), (3, "http://d.com/", link.format("/other")),
            (4, "http://d.com/other", None), (5, "http://e.com/1", link.format("//www.example.net/en/2")), (6, "http://e.com/2", link.format("http://e.com/1") + refresh.format("http://b.net/q")),
            (7, None, link.format("http://b.net/y")), (8, "no url", link.format("http://b.net/y")), (9, "http://e.com/2", ""), (None, "http://f.com", '<link rel=stylesheet href="http://b.net/">')]
    # every link, relative targets, whole urls, entities, other schemes, lists of values
    rows += [(20, "http://g.com/dir/page.html?x=1", "<link rel='nofollow canonical' href='next.html'>"), (21, "http://g.com/dir/next.html", refresh.format("http://bad.net/")),
             (22, "http://g.com/dir/page.html?x=2", None), (23, "http://h.com/a/b/c", '<link href="../../up/./x" rel=canonical>'), (24, "http://h.com/up/x", link.format("http://b.net/")),
             (25, "http://i.com/view?id=1", link.format("http://b.net/")), (26, "http://i.com/view?id=2", "x"), (27, "http://j.com/p", '<link rel="canonical" href="?a=1&amp;b=2">'),
             (28, "http://j.com/p?a=1&b=2", refresh.format("http://b.net/")), (29, "http://k.com/x", link.format("mailto:a@b.net") + link.format("#top") + '<link rel="canonical" data-href="http://b.net/">'),
             (30, "http://l.com", '<meta content="5;URL=sub/y" http-equiv="Refresh">' + link.format("other") + link.format("http://www.example.net/en/")), (31, "http://l.com/sub/y", ""), (32, "http://l.com/other", ""),
             (33, "http://m.com/a?u=http://b.net/", link.format("b?u=http://b.net/")), (34, "http://m.com/b?u=http://b.net/", link.format("/..")), (35, "http://m.com/", link.format("//b.net/")), (36, "http://n.com/a/", link.format(".."))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cols = ["page_id", "host", "path", "rule", "verdict", "reason"]
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted(map(tuple, queries.op7_url_filter(spark, str(tmp_path)).select(cols).collect()), key=key)
    assert got == sorted(con.sql(queries.ORACLE["op7_url_filter"]).project(", ".join(cols)).fetchall(), key=key)
    assert {r[0]: r[4:] for r in got if r[0] and r[0] >= 20} == {
        i: ("allow", "alias") if i in (30, 31, 32) else ("block", "alias") if i in (20, 21, 23, 24, 25, 27, 28, 33, 34, 35) else ("allow", "default") for i in range(20, 37)}
    assert {r[0]: r[4:] for r in got if r[0] in (1, 2, 5, 6)} == {1: ("block", "alias"), 2: ("block", "alias"), 5: ("allow", "alias"), 6: ("allow", "alias")}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    model = toxicity.train(docs, table(spark, SF, "labels"))
    scored = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    clean = stage(steps["toxicity"](spark, docs, SF), "t")
    assert {r.doc_id for r in clean.collect()} == {i for i, s in scored.items() if s < toxicity.THRESHOLD}

    one = stage(steps["near_duplicates"](spark, clean, SF), "t")
    seqs = {r.doc_id: brute.shingles(r.text) for r in clean.collect()}
    ids = sorted(seqs)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if len(set(seqs[a]) & set(seqs[b])) >= 0.4 * max(len(seqs[a]), len(seqs[b])) > 0 and brute.alignment(seqs[a], seqs[b]) >= 0.8 - 1e-9]
    assert {r.doc_id for r in one.collect()} == {i for i, c in brute.components(ids, links).items() if i == c}

    masked = stage(steps["pii"](spark, one, SF), "t")
    assert masked.columns == docs.columns
    for r in masked.collect():
        spans = [s for found in brute.base_spans(text[r.doc_id]).values() for s in found]
        assert all(text[r.doc_id][a:b] not in r.text for a, b in spans)
        assert spans or r.text == text[r.doc_id] or "[" in r.text
    assert pii.pii_digest(masked).agg({"n_email": "sum", "n_card": "sum", "n_phone": "sum"}).first()[0] == 0

    mixed = stage(steps["mixing"](spark, masked, SF), "t")
    assert mixed.columns == docs.columns
    size = sum(len(r.text) for r in masked.collect())
    assert abs(sum(len(r.text) for r in mixed.collect()) - size) < 8 * size / math.sqrt(masked.count())

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in steps["bpe"](spark, mixed, SF).collect())
    want = []
    for r in mixed.collect():
        ids = tok.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(r.text)))
    assert got == sorted(want)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0
