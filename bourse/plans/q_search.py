"""Registered queries for SURVEY 2.11 (text search) over part names (short
texts) and documents (whole long texts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as SE
from ..operators import stored_index as SI
from ..session import scratch_path
from .fixtures import table, v_security, with_views
from .q_relational import SECURITY_FILTERS
from .registry import register

_SPLIT = r"'[^\p{L}\p{N}]+'"


def _toks_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), {_SPLIT}), lambda x: x <> '')"


def _grams_sql(toks: str) -> str:
    return (f"list_distinct(flatten(list_transform({toks}, lambda w: list_transform("
            f"range(1, length('  ' || w || ' ') - 1), lambda i: substr('  ' || w || ' ', i, 3)))))")


def _qgrams_sql(q: str) -> str:
    return "[" + ", ".join("'" + g.replace("'", "''") + "'" for g in SE.query_trigrams(q)) + "]"


def _sim_sql(grams: str, q: str) -> str:
    qg = _qgrams_sql(q)
    return (f"CASE WHEN len(list_distinct(list_concat({grams}, {qg}))) > 0 THEN "
            f"len(list_distinct(list_intersect({grams}, {qg}))) / len(list_distinct(list_concat({grams}, {qg}))) "
            f"ELSE 0.0 END")


_PART_TEXT = "concat_ws(' ', p_name, p_brand)"
_PART_T = f"SELECT p_partkey AS id, {_toks_sql(_PART_TEXT)} AS toks FROM part"
_DOC_T = f"SELECT doc_id AS id, {_toks_sql('text')} AS toks FROM documents"


def _tokens_sql(t: str) -> str:
    return with_views("""
SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos, len(toks) AS n_tokens FROM t""",
                      extra={"t": t})


@register("fts_tokens", _tokens_sql(_PART_T))
def q_fts_tokens(spark, sf_dir):
    return SE.fts_index(table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_brand"])


@register("fts_tokens_documents", _tokens_sql(_DOC_T))
def q_fts_tokens_documents(spark, sf_dir):
    return SE.fts_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])


def _match_sql(t: str, where: str, positive: list[str]) -> str:
    pos = ", ".join(f"'{w}'" for w in positive)
    return with_views(f"""
SELECT id, len(list_filter(toks, lambda x: x IN ({pos}))) / len(toks) AS rank
FROM (SELECT id, toks, ' ' || array_to_string(toks, ' ') || ' ' AS s FROM t) WHERE {where}""", extra={"t": t})


_PART_Q = 'red or "blue bolt" -brand#3 or cold -rod'


@register("fts_match", _match_sql(
    _PART_T, "(s LIKE '% red %') OR (s LIKE '% blue bolt %' AND NOT s LIKE '% brand 3 %') "
             "OR (s LIKE '% cold %' AND NOT s LIKE '% rod %')", ["red", "blue", "bolt", "cold"]))
def q_fts_match(spark, sf_dir):
    idx = SE.fts_index(table(spark, sf_dir, "part"), "p_partkey", ["p_name", "p_brand"])
    return SE.fts_match(idx, _PART_Q)


_DOC_Q = '"of the" der -que or "la de" und'


@register("fts_match_documents", _match_sql(
    _DOC_T, "(s LIKE '% of the %' AND s LIKE '% der %' AND NOT s LIKE '% que %') "
            "OR (s LIKE '% la de %' AND s LIKE '% und %')", ["of", "the", "der", "la", "de", "und"]))
def q_fts_match_documents(spark, sf_dir):
    idx = SE.fts_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return SE.fts_match(idx, _DOC_Q)


def _cover_sql(t: str, where: str, positive: list[str]) -> str:
    """Rank by the shortest extent, sought from its start: of every matched
    word the first occurrence at or after a hit."""
    words = ", ".join(f"'{w}'" for w in positive)
    nexts = ", ".join(f"min(CASE WHEN token = '{w}' THEN pos END) OVER following" for w in positive)
    return with_views(f"""
SELECT id, coalesce(rank, 0.0) AS rank FROM (SELECT id, ' ' || array_to_string(toks, ' ') || ' ' AS s FROM t) LEFT JOIN (
  SELECT id, max(n) / min(list_max(ends) - pos + 1)::DOUBLE AS rank FROM (
    SELECT id, pos, list_filter([{nexts}], lambda x: x IS NOT NULL) AS ends FROM hits
    WINDOW following AS (PARTITION BY id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
  JOIN (SELECT id, count(DISTINCT token) AS n FROM hits GROUP BY id) USING (id) WHERE len(ends) = n GROUP BY id) USING (id)
WHERE {where}""", extra={"t": t, "hits": f"SELECT * FROM (SELECT id, unnest(toks) AS token, generate_subscripts(toks, 1) AS pos FROM t) WHERE token IN ({words})"})


_RANK_WHERE, _RANK_WORDS = "s LIKE '% the %' AND s LIKE '% of %' AND s LIKE '% and %'", ["the", "of", "and"]


@register("fts_rank", _cover_sql(_DOC_T, _RANK_WHERE, _RANK_WORDS))
def q_fts_rank(spark, sf_dir):
    """Matched words over the length of the shortest extent that holds them."""
    idx = SE.fts_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return SE.fts_rank(idx, "the of and")


@register("fts_rank_occurrences", _match_sql(_DOC_T, _RANK_WHERE, _RANK_WORDS))
def q_fts_rank_occurrences(spark, sf_dir):
    """Matched query-word occurrences per token."""
    idx = SE.fts_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return SE.fts_match(idx, "the of and").orderBy(F.col("rank").desc(), "id")


_OR_WHERE = "(s LIKE '% the %' AND s LIKE '% of %') OR (s LIKE '% la %' AND NOT s LIKE '% que %') OR s LIKE '% und der %'"


@register("fts_rank_alternatives", _cover_sql(_DOC_T, _OR_WHERE, ["the", "of", "la", "und", "der"]))
def q_fts_rank_alternatives(spark, sf_dir):
    """Every text is ranked by the words that it holds."""
    idx = SE.fts_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return SE.fts_rank(idx, 'the of or la -que or "und der"')


# ---- stored indexes

def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@register("fts_index_stored", _cover_sql(_DOC_T, _OR_WHERE, ["the", "of", "la", "und", "der"]))
def q_fts_index_stored(spark, sf_dir):
    """Written once; the query reads the folders of its words."""
    index = SI.TextIndex(spark, scratch_path(spark, "text-index"))
    index.put(_documents(spark, sf_dir), "doc_id", ["text"])
    return index.rank('the of or la -que or "und der"')


@register("fts_index_update", _tokens_sql("""SELECT doc_id AS id, TOKS AS toks FROM
  (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Revised ' || text || ' revised text' ELSE text END AS text FROM documents WHERE doc_id % 5 <> 1)"""
                                          .replace("TOKS", _toks_sql("text"))))
def q_fts_index_update(spark, sf_dir):
    """An index after additions, replacements, deletions and a compaction is
    the index of the rows that are left."""
    docs = _documents(spark, sf_dir)
    index = SI.TextIndex(spark, scratch_path(spark, "text-index"))
    index.put(docs.where(F.col("doc_id") % 2 == 0), "doc_id", ["text"])
    index.put(docs.where(F.col("doc_id") % 2 == 1), "doc_id", ["text"])
    index.delete(docs.where((F.col("doc_id") % 5 == 1) & (F.col("doc_id") % 3 == 0)).select("doc_id"))
    index.put(docs.where((F.col("doc_id") % 7 == 0) & (F.col("doc_id") % 5 != 1)).withColumn("text", F.concat(F.lit("Revised "), F.col("text"), F.lit(" revised text"))), "doc_id", ["text"])
    index.compact()
    index.delete(docs.where((F.col("doc_id") % 5 == 1) & (F.col("doc_id") % 3 != 0)).select("doc_id"))
    return index.tokens()


_TRI_Q = "blue bolts"


@register("trigram_similarity", with_views(f"""
SELECT id, sim AS similarity FROM (SELECT id, {_sim_sql(_grams_sql('toks'), _TRI_Q)} AS sim FROM t)
WHERE sim >= 0.05""", extra={"t": f"SELECT p_partkey AS id, {_toks_sql('p_name')} AS toks FROM part"}))
def q_trigram_similarity(spark, sf_dir):
    return SE.trigram_similarity(table(spark, sf_dir, "part"), "p_partkey", "p_name", _TRI_Q)


_TRI_DOC_Q = "Enpaeux leaux le ouè"


@register("trigram_similarity_documents", with_views(f"""
SELECT id, sim AS similarity FROM (SELECT id, {_sim_sql(_grams_sql('toks'), _TRI_DOC_Q)} AS sim FROM t)
WHERE sim >= 0.01""", extra={"t": _DOC_T}))
def q_trigram_similarity_documents(spark, sf_dir):
    return SE.trigram_similarity(table(spark, sf_dir, "documents"), "doc_id", "text", _TRI_DOC_Q, threshold=0.01)


def _gram_index(spark, sf_dir, name, id_col, text_col):
    index = SI.GramIndex(spark, scratch_path(spark, "gram-index"))
    index.put(table(spark, sf_dir, name), id_col, text_col)
    return index


def _similar_sql(t: str, query: str, threshold: float) -> str:
    return with_views(f"SELECT id, sim AS similarity FROM (SELECT id, {_sim_sql(_grams_sql('toks'), query)} AS sim FROM t) WHERE sim >= {threshold}", extra={"t": t})


_NAME_T = f"SELECT p_partkey AS id, {_toks_sql('p_name')} AS toks FROM part"


@register("trigram_index", _similar_sql(_NAME_T, _TRI_Q, 0.05))
def q_trigram_index(spark, sf_dir):
    """The rows of the row-wise form, from the postings of the query's grams."""
    return _gram_index(spark, sf_dir, "part", "p_partkey", "p_name").similar(_TRI_Q)


@register("trigram_index_close", _similar_sql(_NAME_T, _TRI_Q, 0.3))
def q_trigram_index_close(spark, sf_dir):
    return _gram_index(spark, sf_dir, "part", "p_partkey", "p_name").similar(_TRI_Q, 0.3)


@register("trigram_index_documents", _similar_sql(_DOC_T, _TRI_DOC_Q, 0.01))
def q_trigram_index_documents(spark, sf_dir):
    return _gram_index(spark, sf_dir, "documents", "doc_id", "text").similar(_TRI_DOC_Q, 0.01)


_SEARCH_Q = "ring -small"
_SEC_COLS = "code, name, type, exchange_code, isin, currency, id, size"


@register("fts_search", with_views(f"""
SELECT {_SEC_COLS}, rank, similarity FROM (
  SELECT s.*, f.rank, f.similarity FROM v_security s JOIN (
    SELECT id, CASE WHEN m THEN len(list_filter(toks, lambda x: x IN ('ring'))) / len(toks) ELSE 0.0 END AS rank,
           sim AS similarity
    FROM (SELECT t.id, t.toks, (s LIKE '% ring %' AND NOT s LIKE '% small %') AS m, sim, p
          FROM (SELECT id, toks, ' ' || array_to_string(toks, ' ') || ' ' AS s,
                       {_sim_sql(_grams_sql('toks'), _SEARCH_Q)} AS sim FROM t) t
          JOIN (SELECT id, type IN ('SMALL', 'LARGE', 'PROMO') AS p FROM v_security) USING (id))
    WHERE (p AND m) OR sim >= 0.05) f ON s.id = f.id
  WHERE s.type IN ('SMALL', 'LARGE', 'PROMO'))
ORDER BY rank DESC, similarity DESC, id LIMIT 25 OFFSET 0""", "v_security",
                                   extra={"t": f"SELECT p_partkey AS id, {_toks_sql('p_name')} AS toks FROM part"}))
def q_fts_search(spark, sf_dir):
    s = v_security(spark, sf_dir)
    return SE.fts_search(s, "id", ["name"], _SEARCH_Q, {"type": ["SMALL", "LARGE", "PROMO"]}, SECURITY_FILTERS,
                         page=1, page_size=25, by_cover=False)


_COVER_Q = "blue or ring -small"


@register("fts_search_cover", with_views(f"""
SELECT {_SEC_COLS}, CASE WHEN m THEN f.rank ELSE 0.0 END AS rank, similarity FROM v_security s JOIN (
  SELECT t.id AS fid, t.sim AS similarity, (s LIKE '% blue %' OR (s LIKE '% ring %' AND NOT s LIKE '% small %')) AS m,
         CASE WHEN list_contains(toks, 'blue') AND list_contains(toks, 'ring') THEN
                2.0 / (1 + list_min(flatten(list_transform(at_blue, lambda x: list_transform(at_ring, lambda y: abs(x - y))))))
              ELSE 1.0 END AS rank
  FROM (SELECT id, toks, ' ' || array_to_string(toks, ' ') || ' ' AS s, {_sim_sql(_grams_sql('toks'), _COVER_Q)} AS sim,
               list_filter(range(1, len(toks) + 1), lambda i: toks[i] = 'blue') AS at_blue, list_filter(range(1, len(toks) + 1), lambda i: toks[i] = 'ring') AS at_ring FROM t) t) f ON s.id = f.fid
WHERE s.type IN ('SMALL', 'LARGE', 'PROMO') AND (m OR similarity >= 0.05)
ORDER BY rank DESC, similarity DESC, id LIMIT 25""", "v_security", extra={"t": _NAME_T}))
def q_fts_search_cover(spark, sf_dir):
    """Ranked by the shortest cover."""
    return SE.fts_search(v_security(spark, sf_dir), "id", ["name"], _COVER_Q, {"type": ["SMALL", "LARGE", "PROMO"]}, SECURITY_FILTERS, page=1, page_size=25)
