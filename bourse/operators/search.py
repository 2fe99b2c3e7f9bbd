"""Text search: token index, web-search style matching, rank, trigram
similarity and the combined search view (SURVEY 2.11).

Scale notes:
* ``fts_index`` is one ``posexplode`` per row: an inverted index (token, id,
  pos) that is written once and filtered by token afterwards.
* A search touches only index rows whose token is in the query (a short
  list, pushed as an ``IN`` filter); phrases are matched with equi joins on
  (id, pos + k); no row is compared with every other row.
* Trigram similarity against ONE query string is a per-row expression over
  the row's own gram set (JVM higher-order functions, no shuffle).
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import let
from ..functions.predicates import filter_set_predicate
from .filters import paginate

# Word characters of the 'simple' text configuration and the
# default similarity threshold of the search API.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
DEFAULT_SIMILARITY_THRESHOLD = 0.05

_PY_SPLIT = re.compile(r"[^\w]+|_+", re.UNICODE)


def tokens_col(text: Column) -> Column:
    """Lower-cased word tokens of a text (empty pieces removed)."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda x: x != F.lit(""))


def fts_index(df: DataFrame, id_col: str, text_cols: Sequence[str]) -> DataFrame:
    """Inverted index rows (id, token, pos) with 1-based word positions and
    the row's token count ``n_tokens`` (for ranking)."""
    from .partitioning import spread
    text = F.concat_ws(" ", *[F.col(c) for c in text_cols])
    t = spread(df).select(F.col(id_col).alias("id"), tokens_col(text).alias("_t"))
    return t.select("id", F.posexplode("_t").alias("_p", "token"), F.size("_t").alias("n_tokens")) \
        .select("id", "token", (F.col("_p") + 1).cast("bigint").alias("pos"),
                F.col("n_tokens").cast("bigint").alias("n_tokens"))


# ------------------------------------------------------------ query parsing
# The search string is a short user input: it is parsed on the driver into a
# boolean structure; only the resulting predicate runs on the executors.

@dataclass
class Term:
    words: list[str]
    negated: bool = False


@dataclass
class WebQuery:
    groups: list[list[Term]] = field(default_factory=list)  # OR of AND-groups

    def positive_words(self) -> list[str]:
        return sorted({w for g in self.groups for t in g if not t.negated for w in t.words})

    def all_words(self) -> list[str]:
        return sorted({w for g in self.groups for t in g for w in t.words})

    def terms(self) -> list[Term]:
        out: list[Term] = []
        for g in self.groups:
            for t in g:
                if all(t.words != o.words for o in out):
                    out.append(t)
        return out


def _py_tokens(s: str) -> list[str]:
    return [w for w in _PY_SPLIT.split(s.lower()) if w]


def parse_websearch(q: str) -> WebQuery:
    """Web-search syntax: words are AND-ed, ``or`` separates alternatives,
    ``-word`` negates, ``"quoted words"`` form a phrase (adjacent words)."""
    items = re.findall(r'(-?)"([^"]*)"|(\S+)', q or "")
    groups: list[list[Term]] = [[]]
    for neg, phrase, word in items:
        if word and word.lower() == "or":
            if groups[-1]:
                groups.append([])
            continue
        negated = bool(neg)
        text = phrase
        if word:
            negated = word.startswith("-") and len(word) > 1
            text = word[1:] if negated else word
        ws = _py_tokens(text)
        if ws:
            groups[-1].append(Term(ws, negated))
    return WebQuery([g for g in groups if g])


def _term_at(term: Term) -> Column:
    """True on the index row where ``term`` starts: the word itself, or for a
    phrase the first word followed by the next ones at consecutive positions
    (``lead`` over the query-word rows of the same id, ordered by position;
    every phrase word is a query word, so it is among those rows)."""
    w = W.partitionBy("id").orderBy("pos")
    cond = F.col("token") == F.lit(term.words[0])
    for k, word in enumerate(term.words[1:], start=1):
        cond = cond & (F.lead("token", k).over(w) == F.lit(word)) & (F.lead("pos", k).over(w) == F.col("pos") + k)
    return cond


def fts_match(index: DataFrame, query: str | WebQuery, universe: DataFrame | None = None) -> DataFrame:
    """Ids whose text satisfies the web-search query; with ``rank`` (number
    of positive query-word occurrences per token of the row, a documented
    approximation of cover density).

    One filter of the index to the query words, one window per id over those
    rows (phrases), one aggregation per id: no join per term."""
    wq = parse_websearch(query) if isinstance(query, str) else query
    terms = wq.terms()
    if not terms:
        return index.sparkSession.createDataFrame([], "id bigint, rank double")
    hits = index.where(F.col("token").isin(wq.all_words()))
    flagged = hits.select("id", "token", "n_tokens", *[_term_at(t).alias(f"_t{i}") for i, t in enumerate(terms)])
    pos_words = wq.positive_words()
    have = flagged.groupBy("id").agg(
        *[F.max(F.col(f"_t{i}").cast("int")).alias(f"_t{i}") for i in range(len(terms))],
        (F.count_if(F.col("token").isin(pos_words)) / F.max("n_tokens")).alias("rank"))
    needs_universe = any(all(t.negated for t in g) for g in wq.groups)
    if needs_universe:
        if universe is None:
            raise ValueError("a query group of negated words only needs the universe of ids")
        have = universe.select("id").distinct().join(have, "id", "left")

    def present(t: Term) -> Column:
        i = next(j for j, o in enumerate(terms) if o.words == t.words)
        return F.coalesce(F.col(f"_t{i}"), F.lit(0)) == 1

    groups = [reduce(lambda a, b: a & b, [(~present(t) if t.negated else present(t)) for t in g]) for g in wq.groups]
    return have.where(reduce(lambda a, b: a | b, groups)).select("id", F.coalesce("rank", F.lit(0.0)).alias("rank"))


def cover_rank(hits: Column, words: int) -> Column:
    """Matched words over the length of the shortest extent that holds one
    occurrence of each of them; 0 without any.

    ``hits``: the occurrences ``(pos, word)`` of ``words`` numbered words in
    order of position. One pass with each word's last position: the shortest
    extent that ends at an occurrence starts at the least of these."""
    matched = F.size(F.array_distinct(F.transform(hits, lambda h: h["word"])))
    none = F.lit(2**31 - 1)

    def step(state: Column, hit: Column) -> Column:
        last = F.transform(state["last"], lambda x, i: F.when(i == hit["word"], hit["pos"]).otherwise(x))
        seen = F.filter(last, lambda x: x > 0)
        cover = F.when(F.size(seen) == matched, hit["pos"] - F.array_min(seen) + 1).otherwise(none)
        return F.struct(last.alias("last"), F.least(state["best"], cover).alias("best"))

    start = F.struct(F.array_repeat(F.lit(0), words).alias("last"), none.alias("best"))
    return F.when(matched > 0, matched / F.aggregate(hits, start, step, lambda s: s["best"])).otherwise(F.lit(0.0))


def _word_number(token: Column, words: Sequence[str]) -> Column:
    return (F.array_position(F.array(*[F.lit(w) for w in words]), token) - 1).cast("int")


def fts_rank(index: DataFrame, query: str | WebQuery, universe: DataFrame | None = None) -> DataFrame:
    """Ids that satisfy the query with their cover rank over the query's
    positive words. The occurrences of these words in one text are gathered."""
    wq = parse_websearch(query) if isinstance(query, str) else query
    found, words = fts_match(index, wq, universe).select("id"), wq.positive_words()
    if not words:
        return found.select("id", F.lit(0.0).alias("rank"))
    hits = index.where(F.col("token").isin(words)).select("id", F.struct(F.col("pos").cast("int").alias("pos"), _word_number(F.col("token"), words).alias("word")).alias("_h"))
    ranks = hits.groupBy("id").agg(F.array_sort(F.collect_list("_h")).alias("_h")).select("id", cover_rank(F.col("_h"), len(words)).alias("rank"))
    return found.join(ranks, "id", "left").select("id", F.coalesce("rank", F.lit(0.0)).alias("rank"))


def cover_row(text: Column, query: str | WebQuery) -> Column:
    """Cover rank of one text, NULL where it does not satisfy the query."""
    wq = parse_websearch(query) if isinstance(query, str) else query
    words = wq.positive_words()
    if not words:
        return match_row(text, wq)
    numbered = F.transform(tokens_col(text), lambda t, i: F.struct((i + 1).alias("pos"), _word_number(t, words).alias("word")))
    return F.when(match_row(text, wq).isNotNull(), cover_rank(F.filter(numbered, lambda h: h["word"] >= 0), len(words)))


def match_row(text: Column, query: str | WebQuery) -> Column:
    """Rank of one text (as ``fts_match``), NULL where it does not satisfy the
    query; no index, no shuffle. Words and phrases are looked up in the
    text's tokens joined by single spaces."""
    wq = parse_websearch(query) if isinstance(query, str) else query
    if not wq.groups:
        return F.lit(None).cast("double")
    tokens = tokens_col(text)
    joined = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))

    def present(t: Term) -> Column:
        has = joined.contains(" " + " ".join(t.words) + " ")
        return ~has if t.negated else has

    groups = [reduce(lambda a, b: a & b, [present(t) for t in g]) for g in wq.groups]
    words = wq.positive_words()
    hits = F.size(F.filter(tokens, lambda x: x.isin(words))) if words else F.lit(0)
    rank = F.when(F.size(tokens) > 0, hits / F.size(tokens)).otherwise(F.lit(0.0))
    return F.when(reduce(lambda a, b: a | b, groups), rank)


def once(*values: Column, names: Sequence[str]) -> Column:
    """Columns computed once per row: filters on them are not merged into
    their expressions, as they would be below a plain projection."""
    return F.inline(F.array(F.struct(*[v.alias(n) for v, n in zip(values, names)]))).alias(*names)


# ------------------------------------------------------------------ trigrams

# A 3-gram of a padded word "  w " never has a space in both its 2nd and 3rd
# position; every substring of the padded text that spans two words does.
_GRAM_PATTERN = r"(?=(..[^ ]|.[^ ] ))"


def trigrams_col(text: Column) -> Column:
    """Distinct trigram set: each lower-cased word padded with two spaces in
    front and one behind, all 3-character substrings.

    Built without nested lambdas: the words are joined into one padded text
    ("  w1   w2 ... wn ") and all overlapping 3-grams are read in one regex
    pass; the pattern skips the substrings that straddle two words."""
    words = F.array_distinct(tokens_col(text))
    # each value is used once, as nothing here is computed once for two uses;
    # without words there are three spaces, which hold no gram
    padded = F.concat(F.lit("  "), F.array_join(words, "   "), F.lit(" "))
    grams = F.regexp_extract_all(padded, F.lit(_GRAM_PATTERN), F.lit(1))
    return F.coalesce(F.array_distinct(grams), F.array().cast("array<string>"))


def query_trigrams(q: str) -> list[str]:
    out = []
    for w in _py_tokens(q):
        p = f"  {w} "
        for i in range(len(p) - 2):
            g = p[i:i + 3]
            if g not in out:
                out.append(g)
    return out


def similarity_col(text: Column, query: str) -> Column:
    """Shared / union of trigram sets (0 when both are empty)."""
    q = query_trigrams(query)
    qa = F.array(*[F.lit(g) for g in q]) if q else F.array().cast("array<string>")

    def similarity(c: Column) -> Column:
        union = c["size"] + F.lit(len(q)) - c["shared"]          # both sets are distinct
        return F.when(union > 0, c["shared"] / union).otherwise(F.lit(0.0))

    counts = let(trigrams_col(text), lambda g: F.struct(F.size(g).alias("size"), F.size(F.array_intersect(g, qa)).alias("shared")))
    return let(counts, similarity)


def trigram_similarity(df: DataFrame, id_col: str, text_col: str, query: str,
                       threshold: float = DEFAULT_SIMILARITY_THRESHOLD) -> DataFrame:
    from .partitioning import spread
    s = spread(df).select(F.col(id_col).alias("id"), once(similarity_col(F.col(text_col), query), names=("similarity",)))
    return s.where(F.col("similarity") >= F.lit(threshold))


# ------------------------------------------------------------------ search

def fts_search(df: DataFrame, id_col: str, text_cols: Sequence[str], query: str,
               filters: Mapping[str, object] | None = None, fset: Mapping[str, tuple[str, str]] | None = None,
               threshold: float = DEFAULT_SIMILARITY_THRESHOLD, page: int | None = 1,
               page_size: int | None = 25, rank_ascending: bool = False,
               index: DataFrame | None = None, by_cover: bool = True) -> DataFrame:
    """Filtered rows that match the query or reach the similarity threshold
    (by an inverted ``index`` where one is given), ordered by rank (the cover
    rank, or with ``by_cover=False`` query-word occurrences per token) then similarity (both descending; the
    reference sorts rank ascending, ``rank_ascending=True`` reproduces it),
    then paged."""
    fset = fset or {}
    pred = filter_set_predicate(filters, fset)
    text = F.concat_ws(" ", *[F.col(c) for c in text_cols])
    base = df.where(pred)
    if index is None:
        # one scan: every row is matched against the query by itself
        out = base.select("*", once((cover_row if by_cover else match_row)(text, query), similarity_col(text, query), names=("rank", "similarity")))
        out = out.where(F.col("rank").isNotNull() | (F.col("similarity") >= F.lit(threshold)))
        out = out.withColumn("rank", F.coalesce("rank", F.lit(0.0)))
    else:
        m = (fts_rank if by_cover else fts_match)(index, query, universe=df.select(F.col(id_col).alias("id"))).select(F.col("id").alias("_id"), "rank")
        out = base.select("*", once(similarity_col(text, query), names=("similarity",)))
        out = out.join(m, out[id_col] == m["_id"], "left")
        out = out.where(F.col("_id").isNotNull() | (F.col("similarity") >= F.lit(threshold))).drop("_id")
        out = out.withColumn("rank", F.coalesce("rank", F.lit(0.0)))
    order = [("rank", "ASC" if rank_ascending else "DESC"), ("similarity", "DESC")]
    return paginate(out, page, page_size, order=order, unique_key=[id_col])
