"""The queries of this package: ``op<N>_<name>`` for each operator and
``pipeline``, with DuckDB SQL where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, chat, embed_dedup, langid, licenses, merkle, mixing, order_minhash, pii, quality, toxicity, url_filter
from .common import table

#: Target shares: the hot source is held to a fifth, the others share the rest.
MIX_WEIGHTS, MIX_ALPHA, MIX_SEED = {"src0": 0.2}, 0.7, 17
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_ALPHA, 1.0, MIX_SEED)
    return mixed.select("row.doc_id", "copy", "copies", "shuffle_key", "row.source", "row.lang", "row.text")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rules_table(spark, URL_RULES))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)], turns.schema)
    return chat.chat_digest(turns.union(more))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return merkle.manifest(docs, observed={"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))})


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return align.align(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"), digest=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pii, op2_mixing, op3_embedding_dedup, op4_bpe, op5_licenses, op6_toxicity, op7_url_filter, op8_order_minhash, op9_quality, op10_chat, op11_merkle, op12_langid, op13_align, pipeline)}

#: Sizes over all documents, shares, rates and the Poisson distribution by its
#: closed form; Spark sums the same terms one by one.
OP2_SQL = f"""
WITH sizes AS (SELECT coalesce(source, '') AS s, sum(coalesce(length(text), 0))::DOUBLE AS chars FROM documents GROUP BY 1),
shares AS (SELECT s, chars, CASE WHEN chars > 0 THEN map_extract(MAP {MIX_WEIGHTS}, s)[1] END AS fixed FROM sizes),
free AS (SELECT *, CASE WHEN chars > 0 AND fixed IS NULL THEN pow(chars, {MIX_ALPHA}) ELSE 0 END AS w FROM shares),
total AS (SELECT sum(chars) AS chars, coalesce(sum(fixed), 0) AS fixed, sum(w) AS w, CASE WHEN sum(w) > 0 THEN 1 - {sum(MIX_WEIGHTS.values())} ELSE 0 END AS rest FROM free),
rates AS (SELECT s, CASE WHEN f.chars > 0 THEN coalesce(f.fixed, CASE WHEN t.w > 0 THEN f.w * t.rest / t.w ELSE 0 END)
                 / CASE WHEN t.fixed + t.rest > 0 THEN t.fixed + t.rest ELSE 1 END * t.chars / f.chars ELSE 1.0 END AS rate FROM free f, total t),
terms AS (SELECT s, k, CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE CASE WHEN k = 0 THEN 1 ELSE 0 END END AS p
          FROM rates, LATERAL (SELECT unnest(range(0, (rate + 12 * sqrt(rate) + 31)::BIGINT)) AS k)),
cdf AS (SELECT s, list(c ORDER BY k) AS cdf FROM (SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM terms) GROUP BY s),
drawn AS (SELECT d.*, coalesce(doc_id::VARCHAR, '') AS id, ('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {2**52}.0::DOUBLE AS u,
                 cdf FROM documents d JOIN cdf ON coalesce(d.source, '') = cdf.s),
counted AS (SELECT *, len(list_filter(cdf, lambda c: c < u))::INTEGER AS copies FROM drawn)
SELECT doc_id, copy, copies, md5('{MIX_SEED}:order:' || id || ':' || copy) AS shuffle_key, source, lang, text
FROM (SELECT *, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted)
"""

#: Rules by the longest fit, then components over all canonical links and
#: refresh redirects by recursion, allow before block. Written from what HTML and
#: RFC 3986 say of tags, attributes and references, on strings where Spark's form
#: works on arrays and structs.
OP7_SQL = r"""
WITH RECURSIVE rules AS (SELECT action, rule, split_part(rule, '/', 1) AS rh, substr(rule, instr(rule, '/')) AS rp FROM (VALUES RULES) v(action, rule)),
tags AS (SELECT url AS f, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*')) AS tag FROM pages WHERE instr(url, '://') > 0),
attributes AS (SELECT f, lower(regexp_extract(tag, '^<([a-zA-Z]+)', 1)) AS name, lower(ATTR(rel)) AS rel, lower(trim(ATTR(http-equiv))) AS equiv, ATTR(href) AS href, ATTR(content) AS content FROM tags),
named AS (SELECT f, CASE WHEN name = 'link' AND list_contains(regexp_split_to_array(rel, '\s+'), 'canonical') THEN href
                         WHEN name = 'meta' AND equiv = 'refresh' THEN regexp_extract(content, '(?i)\burl\s*=\s*["'']?([^"''\s]+)', 1) END AS t FROM attributes),
targets AS (SELECT f, split_part(regexp_replace(trim(t), '(?i)&(amp|#38|#x26);', '&', 'g'), '#', 1) AS t, regexp_extract(f, '^[^:/?#]+') AS scheme, regexp_extract(f, '(?s)^.*?://([^/?#]*)', 1) AS authority,
                   regexp_extract(f, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS here FROM named WHERE trim(t) <> ''),
joined AS (SELECT *, CASE WHEN t LIKE '/%' THEN split_part(t, '?', 1) WHEN t LIKE '?%' THEN here ELSE regexp_replace('/' || here, '(?s)^/(/.*/|/)?.*$', '\1') || split_part(t, '?', 1) END AS p,
                  CASE WHEN instr(t, '?') > 0 THEN substr(t, instr(t, '?')) ELSE '' END AS q FROM targets),
whole AS (SELECT f, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN t = '' OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN t LIKE '//%' THEN scheme || ':' || t
    ELSE scheme || '://' || authority || CASE WHEN p = '' THEN '' ELSE list_reduce(string_split(CASE WHEN p LIKE '/%' THEN p ELSE '/' || p END, '/'), lambda a, x: CASE x WHEN '..' THEN regexp_replace(a, '/[^/]*$', '') WHEN '.' THEN a ELSE a || '/' || x END)
         || CASE WHEN regexp_matches(p, '(^|/)\.\.?$') THEN '/' ELSE '' END END || q END AS t FROM joined),
links AS (SELECT f, t FROM whole WHERE instr(t, '://') > 0),
urls AS (SELECT url FROM pages UNION SELECT f FROM links UNION SELECT t FROM links),
parts AS (SELECT url, CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
                 CASE WHEN instr(url, '://') > 0 THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
                 CASE WHEN instr(url, '://') > 0 THEN regexp_extract(url, '(?s)^[^?#]*(\?[^#]*)', 1) ELSE '' END AS query FROM urls),
address AS (SELECT DISTINCT host, path, host || path || query AS node FROM parts),
judged AS (SELECT a.*, r.rule, r.action FROM address a LEFT JOIN
  (SELECT host, path, rule, action FROM (SELECT DISTINCT host, path FROM address) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
   QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule) = 1) r USING (host, path)),
ends AS (SELECT DISTINCT a.host || a.path || a.query AS x, b.host || b.path || b.query AS y FROM links w JOIN parts a ON a.url = w.f JOIN parts b ON b.url = w.t),
edges AS (SELECT x, y FROM ends UNION SELECT y, x FROM ends),
reach(x, y) AS (SELECT x, x FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
says AS (SELECT r.x AS node, bool_or(j.action = 'allow') AS allowed, bool_or(j.action = 'block') AS blocked FROM reach r JOIN judged j ON j.node = r.y WHERE j.action IS NOT NULL GROUP BY 1)
SELECT page_id, j.host, j.path, j.rule, coalesce(j.action, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN j.action IS NOT NULL THEN 'rule' WHEN allowed OR blocked THEN 'alias' ELSE 'default' END AS reason
FROM pages p JOIN parts a ON a.url IS NOT DISTINCT FROM p.url JOIN judged j ON j.node = a.host || a.path || a.query AND j.host = a.host AND j.path = a.path LEFT JOIN says s ON s.node = j.node
""".replace("RULES", ", ".join(f"('{a}', '{r}')" for a, r in URL_RULES))
for _name in ("rel", "http-equiv", "href", "content"):
    _found = rf"""regexp_extract(tag, '(?i)[\s"'']{_name}\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', %d)"""
    OP7_SQL = OP7_SQL.replace(f"ATTR({_name})", "(" + " || ".join(_found % k for k in (1, 2, 3)) + ")")

#: Leaves, the levels of every language's tree and of the tree above by
#: recursion, then each leaf's way up with its siblings. CRC-32 (reflected
#: polynomial 0xEDB88320) from a table of 256 entries.
OP11_SQL = """
WITH RECURSIVE crc(t) AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))),
leaves AS (SELECT doc_id, lang, sha256(HEAD || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || TAIL) AS leaf,
    CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 7 = 0
         THEN sha256(HEAD || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || TAIL) END AS seen FROM documents, crc),
placed AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS row, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM leaves),
inner_nodes(tree, lvl, pos, size, h) AS (SELECT tree, 0, pos, size, leaf FROM placed
    UNION ALL SELECT tree, lvl + 1, pos // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM inner_nodes WHERE size > 1 GROUP BY tree, lvl, pos // 2, size),
subroots AS (SELECT tree, h AS subroot, (SELECT max(tree) + 1 FROM placed) AS trees FROM inner_nodes WHERE size = 1),
upper_nodes(lvl, pos, size, h) AS (SELECT 0, tree, trees, subroot FROM subroots
    UNION ALL SELECT lvl + 1, pos // 2, (size + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_nodes WHERE size > 1 GROUP BY lvl, pos // 2, size),
inner_way(row, tree, lvl, pos, f, proof, size) AS (SELECT row, tree, 0, pos, coalesce(seen, leaf), '', size FROM placed
    UNION ALL SELECT row, w.tree, w.lvl + 1, w.pos // 2, sha256(CASE WHEN n.h IS NULL THEN f WHEN w.pos % 2 = 1 THEN n.h || f ELSE f || n.h END), proof || coalesce(n.h, ''), (w.size + 1) // 2
    FROM inner_way w LEFT JOIN inner_nodes n ON n.tree = w.tree AND n.lvl = w.lvl AND n.pos = xor(w.pos, 1) WHERE w.size > 1),
upper_way(row, lvl, pos, f, proof, size) AS (SELECT row, 0, tree, f, proof, (SELECT max(trees) FROM subroots) FROM inner_way WHERE size = 1
    UNION ALL SELECT row, w.lvl + 1, w.pos // 2, sha256(CASE WHEN n.h IS NULL THEN f WHEN w.pos % 2 = 1 THEN n.h || f ELSE f || n.h END), proof || coalesce(n.h, ''), (w.size + 1) // 2
    FROM upper_way w LEFT JOIN upper_nodes n ON n.lvl = w.lvl AND n.pos = xor(w.pos, 1) WHERE w.size > 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM placed JOIN subroots USING (tree) JOIN upper_way w ON w.row = placed.row AND w.size = 1, (SELECT h AS root FROM upper_nodes WHERE size = 1)
""".replace("HEAD", " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang"))).replace("TAIL", "coalesce(strlen(text) || ':' || text, '-')")

ORACLE: dict[str, str] = {"op2_mixing": OP2_SQL, "op7_url_filter": OP7_SQL, "op11_merkle": OP11_SQL}
