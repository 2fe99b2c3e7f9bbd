"""URL filters with redirect equivalence.

A rule is a host and a path, such as ``example.com/de/``: it fits its host
and all subdomains where the url's path starts with the rule's, and the
longest rule wins. Urls that redirect to one another or name one another as
canonical are one component (distributed connected components over those
edges); an url without a rule of its own takes the decision of its component:
allowed if any member is allowed by a rule, else blocked if any member is
blocked, else the default.

Native DataFrame operations only. Rules are a table: every distinct host and
path is exploded to the suffixes of its host and joined with them,
so a block list may hold millions of rules. Each distinct address is judged
once; rows get the verdict by a join on the address, which Spark can split
where one address holds many rows.

Edges come from every ``<link rel="canonical">`` and ``<meta
http-equiv="refresh">`` of a page and an optional table of redirects. Targets
are resolved against the page's address (``//host/path``, ``/path``, ``next``,
``../up``, ``?query``; ``&amp;`` is ``&``); other schemes than with ``://`` are
not followed. A node of the graph is a whole url, its query included, without
scheme and fragment, so that one of several urls of a path may be an alias; rules
fit host and path.

Results for odd rows: a null url or one without ``://`` has an empty host and
path, no rule and the default verdict; null html has no edges; repeated rows
are judged alike; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stage
from .components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*+)", 1))
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    found = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*+([^?#]*+)", 1))
    return F.coalesce(found, F.lit(""))


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``(action, rule)`` pairs as a table ``rule rule_host rule_path action``."""
    df = spark.createDataFrame(rules, "action string, rule string")
    return df.select("rule", F.substring_index("rule", "/", 1).alias("rule_host"),
                     F.expr("substring(rule, instr(rule, '/'))").alias("rule_path"), "action")


def judge_by_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host path rule action`` for distinct addresses: the longest rule that
    fits, ties to the rule that sorts first; rule and action null without one."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fits = (addresses.select("host", "path", F.explode(suffixes).alias("rule_host"))
            .join(rules, "rule_host").where(F.expr("startswith(path, rule_path)")))
    best = fits.groupBy("host", "path").agg(F.min(F.struct((-F.length("rule")).alias("n"), "rule", "action")).alias("best"))
    return addresses.join(best, ["host", "path"], "left").select("host", "path", "best.rule", "best.action")


def query_of(url: Column) -> Column:
    """From the first ``?`` up to ``#`` or the end."""
    found = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^[^?#]*+(\?[^#]*+)", 1))
    return F.coalesce(found, F.lit(""))


_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute; empty without one."""
    pattern = rf"""(?i)[\s"']{name}""" + _VALUE
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def html_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``from_url to_url`` for all canonical links and refresh redirects."""
    html = F.col(html_col)
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\b[^>]*"), F.lit(0))
    got = pages.where(F.lower(html).rlike("canonical|refresh")).select(F.col(url_col).alias("from_url"), F.explode(tags).alias("tag"))
    canonical = F.col("tag").rlike("(?i)^<link") & _attribute(F.col("tag"), "rel").rlike(r"(?i)(?:^|\s)canonical(?:\s|$)")
    refresh = F.col("tag").rlike("(?i)^<meta") & (F.lower(F.trim(_attribute(F.col("tag"), "http-equiv"))) == "refresh")
    later = F.regexp_extract(_attribute(F.col("tag"), "content"), r"""(?i)\burl\s*=\s*["']?([^"'\s]+)""", 1)
    target = F.trim(F.when(canonical, _attribute(F.col("tag"), "href")).when(refresh, later).otherwise(F.lit("")))
    got = got.select("from_url", F.regexp_replace(target, "(?i)&(?:amp|#38|#x26);", "&").alias("to_url"))
    return got.where(F.col("to_url") != "")


def _without_dots(path: Column) -> Column:
    """A path from ``/`` on without ``.`` and ``..`` segments."""
    parts = F.split(path, "/")
    last = F.get(parts, F.size(parts) - 1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, x: F.when(x == ".", a).when(
        x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(1)))).otherwise(F.array_append(a, x)))
    return F.array_join(F.when(last.isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept), "/")


def _absolute(source: Column, target: Column) -> Column:
    """The url that a page's target names; null where it is not followed."""
    target = F.regexp_replace(target, "(?s)#.*$", "")
    scheme = F.regexp_extract(source, r"^[^:/?#]+", 0)
    at = F.substring_index(target, "?", 1)
    query = F.regexp_extract(target, r"(?s)(\?.*)$", 1)
    folder = F.regexp_replace(path_of(source), "(?s)[^/]*$", "")
    path = F.when(at == "", path_of(source)).when(at.startswith("/"), at).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), at))
    resolved = F.concat(scheme, F.lit("://"), host_of(source), _without_dots(path), query)
    return (F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target).when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (target == ""), None)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target)).otherwise(resolved))


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, default: str = "allow",
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col host path rule verdict reason`` per row of ``pages``; ``reason``
    is ``rule``, ``alias`` or ``default``. ``redirects`` has ``from_url to_url``."""
    edges = html_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select("from_url", "to_url"))
    edges = edges.withColumn("to_url", _absolute(F.col("from_url"), F.col("to_url"))).where("instr(from_url, '://') > 0 and instr(to_url, '://') > 0")

    def address(url: Column) -> Column:
        return F.struct(host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))

    node = lambda a: F.concat(F.col(a)["host"], F.col(a)["path"], F.col(a)["query"])
    ends = edges.select(address(F.col("from_url")).alias("f"), address(F.col("to_url")).alias("t")).distinct()
    ends = stage(ends.select("f", "t", node("f").alias("src"), node("t").alias("dst")), "url-edges")
    comps = stage(connected_components(ends), "url-components")

    rows = pages.select(F.col(id_col), address(F.col(url_col)).alias("a"))
    addresses = rows.select("a").union(ends.select("f")).union(ends.select("t")).distinct().select("a.*", node("a").alias("node"))
    by_rule = judge_by_rules(addresses.select("host", "path").distinct(), rules)
    judged = stage(addresses.join(by_rule, ["host", "path"]).join(comps, "node", "left"), "url-judged")
    says = stage(judged.where("component is not null and action is not null").groupBy("component")
                 .agg(F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked")), "url-says")
    alias = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    judged = judged.join(says, "component", "left").select(
        "host", "path", "query", "rule", F.coalesce("action", alias, F.lit(default)).alias("verdict"),
        F.when(F.col("action").isNotNull(), "rule").when(alias.isNotNull(), "alias").otherwise("default").alias("reason"))
    rows = rows.select(id_col, "a.*")
    return rows.join(stage(judged, "url-verdicts"), ["host", "path", "query"]).select(id_col, "host", "path", "rule", "verdict", "reason")
