"""URL rules whose block decisions reach all redirect aliases.

A rule is a host and a path: it fits its host and all subdomains where the URL's path
starts with the rule's; of those that fit the longest (host and path together) wins.  Canonical
links and refresh redirects in the pages, and a redirect table if there is one, join URLs
into classes, found as connected components.  A URL without a rule of its own is blocked where its class holds a blocked
URL and no allowed one: an explicit allow, of the URL or of an alias, goes first.  Everything is DataFrame functions.

Rules meet URLs by equal keys, not by comparing each with each: a URL's host suffixes meet the rules' hosts, which
say what path lengths to look up.  Keys that hold very many rows (a domain, a link target, a
class, a URL) are spread over sub-keys; a rule list over ``broadcast_rules`` is joined in the same way.

Cases: a URL that is NULL or has no ``://`` has empty host and path, meets only rules with an empty host (that is,
none) and has no aliases; links to the URL itself, to other schemes (``mailto:``) or with empty targets count for nothing; the scheme and
the fragment do not tell URLs apart, host letters A-Z neither; dot segments stay as written.  Of equal rules that
disagree, allow counts.  Repeated rows stay, each with its verdict; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import skew
from .common import Scratch
from .components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_REST = r"(?s)^.*?://([^#]*)"
_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
_S = r"[ \t\r\n\f]"
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script|<style\b.*?</style"
_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = rf"(?is){_S}rel{_S}*={_S}*(?:\"[^\"]*\bcanonical\b|'[^']*\bcanonical\b|canonical\b)"
_REFRESH = rf"(?is){_S}http-equiv{_S}*={_S}*[\"']?{_S}*refresh\b"
_TARGET = rf"(?is)^[^;,]*[;,]{_S}*url{_S}*={_S}*[\"']?([^\"']*)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def _attribute(name: str) -> str:
    return rf"(?is){_S}{name}{_S}*={_S}*(?:\"([^\"]*)\"|'([^']*)'|([^ \t\r\n\f\"'>]+))"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def node(url: Column) -> Column:
    """What tells URLs apart: host, path and query; NULL without a host."""
    h = host(url)
    rest = F.regexp_extract(url, _REST, 1)
    return F.when(h != "", F.concat(h, F.substr(rest, F.length(h) + 1)))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) rows of a rule list."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    empty = F.from_json(F.lit("[]"), "array<struct<host string, path string, verdict string>>")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else empty))


def _meet(left: DataFrame, right: DataFrame, key: str, small: bool) -> DataFrame:
    """Left join with one row per key on the right: broadcast where small, else with the common keys spread."""
    if small:
        return left.join(F.broadcast(right), key, "left")
    counted = right.join(left.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")), key)
    return skew.salted_stats_join(left, counted, [key], "n_rows", how="left").drop("n_rows")


def match(urls: DataFrame, rules: DataFrame, broadcast_rules: int = 300_000) -> DataFrame:
    """``urls`` (with ``host`` and ``path``; each row distinct) with the ``rule`` that wins, as host and path in one string, and its verdict ``ruled``."""
    listed = rules.select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict")
    listed = listed.where("h <> ''").select(F.concat("h", "p").alias("key"), "h", "p", "verdict")
    listed = listed.groupBy("key", "h", "p").agg(F.min("verdict").alias("verdict"))
    n, labels = listed.agg(F.count(F.lit(1)), F.max(F.size(F.split("h", r"\.")))).first()
    small = n <= broadcast_rules
    hosts = listed.groupBy(F.col("h").alias("suffix")).agg(F.collect_set(F.length("p")).alias("lengths"))
    # no rule has more labels than these; a host has one suffix for each number of labels
    parts = F.reverse(F.split("host", r"\."))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels or 1))), lambda i: F.array_join(F.reverse(F.slice(parts, 1, i)), "."))
    found = _meet(urls.select("*", F.explode(suffixes).alias("suffix")), hosts, "suffix", small)
    lengths = F.filter("lengths", lambda k: k <= F.length("path"))
    found = found.select("*", F.explode_outer(lengths).alias("length")).drop("lengths")
    found = found.withColumn("key", F.when(F.col("length").isNotNull(), F.concat("suffix", F.left("path", F.col("length")))))
    found = _meet(found, listed.select("key", "verdict"), "key", small)
    # length of the rule, of its host, and the verdict in one number: the greatest wins, and its rule is cut from the URL
    size = lambda c: F.length(c).cast("long")
    score = F.shiftleft(size("key"), 22) + F.shiftleft(size("suffix"), 1) + (F.col("verdict") == "block").cast("long")
    best = found.groupBy(*urls.columns).agg(F.max(F.when(F.col("verdict").isNotNull(), score)).alias("best"))
    whole, own = F.shiftright("best", 22), F.shiftright("best", 1).bitwiseAND(F.lit((1 << 21) - 1))
    rule = F.concat(F.right("host", own), F.left("path", (whole - own).cast("int")))
    return best.select(*urls.columns, rule.alias("rule"), F.when(F.col("best") % 2 == 1, "block").when(F.col("best") % 2 == 0, "allow").alias("ruled"))


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b) nodes of each page and of the canonical and refresh targets in its HTML; comments, scripts and styles do not count."""
    tagged = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)canonical|refresh"))
    tags = F.regexp_extract_all(F.regexp_replace("html", _HIDDEN, " "), F.lit(_TAGS), F.lit(0))
    tag = F.col("tag")
    attribute = lambda name: F.concat(*[F.regexp_extract(tag, _attribute(name), g) for g in (1, 2, 3)])
    target = (
        F.when(F.lower(F.left(tag, F.lit(5))).eqNullSafe("<link") & tag.rlike(_CANONICAL), attribute("href"))
        .when(F.lower(F.left(tag, F.lit(5))).eqNullSafe("<meta") & tag.rlike(_REFRESH), F.regexp_extract(attribute("content"), _TARGET, 1))
        .alias("target")
    )
    found = tagged.select("url", F.explode(tags).alias("tag")).select("url", target).where("target IS NOT NULL")
    found = found.withColumn("target", F.replace(F.trim(F.regexp_replace("target", "[\\t\\r\\n\\f]", "")), F.lit("&amp;"), F.lit("&")))
    t, at = F.col("target"), F.concat(F.lit("http://"), host(F.col("url")))
    folder = F.regexp_extract(path(F.col("url")), "(?s)^(.*/)", 1)
    resolved = (
        F.when(t.rlike(_SCHEME), F.when(t.contains("://"), t))
        .when(t.startswith("//"), F.concat(F.lit("http:"), t))
        .when((t == "") | t.startswith("#"), None)
        .when(t.startswith("/"), F.concat(at, t))
        .when(t.startswith("?"), F.concat(at, path(F.col("url")), t))
        .otherwise(F.concat(at, F.when(folder == "", "/").otherwise(folder), t))
    )
    return found.select(node(F.col("url")).alias("a"), node(resolved).alias("b"))


def blocked_aliases(edges: DataFrame, rules: DataFrame, scratch: Scratch, broadcast_rules: int = 300_000) -> DataFrame:
    """Nodes of ``edges`` (a, b) without a rule of their own whose class holds a blocked URL and no allowed one."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node"))
    nodes = scratch.table(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("id", F.monotonically_increasing_id()))
    numbered = edges
    for end in ("a", "b"):
        ids = nodes.select(F.col("node").alias(end), "n_rows", F.col("id").alias(f"{end}_id"))
        numbered = skew.salted_stats_join(numbered, ids, [end], "n_rows").drop("n_rows", end)
    classes = connected_components(numbered.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")), scratch)
    as_url = F.concat(F.lit("http://"), "node")
    ruled = match(nodes.select("id", "node", host(as_url).alias("host"), path(as_url).alias("path")), rules, broadcast_rules)
    members = scratch.table(ruled.join(classes, ruled["id"] == classes["node"]).select(ruled["node"], "ruled", "root"))
    verdicts = members.groupBy("root").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.col("ruled") == "block").alias("blocked"), F.max(F.col("ruled") == "allow").alias("allowed")
    )
    verdicts = verdicts.where("blocked AND NOT coalesce(allowed, false)").select("root", "n_rows")
    return skew.salted_stats_join(members.where("ruled IS NULL"), verdicts, ["root"], "n_rows").select("node")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    broadcast_rules: int = 300_000,
) -> DataFrame:
    """A row per page: id, host, path, rule (NULL if none fits) and verdict, ``allow`` or ``block``.

    ``redirects`` adds links, as (from_url, to_url).
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col(url_col)
    urls = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), node(url).alias("node"))
    # the row number keeps equal rows apart; it is written with them, so it stays
    ruled = match(scratch.table(urls.withColumn("row", F.monotonically_increasing_id())), rules, broadcast_rules)
    edges = links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b")))
    edges = scratch.table(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct())
    verdict = F.coalesce("ruled", F.lit("allow"))
    if not edges.isEmpty():
        ruled = scratch.table(ruled)
        blocked = scratch.table(blocked_aliases(edges, rules, scratch, broadcast_rules))
        counts = ruled.groupBy("node").agg(F.count(F.lit(1)).alias("n_rows"))
        stats = blocked.join(counts, "node").withColumn("blocked", F.lit(True))
        ruled = skew.salted_stats_join(ruled, stats, ["node"], "n_rows", how="left")
        verdict = F.coalesce("ruled", F.when(F.col("blocked"), "block"), F.lit("allow"))
    return ruled.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
