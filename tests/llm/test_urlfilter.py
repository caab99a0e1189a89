"""URL rules and aliases against plain Python, and the common routes against the spread ones."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stagegate.llm import queries, urlfilter

SCHEMA = "page_id long, url string, html string"


def cut(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)(\?[^#]*)?", url or "")
    if not m:
        return "", "", None
    host = "".join(c.lower() if c.isascii() else c for c in m[1])
    return host, m[2], host + m[2] + (m[3] or "") if host else None


def fits(host, path, rules):
    of = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(of)[2:] if of else (None, None)


def brute(pages, links, rules):
    """Verdicts by a union-find over all links (a, b of URLs)."""
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = cut(a)[2], cut(b)[2]
        if a and b:
            up[top(a)] = top(b)
    ruled = {}
    for x in list(up):
        h, p, _ = cut("http://" + x)
        ruled.setdefault(top(x), set()).add(fits(h, p, rules)[1])
    out = []
    for i, url in pages:
        h, p, n = cut(url)
        rule, verdict = fits(h, p, rules)
        if verdict is None:
            of = ruled.get(top(n), ()) if n in up else ()
            verdict = "block" if "block" in of and "allow" not in of else "allow"
        out.append((i, h, p, rule, verdict))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_url(rng):
    host = rng.choice(["a.example.org", "example.org", "Example.ORG", "b.com", "x.b.com", "c.net", "d.net", "deep.er.c.net", "org", "notorg", "com"])
    path = rng.choice(["", "/", "/es/1", "/en/1", "/en/2", "/fr/x", "/de/y", "/de", "/q"])
    return rng.choice(["http", "https"]) + "://" + host + path + rng.choice(["", "", "?a=1", "#top", "?b#c", "?u=http://org/"])


def test_pages_with_links(spark, tmp_path):
    rng = random.Random(1)
    pages, links = [], []
    for i in range(400):
        url = rng.choice([some_url(rng)] * 12 + [None, "", "nothing", "mailto:a@b.com", "http:///p"])
        html = "<html><head><title>t</title>"
        if rng.random() < 0.3:
            target = some_url(rng)
            shown = target.replace("&", "&amp;")
            html += rng.choice(
                [f'<link rel="canonical" href="{shown}">', f"<LINK href='{shown}' rel='x Canonical'/>", f"<link rel=canonical href={shown}>",
                 f'<meta http-equiv="refresh" content="0; url={shown}">', f'<meta content="5;URL=\'{shown}\'" HTTP-EQUIV=Refresh>']
            )
            links.append((url, target))
        html += rng.choice(["", f'<!-- <link rel="canonical" href="{some_url(rng)}"> -->', f'<link rel="alternate" href="{some_url(rng)}">', '<link rel="canonical">'])
        pages.append((i, url, rng.choice([html] * 30 + [None]) if not (links and links[-1][0] is url) else html))
    pages += pages[:7]
    df = spark.createDataFrame(pages, SCHEMA).withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1)).repartition(4)
    want = brute([p[:2] for p in pages], links, queries.URL_RULES)
    rules = urlfilter.rule_table(spark, queries.URL_RULES)
    assert {w[4] for w in want if w[3] is None} == {"allow", "block"}  # the links decide something
    assert rows(urlfilter.judge(df, rules)) == want
    # and so does the SQL
    df.coalesce(1).write.parquet(f"{tmp_path}/pages")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    assert sorted(con.execute(queries.oracle_sql()["op13_url_filter"]).fetchall(), key=str) == want
    # the route of long rule lists and spread keys
    assert rows(urlfilter.judge(df, rules, broadcast_rules=0)) == want


def test_relative_targets_and_redirect_table(spark):
    tag = lambda t: f'<link rel="canonical" href="{t}">'
    pages = [
        (1, "http://c.net/a/b", tag("/blocked")), (2, "http://c.net/a/b2", tag("c?x=1")), (3, "http://c.net/a/c?x=1", tag("?x=2")),
        (4, "http://c.net/a/c?x=2", tag("//c.net/blocked")), (5, "http://c.net/z", tag("mailto:x@c.net")), (6, "http://c.net/z2", tag("#frag")),
        (7, "http://c.net", tag("blocked")), (8, "http://d.net/r", ""), (9, "http://c.net/ok", tag("http://c.net/a/b")),
    ]
    rules = urlfilter.rule_table(spark, [("c.net", "/blocked", "block"), ("c.net", "/ok", "allow"), ("c.net", "/ok", "block")])
    redirects = spark.createDataFrame([("https://D.net/r", "http://c.net/a/b#x"), (None, "http://c.net/z")], "from_url string, to_url string")
    verdicts = lambda pages: {r.page_id: r.verdict for r in urlfilter.judge(spark.createDataFrame(pages, SCHEMA), rules, redirects).collect()}
    assert verdicts(pages[:8]) == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "block", 8: "block"}
    # an allowed alias frees those without a rule, and equal rules that disagree allow
    assert set(verdicts(pages).values()) == {"allow"}


def test_star_of_common_target(spark):
    pages = [(i, f"http://p{i}.net/", '<link rel="canonical" href="http://hub.com/de/x">') for i in range(500)]
    out = urlfilter.judge(spark.createDataFrame(pages, SCHEMA), urlfilter.rule_table(spark, queries.URL_RULES))
    assert out.where("verdict = 'block' AND rule IS NULL").count() == 500


def test_query_on_sf_table(spark):
    d = "/root/testdata/sf0.001"
    pages = [(r.page_id, r.url) for r in queries.table(spark, d, "pages").collect()]
    assert rows(queries.op13_url_filter(spark, d)) == brute(pages, [], queries.URL_RULES)


@pytest.mark.parametrize("pages", [[], [(None, None, None)], [(1, "http://a.org/" + "x" * 100_000, "<link>"), (2, "http://" + "a." * 5000 + "org/", "")]])
def test_edges(spark, pages):
    rules = urlfilter.rule_table(spark, queries.URL_RULES)
    assert rows(urlfilter.judge(spark.createDataFrame(pages, SCHEMA), rules)) == brute([p[:2] for p in pages], [], queries.URL_RULES)
    assert urlfilter.judge(spark.createDataFrame(pages, SCHEMA), urlfilter.rule_table(spark, [])).count() == len(pages)
