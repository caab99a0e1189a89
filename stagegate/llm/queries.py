"""The registered queries of the operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fertility, minhash, neighbours, packing, ppm, repair, secrets, shards, toxicity, urlfilter, warc, whiten
from .common import crc_mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A public vocabulary file; the folder is a parameter (LLM_TOKENIZERS), the installed one by default."""
    folder = os.environ.get("LLM_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_minmax_near_duplicates(spark, d):
    return minhash.near_duplicates(table(spark, d, "documents"), percent=85, size=3)


def op2_ppm(spark, d):
    docs = table(spark, d, "documents")
    held_out = crc_mod("doc_id", 5) == 1
    out = ppm.score(docs, docs.where(F.coalesce(~held_out, F.lit(True))))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_token_shards(spark, d):
    return shards.write_and_read(table(spark, d, "documents"), vocabulary("byte_bpe_50k.json"), 2)


def op4_toxicity(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    lexicon = toxicity.learn(docs, labels.where(crc_mod("doc_id", 5) != 0))
    out = toxicity.score(docs, lexicon)
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches")


def op5_warc(spark, d):
    return warc.write_and_read(table(spark, d, "pages"))


def op6_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"), 0)


def op7_quality_neighbours(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    space = neighbours.learn(docs, labels.where(crc_mod("doc_id", 3) != 1))
    out = neighbours.score(docs, space)
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_secret_scan(spark, d):
    return secrets.digest(secrets.find_secrets(table(spark, d, "documents")))


def op9_fertility_rules(spark, d):
    return fertility.rate(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


def op10_benchmark_passages(spark, d):
    return decontaminate.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that the crc32 of ``conv_id:turn`` plants; a dropped row stays with ``present`` false."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op11_conversation_repair(spark, d):
    return repair.audits(damaged(table(spark, d, "conversations")), present="present")


def op12_whitening(spark, d):
    out = whiten.whiten(table(spark, d, "embeddings"), components=4)
    by_component = out.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
    return by_component.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"),
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error",
    )


# the rule list of the URL query: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op13_url_filter(spark, d):
    return urlfilter.judge(table(spark, d, "pages"), urlfilter.rule_table(spark, URL_RULES))


def pipeline(spark, d):
    import corpus_pipeline  # stands beside the package and imports it

    return corpus_pipeline.run(spark, d)


def queries() -> dict:
    """Every operator's query by its name, and the pipeline."""
    by_number = sorted((int(k[2:].split("_")[0]), k) for k in globals() if re.match(r"op\d+_", k))
    return {k: globals()[k] for _, k in by_number} | {"pipeline": pipeline}


def _url_oracle() -> str:
    """The URL query in DuckDB: rules by comparing each, classes by reaching from every linked URL."""
    u = urlfilter
    text = lambda x: "'" + x.replace("'", "''") + "'"
    take = lambda c, pattern, g=1: f"regexp_extract({c}, {text(pattern)}, {g})"
    host = lambda c: f"translate({take(c, u._HOST)}, '{u._UPPER}', '{u._LOWER}')"
    node = lambda c: f"CASE WHEN {host(c)} <> '' THEN {host(c)} || substr({take(c, u._REST)}, length({host(c)}) + 1) END"
    attribute = lambda name: " || ".join(take("tag", u._attribute(name), g) for g in (1, 2, 3))
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    fits = "(x.host = r.h OR ends_with(x.host, '.' || r.h)) AND starts_with(x.path, r.p)"
    best = "arg_max(r.h || r.p, length(r.h || r.p) * 1000 + length(r.h)) AS rule, arg_max(r.v, length(r.h || r.p) * 1000 + length(r.h)) AS ruled"
    return f"""WITH RECURSIVE r(h, p, v) AS (VALUES {rules}),
pages_cut AS (SELECT page_id, html, {host("coalesce(url, '')")} AS host, {take("coalesce(url, '')", u._PATH)} AS path, {node("coalesce(url, '')")} AS node FROM pages),
tags AS (SELECT host, path, node, unnest(regexp_extract_all(regexp_replace(html, {text(u._HIDDEN)}, ' ', 'g'), {text(u._TAGS)})) AS tag
  FROM pages_cut WHERE regexp_matches(html, '(?i)canonical|refresh')),
found AS (SELECT host, path, node, CASE WHEN lower(left(tag, 5)) = '<link' AND regexp_matches(tag, {text(u._CANONICAL)}) THEN {attribute("href")}
    WHEN lower(left(tag, 5)) = '<meta' AND regexp_matches(tag, {text(u._REFRESH)}) THEN {take("(" + attribute("content") + ")", u._TARGET)} END AS target FROM tags),
targets AS (SELECT host, path, node, replace(trim(regexp_replace(target, '[\t\r\n\f]', '', 'g'), ' '), '&amp;', '&') AS t FROM found WHERE target IS NOT NULL),
resolved AS (SELECT node AS a, CASE WHEN regexp_matches(t, '{u._SCHEME}') THEN CASE WHEN contains(t, '://') THEN t END
    WHEN starts_with(t, '//') THEN 'http:' || t WHEN t = '' OR starts_with(t, '#') THEN NULL WHEN starts_with(t, '/') THEN 'http://' || host || t
    WHEN starts_with(t, '?') THEN 'http://' || host || path || t
    ELSE 'http://' || host || CASE WHEN regexp_extract(path, '(?s)^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || t END AS url FROM targets),
links AS (SELECT DISTINCT a, {node("url")} AS b FROM resolved WHERE url IS NOT NULL),
edges AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
nodes AS (SELECT DISTINCT a AS node, regexp_extract(a, '(?s)^([^/?]*)', 1) AS host, regexp_extract(a, '(?s)^[^/?]*([^?]*)', 1) AS path FROM edges),
ruled_nodes AS (SELECT x.node, {best} FROM nodes x JOIN r ON {fits} GROUP BY x.node),
classes AS (SELECT reach.a AS node, bool_or(n.ruled = 'block') AND NOT bool_or(n.ruled = 'allow') AS blocked FROM reach JOIN ruled_nodes n ON reach.b = n.node GROUP BY reach.a),
cut AS (SELECT DISTINCT host, path FROM pages_cut),
ruled AS (SELECT x.host, x.path, {best} FROM cut x JOIN r ON {fits} GROUP BY x.host, x.path)
SELECT p.page_id, p.host, p.path, q.rule, coalesce(q.ruled, CASE WHEN c.blocked THEN 'block' END, 'allow') AS verdict
FROM pages_cut p LEFT JOIN ruled q ON p.host = q.host AND p.path = q.path LEFT JOIN classes c ON p.node = c.node"""


def oracle_sql() -> dict[str, str]:
    return {
        # DuckDB's sha1() takes text and hashes its UTF-8 bytes
        "op5_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, strlen(h) AS n, sha1(h) AS digest, max(page_id) OVER (PARTITION BY h) AS keep FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keep THEN keep END AS refers_to
FROM r""",
        "op13_url_filter": _url_oracle(),
    }
