"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule is a regular expression.  From its syntax follows which trigrams any
match must contain, as a Boolean query: an AND of clauses, each an OR of sets of
trigrams that occur together.  The index holds, for the trigrams that some rule
mentions, the documents that contain them; intersecting its postings gives each
rule's candidate documents, and only those are searched with the expression.
A rule without mandatory trigrams searches every document.

The index is built over lower-cased text, so it serves rules in either case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

# an expression's syntax tree, as Python's standard library parses it
_parse = re._parser.parse

# stands around matches while they are cut out; a text's own marks become the other one first
_MARK, _OTHER = "\x01", "\x02"
# finite sets of strings larger than this say nothing
_MOST = 64


@dataclass(frozen=True)
class Rule:
    """``pattern``: without groups but those whose length ``least`` (group, characters) demands; both dialects (Python, Java) read it alike."""

    kind: str
    pattern: str
    any_case: bool = False
    least: tuple[int, int] = (0, 1)


# The base kinds, in their order
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, (2, 8)),
    Rule("access", r"AKIA[A-Z0-9]+", False, (0, 16)),
    Rule("hex", r"[0-9a-f]+", False, (0, 32)),
)
# Further public formats of credentials
MORE_RULES = (
    # up to the END line, over nothing but base64, headers and white space; without one the key's lines as far as they go
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[A-Za-z0-9+/=:,\x5C\x20\x09-\x0D-]*?-----END (?:[A-Z]+ )*PRIVATE KEY-----|[\x20\x09]*[A-Za-z0-9+/=\x5C\x0A\x0D]*)"),
    Rule("git_token", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("pay_key", r"sk_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("basic_auth", r"[a-z]+://[A-Za-z0-9._-]+:[^\x20\x09-\x0D@/]{4,}@"),
)


def _strings(node) -> set[str] | None:
    """All strings that a piece of syntax matches, if they are few."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        out: set[str] = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                out.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out
    if op == "SUBPATTERN":
        return _joined(arg[3])
    if op == "BRANCH":
        parts = [_joined(x) for x in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op == "MAX_REPEAT" and arg[1] != re._parser.MAXREPEAT and arg[1] <= 8:
        one = _joined(arg[2])
        if one is None or len(one) ** arg[1] > _MOST:
            return None
        out, power = set(), {""}
        for k in range(arg[1] + 1):
            out |= power if k >= arg[0] else set()
            power = {a + b for a in power for b in one}
        return out
    return None


def _joined(nodes) -> set[str] | None:
    out = {""}
    for n in nodes:
        s = _strings(n)
        if s is None or len(out) * len(s) > _MOST:
            return None
        out = {a + b for a in out for b in s}
    return out


def trigram_query(pattern: str) -> list[set[frozenset[str]]]:
    """AND over the list, OR over each set, AND over each frozenset of trigrams; [] if nothing is mandatory."""
    clauses: list[set[frozenset[str]]] = []

    def close(run: set[str]) -> None:
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in options and options:  # an option that demands more than another adds nothing
            clauses.append({o for o in options if not any(x < o for x in options)})

    def walk(nodes) -> None:
        run = {""}
        for n in nodes:
            s = _strings(n)
            if s is not None and len(run) * len(s) <= _MOST:
                run = {a + b for a in run for b in s}
                continue
            close(run)
            run = s if s is not None and len(s) <= _MOST else {""}
            if s is None:
                op, arg = str(n[0]), n[1]
                if op == "SUBPATTERN":
                    walk(arg[3])
                elif op == "MAX_REPEAT" and arg[0] >= 1:
                    walk(arg[2])
        close(run)

    walk(_parse(pattern))
    return clauses


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of the given trigrams: a row (trigram number, row id) per document that contains one."""
    low = texts.select("row", F.lower("text").alias("low"))
    has = [F.when(F.col("low").contains(t), F.lit(i)) for i, t in enumerate(trigrams)]
    return low.select("row", F.explode(F.array_compact(F.array(*has))).alias("gram"))


def candidates(index: DataFrame, rules: dict[str, list[set[frozenset[str]]]], trigrams: list[str]) -> DataFrame:
    """Documents whose postings satisfy a rule's query: (row, rules array<string>).

    An option of a clause is a set of postings whose intersection counts; all are
    intersected in one aggregation by document, with partial counts before the shuffle.
    """
    number = {t: i for i, t in enumerate(trigrams)}
    # the trigrams of a document as bits, 60 to a column
    words = range((len(trigrams) + 59) // 60)
    bit = lambda w: F.expr(f"CASE WHEN gram >= {60 * w} AND gram < {60 * w + 60} THEN shiftleft(1L, gram - {60 * w}) ELSE 0L END")
    met = index.groupBy("row").agg(*[F.bit_or(bit(w)).alias(f"g{w}") for w in words])

    def holds(option: frozenset[str]) -> Column:
        masks = {w: sum(1 << (number[t] - 60 * w) for t in option if 60 * w <= number[t] < 60 * w + 60) for w in words}
        return reduce(lambda a, b: a & b, [F.col(f"g{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in masks.items() if m])

    def query(clauses) -> Column:
        return reduce(lambda a, b: a & b, [reduce(lambda a, b: a | b, [holds(o) for o in sorted(c, key=sorted)]) for c in clauses])

    hit = F.array_compact(F.array(*[F.when(query(q), F.lit(k)) for k, q in rules.items()]))
    return met.select("row", hit.alias("rules")).where(F.size("rules") > 0)


def rule_spans(rule: Rule, text: Column) -> Column:
    """array<struct<start, end>>: leftmost non-overlapping matches (code points, end exclusive) that are long enough."""
    pattern = ("(?i)" if rule.any_case else "") + rule.pattern
    cut = F.split(F.regexp_replace(text, f"(?:{pattern})", f"{_MARK}$0{_MARK}"), _MARK)
    group, least = rule.least
    # segments alternate between what stands outside and inside matches
    outside = F.transform(F.filter(cut, lambda s, i: i % 2 == 0), F.char_length)
    inside = F.filter(cut, lambda s, i: i % 2 == 1)
    good = lambda s: F.char_length(F.regexp_extract(s, pattern, group) if group else s) >= least
    at = "struct<pos:int,spans:array<struct<start:int,end:int>>>"
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc, x):
        start = acc["pos"] + x["outside"]
        end = start + F.char_length(x["inside"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("pos"), F.when(good(x["inside"]), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans")).cast(at)

    pairs = F.arrays_zip(F.slice(outside, F.lit(1), F.size(inside)).alias("outside"), inside.alias("inside"))
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("pos"), none.alias("spans")).cast(at), step)["spans"]
    # a match is at least so long, so most texts need no cutting
    return F.when(F.regexp_like(text, F.lit(_quick(rule, pattern))), walked).otherwise(none)


def _named(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def _quick(rule: Rule, pattern: str) -> str:
    """A cheaper test that holds for every text with a long enough match."""
    if rule.least[0] == 0 and rule.pattern.endswith("]+") and rule.least[1] > 1:
        head, _, last = rule.pattern.rpartition("[")
        return f"{'(?i)' if rule.any_case else ''}{head}[{last[:-1]}{{{rule.least[1] - len(head)},}}"
    return pattern


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Spans per document: id (and, as a struct ``docs``, the columns in ``keep``) and ``spans`` array<struct<kind, rank, start, end>> by start, then rule order.

    NULL text is empty and has no spans.  NULL ids and repeated rows come out as
    they went in.  An empty table gives none.  Overlapping spans of different
    rules are all kept; within a rule matches do not overlap.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    trigrams = sorted({t for q in indexed.values() for c in q for o in c for t in o})
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _MARK, _OTHER)
    # a row is known by its id and text, so that repeated ids stay apart
    more = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("docs")] if keep else []
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *more).withColumn("row", F.struct(F.col("doc_id"), F.xxhash64("text").alias("h")))
    if indexed:
        index = scratch.table(postings(texts, trigrams).select("row.doc_id", "row.h", "gram"))
        index = index.select(F.struct("doc_id", "h").alias("row"), "gram")
        found = candidates(index, indexed, trigrams).select(F.col("row.doc_id").alias("c_id"), F.col("row.h").alias("c_h"), "rules")
        found = scratch.table(found)
        flagged = texts.join(found, F.col("row.doc_id").eqNullSafe(F.col("c_id")) & (F.col("row.h") == F.col("c_h")), "left")
    else:
        flagged = texts.withColumn("rules", F.lit(None).cast("array<string>"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    each = []
    for rank, r in enumerate(rules):
        spans = rule_spans(r, F.col("text"))
        spans = F.when(F.array_contains("rules", r.kind), spans).otherwise(none) if r.kind in indexed else spans
        each.append(_named(spans, rank, r.kind))
    return flagged.select("doc_id", *["docs"] * bool(keep), F.array_sort(F.concat(*each)).alias("spans"))


def _covers(spans: Column) -> Column:
    """Spans by start with those that overlap joined: array<struct<start, end, kind>>; the first one's kind counts."""
    at = "array<struct<start:int,end:int,kind:string>>"

    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        inside = F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0)) > s["start"]
        return F.when((F.size(acc) > 0) & inside, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, own)).cast(at)

    return F.aggregate(spans, F.array().cast(at), step)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span found replaced by <KIND>; all rows and columns stay, other texts as they are.

    Spans that overlap are replaced together.  NULL text stays NULL.
    """
    found = find_secrets(docs, rules, id_col, text_col, keep=[c for c in docs.columns])
    spans = _covers(F.col("spans"))
    # the text between spans and the kinds, one after the other
    ends = F.concat(F.array(F.lit(0)), F.transform("_cover", lambda s: s["end"]))
    parts = F.transform(
        F.arrays_zip(F.col("_cover").alias("s"), F.slice(ends, F.lit(1), F.size("_cover")).alias("at")),
        lambda x: F.concat(F.substring(F.col(f"docs.`{text_col}`"), x["at"] + 1, x["s"]["start"] - x["at"]), F.lit("<"), F.upper(x["s"]["kind"]), F.lit(">")),
    )
    tail = F.substring(F.col(f"docs.`{text_col}`"), F.element_at(ends, -1) + 1, F.lit(2147483647))
    text = F.when(F.size("_cover") > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(F.col(f"docs.`{text_col}`"))
    return found.withColumn("_cover", spans).select(*[(text if c == text_col else F.col(f"docs.`{c}`")).alias(c) for c in docs.columns])


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of the base kinds, sha256 of their spans and all spans as text."""
    kinds = [r.kind for r in base]
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *[count(k) for k in kinds],
        F.sha2(told(F.filter("spans", lambda s: s["kind"].isin(kinds))).cast("binary"), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )
