"""Value consistency between two layers (source vs staging), without emitting pairs.

Semantics: inner-join the two sides on ``=`` of every key part; for each non-key
column present on both sides count the joined *pairs* whose values differ
NULL-safely.  A key held by ``m`` source rows and ``n`` staging rows contributes
``m * n`` pairs.

Emitting those pairs is quadratic in a hot key (a key with a third of all rows
would produce ~N²/9 pairs), so the pairs are never built:

* one tagged aggregate by key over both sides (``layerkeys``) gives each key's row
  counts and the spread of a 128-bit digest of the compared values.  Keys whose digest
  is constant have no mismatch and are done;
* only for the other keys are values read.  Keys with one row on each side are
  joined one to one and compared column by column;
* for the rest ("multi keys") both sides are reduced to ``(key, column, value) → row counts``;
  the number of equal pairs of a column is ``Σ_v m_v · n_v`` over its values ``v``,
  and the number of unequal pairs is ``m · n − Σ_v m_v · n_v``.  The
  reduction is one aggregate with a map-side part, so a hot key collapses before the shuffle.

The first step runs when the function is called: what it finds decides the plan of the
rest (which keys are broadcast, which parts are there at all).  With ``exact=True``, and where a
compared column is an array, a struct or a map, a first aggregate carries the values instead of
digests; it is lazy and needs no digest, but sorts wide rows.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.compare import ComparablePair, comparable_pair
from ..functions.predicates import keys_not_null, qcol
from . import layerkeys, skew


@dataclass(frozen=True)
class ConsistencyPlan:
    key: tuple[str, ...]
    compared: tuple[ComparablePair, ...]
    skipped: tuple[str, ...]  # source columns absent from the other side

    @property
    def drifted(self) -> tuple[str, ...]:
        return tuple(p.name for p in self.compared if p.drift)


_KEY = layerkeys.KEY


def plan_consistency(source: DataFrame, other: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None) -> ConsistencyPlan:
    s_types = {f.name: f.dataType for f in source.schema.fields}
    o_types = {f.name: f.dataType for f in other.schema.fields}
    missing_key = [k for k in key if k not in s_types or k not in o_types]
    if missing_key:
        raise ValueError(f"key column(s) {missing_key} missing on one side")
    candidates = [c for c in (columns or source.columns) if c not in key]
    compared, skipped = [], []
    for c in candidates:
        if c not in o_types or c not in s_types:
            skipped.append(c)
            continue
        compared.append(
            comparable_pair(c, F.col(f"s.{_q(c)}"), s_types[c], F.col(f"o.{_q(c)}"), o_types[c])
        )
    return ConsistencyPlan(tuple(key), tuple(compared), tuple(skipped))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# A multi key with very many rows is spread over sub-keys (see ``skew.salted_stats_join``).
HOT_KEY_MIN_ROWS = skew.HOT_KEY_MIN_ROWS
MAX_HOT_KEYS = skew.MAX_HOT_KEYS


def _side(df: DataFrame, plan: ConsistencyPlan, side: str) -> DataFrame:
    """One side's rows as (key, ``_v`` struct of the comparable forms); no other name leaves the input."""
    forms = [p.left if side == "s" else p.right for p in plan.compared]
    return df.where(keys_not_null(plan.key)).alias(side).select(
        *[qcol(k, side).alias(_KEY.format(i)) for i, k in enumerate(plan.key)],
        F.struct(*[e.alias(f"c{i}") for i, e in enumerate(forms)]).alias("_v"),
    )


def _per_key(source: DataFrame, other: DataFrame, plan: ConsistencyPlan) -> DataFrame:
    """A row per key held by both sides: rows on each (``_m``, ``_n``) and one row's values of each (``_sv``, ``_ov``).

    One pass over the two sides, one shuffle: a hot key collapses in the partial
    aggregate, so it needs no routing.  For a key with one row on each side
    ``_sv`` and ``_ov`` are that pair.
    """
    kcols = [_KEY.format(i) for i in range(len(plan.key))]
    both = _side(source, plan, "s").withColumn("_left", F.lit(True)).unionByName(_side(other, plan, "o").withColumn("_left", F.lit(False)))
    left = F.col("_left")
    agg = both.groupBy(*kcols).agg(
        F.count_if(left).alias("_m"),
        F.count_if(~left).alias("_n"),
        F.first(F.when(left, F.col("_v")), ignorenulls=True).alias("_sv"),
        F.first(F.when(~left, F.col("_v")), ignorenulls=True).alias("_ov"),
    )
    # the tests on the values are always true here; they keep both structs in every use of the
    # aggregate, so that all uses are one exchange
    return agg.where((F.col("_m") > 0) & (F.col("_n") > 0) & F.col("_sv").isNotNull() & F.col("_ov").isNotNull())


_SINGLE = "_m = 1 AND _n = 1"


def _differs(i: int) -> Column:
    return ~F.col(f"_sv.c{i}").eqNullSafe(F.col(f"_ov.c{i}"))


def _cells(side: DataFrame, multi: DataFrame, count_col: str, plan: ConsistencyPlan, hot: tuple[int, int] | None, exact: bool, by_key: bool) -> DataFrame:
    """(key, column index, value) of one side's rows of the keys in ``multi``.

    A hot key's rows are spread where they meet it; with ``hot`` None there is no hot key, and the cells keep a
    partitioning by key (``by_key`` makes one, of the rows, where the keys are broadcast).

    With ``exact`` a value keeps its own type: ``_w`` is a struct with one slot per distinct
    comparable type, the column's value in its slot and NULL elsewhere.  Spark
    groups structs field by field with NULL equal to NULL, and
    normalises -0.0/NaN inside them, which is exactly NULL-safe equality.  Else ``_w`` is the
    value's 128-bit digest, two numbers whatever the type.
    """
    kcols = [_KEY.format(i) for i in range(len(plan.key))]
    types = [p.dtype for p in plan.compared]  # comparable type of each column, known without analysis
    values = [F.col(f"_v.c{i}") for i in range(len(types))]
    if exact:
        distinct = []
        for t in types:
            if t not in distinct:
                distinct.append(t)
        nulls = [F.lit(None).cast(t) for t in distinct]  # one NULL literal per slot type, shared by all cells
        forms = [F.struct(*[(v if t == d else nulls[j]).alias(f"s{j}") for j, d in enumerate(distinct)]) for v, t in zip(values, types)]
        cells = [F.struct(F.lit(i).alias("_ci"), w.alias("_w")) for i, w in enumerate(forms)]
    else:
        cells = [F.struct(F.lit(i).alias("_ci"), *[h.alias(n) for n, h in zip(_HASHES, layerkeys.digests([v]))]) for i, v in enumerate(values)]
    if hot is None:
        rows = side.join(multi.select(*kcols), kcols, "left_semi")
    else:
        rows = skew.salted_stats_join(side, multi.select(*kcols, count_col), kcols, count_col, *hot)
    rows = rows.repartition(*kcols) if by_key else rows
    return rows.select(*kcols, F.inline(F.array(*cells)))


_HASHES = ("_w0", "_w1")


def _multi_matches(
    source: DataFrame, other: DataFrame, multi: DataFrame, plan: ConsistencyPlan, hot: tuple[int, int] | None, exact: bool = False, by_key: bool = False
) -> DataFrame:
    """Rows (key, column index, ``_eq``) whose ``_eq`` sum per (key, column) is the number of NULL-safe equal pairs.

    The values of both sides go into one ``(key, column, value) → rows of each side`` aggregate (partial before the
    shuffle, so a hot key collapses per task; without hot keys rows are dealt by key and need no second shuffle);
    ``m_v · n_v`` of a value is its number of equal pairs.
    """
    kcols = [_KEY.format(i) for i in range(len(plan.key))]
    left = _cells(_side(source, plan, "s"), multi, "_m", plan, hot, exact, by_key).withColumn("_left", F.lit(True))
    right = _cells(_side(other, plan, "o"), multi, "_n", plan, hot, exact, by_key).withColumn("_left", F.lit(False))
    value = ["_w"] if exact else list(_HASHES)
    counts = left.unionByName(right).groupBy(*kcols, "_ci", *value).agg(F.count_if("_left").alias("_cs"), F.count_if(~F.col("_left")).alias("_co"))
    return counts.where("_cs > 0 AND _co > 0").select(*kcols, "_ci", (F.col("_cs") * F.col("_co")).alias("_eq"))


_SUMMARY = T.StructType(
    [T.StructField("column_name", T.StringType()), T.StructField("mismatches", T.LongType()), T.StructField("pairs", T.LongType())]
)


def find_differing(source: DataFrame, other: DataFrame, plan: ConsistencyPlan, counters: dict[str, Column] | None = None, only_differing: bool = True) -> layerkeys.KeyFindings:
    """The tagged aggregate of both sides for the compared columns of ``plan`` (plain types only)."""
    left, right = [p.left for p in plan.compared], [p.right for p in plan.compared]
    return layerkeys.find(source, other, plan.key, left, right, counters, only_differing)


def has_digest(plan: ConsistencyPlan) -> bool:
    return bool(plan.compared) and layerkeys.can_digest([p.dtype for p in plan.compared])


def consistency_parts(
    source: DataFrame,
    other: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    exact: bool = False,
    found: layerkeys.KeyFindings | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``consistency_summary`` and ``inconsistent_keys`` over the same first aggregate.

    ``found`` is what ``find_differing`` gave for the same sides, if the caller has it already.
    """
    plan = plan_consistency(source, other, key, columns)
    if not plan.compared:
        raise ValueError("no shared non-key column to compare")
    hot = (hot_key_rows, max_hot_keys)
    if hot_key_rows < 1:
        raise ValueError("hot_key_rows must be at least 1")
    if exact or not has_digest(plan):
        per_key = _per_key(source, other, plan)
        matches = _multi_matches(source, other, per_key.where(f"NOT ({_SINGLE})"), plan, hot, exact=True)
        return _summary(per_key, matches, plan), _keyed(per_key.where(_SINGLE), per_key.where(f"NOT ({_SINGLE})"), matches, plan)
    found = found or find_differing(source, other, plan)
    multi = found.differing(single=False)
    singles = _single_pairs(source, other, found, plan)
    matches = _found_matches(source, other, multi, found, plan, *hot)
    return _digest_summary(singles, matches, found.totals, plan), _keyed(singles, multi, matches, plan)


def _single_pairs(source: DataFrame, other: DataFrame, found: layerkeys.KeyFindings, plan: ConsistencyPlan) -> DataFrame:
    """The two rows' values (``_sv``, ``_ov``) of the keys with one row on each side that differ.

    The sides meet in an aggregate: a join would carry one side's filters over to the other, whose rows would then be
    shuffled here and once more, without them, for the multi keys.
    """
    kcols = found.kcols
    keys = found.differing(single=True).select(*kcols)
    left = _side(source, plan, "s").join(keys, kcols, "left_semi").withColumn("_left", F.lit(True))
    right = _side(other, plan, "o").join(keys, kcols, "left_semi").withColumn("_left", F.lit(False))
    value = lambda side: F.first(F.when(side, F.col("_v")), ignorenulls=True)
    return left.unionByName(right).groupBy(*kcols).agg(value(F.col("_left")).alias("_sv"), value(~F.col("_left")).alias("_ov"))


def summary_with_samples(
    source: DataFrame, other: DataFrame, found: layerkeys.KeyFindings, plan: ConsistencyPlan, n: int, hot_key_rows: int = HOT_KEY_MIN_ROWS, max_hot_keys: int = MAX_HOT_KEYS
) -> tuple[dict[str, int], list[str]]:
    """(mismatches by column, the first ``n`` rows of ``inconsistent_keys`` in key and column order as JSON), in one pass over the values.

    Every key that differs has a mismatch, so the samples are among the first ``n`` such keys, which are known before: beside
    its total each column sums up theirs.
    """
    kcols, t = found.kcols, found.totals
    multi = found.differing(single=False)
    names = F.to_json(F.struct(*[F.col(c).alias(k) for c, k in zip(kcols, plan.key)]), {"ignoreNullFields": "false"})
    firsts = found.wrong.where("_differs").orderBy(*kcols).limit(n).select(*kcols, "_m", "_n", names.alias("_json")).collect() if n > 0 else []
    own = F.array_compact(F.array(*[F.when(_differs(i), F.lit(i)) for i in range(len(plan.compared))]))
    cells = _single_pairs(source, other, found, plan).select(*kcols, F.explode(own).alias("_ci"), F.lit(1).cast("bigint").alias("_mis"))
    matches = _found_matches(source, other, multi, found, plan, hot_key_rows, max_hot_keys)
    if matches is not None:
        cells = cells.unionByName(matches.select(*kcols, "_ci", (-F.col("_eq")).alias("_mis")))

    def is_key(row) -> Column:
        cond = F.lit(True)
        for c in kcols:
            cond = cond & (F.col(c) == F.lit(row[c]))
        return cond

    sums = [F.sum(F.when(is_key(r), F.col("_mis"))).alias(f"_f{j}") for j, r in enumerate(firsts)]
    got = {r["_ci"]: r for r in cells.groupBy("_ci").agg(F.sum("_mis").alias("_mis"), *sums).collect()}
    totals, samples = {}, []
    for i, p in enumerate(plan.compared):
        totals[p.name] = t["multi_pairs"] + int((got[i]["_mis"] if i in got else 0) or 0)
    for j, r in enumerate(firsts):
        pairs = 0 if r["_m"] == r["_n"] == 1 else r["_m"] * r["_n"]
        for i in sorted(range(len(plan.compared)), key=lambda i: plan.compared[i].name):
            wrong = pairs + int((got[i][f"_f{j}"] if i in got else 0) or 0)
            if wrong:
                samples.append(f'{r["_json"][:-1]},"column_name":{json.dumps(plan.compared[i].name, ensure_ascii=False)},"mismatches":{wrong}}}')
    return totals, samples[:n]


def _found_matches(source: DataFrame, other: DataFrame, multi: DataFrame, found: layerkeys.KeyFindings, plan: ConsistencyPlan, hot_key_rows: int, max_hot_keys: int) -> DataFrame | None:
    """``_multi_matches`` with what the totals say: without keys that have several rows there is none, without a hot one nothing is spread."""
    t = found.totals
    any_hot = t["multi_most"] > max(hot_key_rows, t["multi_rows"] / max_hot_keys)
    by_key = not any_hot and found.small(single=False)
    return _multi_matches(source, other, multi, plan, (hot_key_rows, max_hot_keys) if any_hot else None, by_key=by_key) if t["multi"] else None


def _digest_summary(singles: DataFrame, matches: DataFrame | None, totals: dict[str, int], plan: ConsistencyPlan) -> DataFrame:
    n = len(plan.compared)
    # of a multi key that differs every pair counts as a mismatch here, minus the equal pairs below
    counted = singles.agg(*[F.count_if(_differs(i)).alias(f"_d{i}") for i in range(n)])
    pairs, multi = (F.lit(totals[t]).cast("bigint") for t in ("pairs", "multi_pairs"))
    cells = [F.struct(F.lit(i).alias("_ci"), (F.col(f"_d{i}") + multi).alias("_mis"), pairs.alias("_pairs")) for i in range(n)]
    return _columns(counted.select(F.inline(F.array(*cells))), matches, plan)


def _summary(per_key: DataFrame, matches: DataFrame, plan: ConsistencyPlan) -> DataFrame:
    n = len(plan.compared)
    pairs = F.col("_m") * F.col("_n")
    # of a multi key every pair counts as a mismatch here, minus the equal pairs below
    totals = per_key.agg(
        F.coalesce(F.sum(pairs), F.lit(0)).alias("_pairs"),
        F.coalesce(F.sum(F.when(F.expr(_SINGLE), 0).otherwise(pairs)), F.lit(0)).alias("_multi"),
        *[F.count_if(F.expr(_SINGLE) & _differs(i)).alias(f"_d{i}") for i in range(n)],
    )
    cells = [F.struct(F.lit(i).alias("_ci"), (F.col(f"_d{i}") + F.col("_multi")).alias("_mis"), F.col("_pairs").alias("_pairs")) for i in range(n)]
    return _columns(totals.select(F.inline(F.array(*cells))), matches, plan)


def _columns(counted: DataFrame, matches: DataFrame | None, plan: ConsistencyPlan) -> DataFrame:
    """A row per compared column from (``_ci``, ``_mis``, ``_pairs``), minus the equal pairs of multi keys."""
    labels = F.array(*[F.lit(p.name) for p in plan.compared])
    if matches is not None:
        equal = matches.select("_ci", (-F.col("_eq")).alias("_mis"), F.lit(0).cast("bigint").alias("_pairs"))
        counted = counted.unionByName(equal).groupBy("_ci").agg(F.sum("_mis").alias("_mis"), F.sum("_pairs").alias("_pairs"))
    return counted.select(
        F.element_at(labels, F.col("_ci") + 1).alias("column_name"), F.col("_mis").cast("bigint").alias("mismatches"), F.col("_pairs").cast("bigint").alias("pairs")
    )


def _keyed(singles: DataFrame, multi: DataFrame, matches: DataFrame | None, plan: ConsistencyPlan) -> DataFrame:
    kcols = [_KEY.format(i) for i in range(len(plan.key))]
    n = len(plan.compared)
    flags = F.array(*[F.when(_differs(i), F.lit(i)) for i in range(n)])
    found = singles.select(*kcols, F.explode(F.array_compact(flags)).alias("_ci")).withColumn("mismatches", F.lit(1).cast("bigint"))
    labels = F.array(*[F.lit(p.name) for p in plan.compared])
    if matches is not None:
        multi = multi.select(*kcols, (F.col("_m") * F.col("_n")).alias("_p"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_ci"))
        equal = matches.groupBy(*kcols, "_ci").agg(F.sum("_eq").alias("_equal"))
        left = (F.col("_p") - F.coalesce(F.col("_equal"), F.lit(0))).cast("bigint")
        found = found.unionByName(multi.join(equal, kcols + ["_ci"], "left").select(*kcols, "_ci", left.alias("mismatches")).where("mismatches > 0"))
    return found.select(
        *[F.col(c).alias(k) for c, k in zip(kcols, plan.key)],
        F.element_at(labels, F.col("_ci") + 1).alias("column_name"),
        "mismatches",
    )


def consistency_summary(
    source: DataFrame,
    other: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    exact: bool = False,
) -> DataFrame:
    """One row per compared column: ``column_name``, ``mismatches``, ``pairs``.

    ``pairs`` is the number of joined pairs (equal for every row).
    """
    if not plan_consistency(source, other, key, columns).compared:
        return source.sparkSession.createDataFrame([], _SUMMARY)
    return consistency_parts(source, other, key, columns, hot_key_rows, max_hot_keys, exact)[0]


def inconsistent_keys(
    source: DataFrame,
    other: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    hot_key_rows: int = HOT_KEY_MIN_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    exact: bool = False,
) -> DataFrame:
    """Row-level diagnostics: ``(*key, column_name, mismatches)`` for every key and column with unequal pairs."""
    return consistency_parts(source, other, key, columns, hot_key_rows, max_hot_keys, exact)[1]
