"""Turn lazy violation DataFrames into one result per check.

Each check runs at most a couple of small actions: fused per-table aggregates
(``TableProfile``) for the counting checks, and for the set-valued checks one
action that returns the first ``n`` violations in key order *and* their total
(a scalar subquery over the same plan, so Spark reuses the shared exchange).
Only counts and at most ``n`` sample rows ever reach the driver.
"""

from __future__ import annotations

import json
import threading
import traceback
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import is_active as _is_active
from ..functions.predicates import is_inactive as _is_inactive
from ..functions.predicates import free_names, is_null_or_blank, qcol
from ..operators import consistency as C
from ..operators import layerkeys
from ..operators import violations as V
from ..operators.schema import compare_schemas
from ..spec import DatasetSpec, ScdType, Stage

# Result statuses ("Error" is ours: a check that raised).
SUCCESS, FAIL, ERROR = "Success", "Fail", "Error"

# The check names reported in results.
SCHEMA = "schemachk"
COUNT = "count_val"
NULLS = "null_val"
DUPLICATES = "primary_key_val"
COMPLETENESS = "data_completeness"
CONSISTENCY = "data_consistency"
LATEST_BATCH = "count_val_latest_batch"
SCD2_COUNT = "scd_type2_record_count"
ACTIVE_FLAG = "scd_type2_active_flag"
HISTORY = "scd_type2_history"
REFERENTIAL = "referential_integrity"
RULES = "transformation_rules"

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("stage", T.StringType(), False),
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("check", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("violation_count", T.LongType(), True),
        T.StructField("metrics", T.MapType(T.StringType(), T.LongType()), True),
        T.StructField("samples", T.ArrayType(T.StringType()), True),
        T.StructField("details", T.StringType(), True),
    ]
)


@dataclass
class CheckResult:
    check: str
    status: str
    violation_count: int | None = None
    metrics: dict[str, int] = field(default_factory=dict)
    samples: list[str] = field(default_factory=list)
    details: str = ""


class TableProfile:
    """Named aggregate expressions over one table, evaluated in a single scan.

    If the fused aggregate fails (e.g. one rule's predicate cannot be evaluated),
    each value is recomputed on its own so that only the checks needing the
    failing expression report ``Error``.
    """

    def __init__(self, df: DataFrame):
        self.df = df
        self.exprs: dict[str, Column] = {}
        self.by_key: KeyProfile | None = None  # an aggregate by key that runs anyway and carries the counts
        self._values: dict | None = None
        self._fused_error: BaseException | None = None
        self._lock = threading.Lock()

    def need(self, name: str, expr: Column) -> None:
        self.exprs[name] = expr

    def run(self) -> None:
        with self._lock:
            if self._values is not None:
                return
            if not self.exprs:
                self._values = {}
                return
            try:
                if self.by_key is not None:
                    self._values = self.by_key.counts(self.exprs)
                    return
            except Exception:  # the scan below tells which of them fails
                pass
            try:
                row = self.df.agg(*[e.alias(f"_p{i}") for i, e in enumerate(self.exprs.values())]).first()
                self._values = {n: row[f"_p{i}"] for i, n in enumerate(self.exprs)}
            except Exception as exc:  # fall back to one aggregate per value
                self._fused_error = exc
                self._values = {}

    def get(self, name: str):
        self.run()
        with self._lock:
            if name not in self._values:
                self._values[name] = self.df.agg(self.exprs[name].alias("_v")).first()["_v"]
            return self._values[name]


class KeyProfile:
    """Per-key aggregates of one table shared by several key-level checks.

    The table is grouped by the business key once; each registered check is a
    predicate over that per-key table.  One action returns, for every check,
    the number of keys breaking it and the first ``n`` of them in key order:
    the branches are scalar subqueries and ordered limits over the same grouped
    plan, so Spark reuses its exchange and the table is shuffled once.  ``carry`` adds counts of the whole
    table to that action, as sums of the keys' counts: exact also when a task runs twice, which
    metrics observed on the way would not be.
    """

    def __init__(self, df: DataFrame, key: Sequence[str], n: int):
        self.df, self.key, self.n = df, list(key), n
        self.aggs: dict[str, Column] = {}
        self.checks: dict[str, tuple[Column, list[str]]] = {}
        self.carried: dict[str, Column] = {}
        self._result: dict[str, tuple[int, list[str]]] | None = None
        self._counts: dict[str, int] = {}
        self._lock = threading.Lock()

    def carry(self, exprs: dict[str, Column]) -> None:
        self.carried = exprs

    def counts(self, exprs: dict[str, Column]) -> dict[str, int]:
        """Values of the carried counts; the action runs if it has not."""
        with self._lock:
            self._ensure()
            return {n: self._counts[n] for n in exprs}

    def _ensure(self) -> None:
        if self._result is not None:
            return
        try:
            self._result = self._run()
        except Exception:
            if not self.carried:
                raise
            self.carried = {}  # one of the counts may be what fails: the keys go without them
            self._result = self._run()

    def need(self, name: str, aggs: dict[str, Column], predicate: Column, sample_columns: Sequence[str]) -> None:
        self.aggs.update(aggs)
        self.checks[name] = (predicate, list(sample_columns))

    def _run(self) -> dict[str, tuple[int, list[str]]]:
        kp = self.df.groupBy(*[qcol(k).alias(k) for k in self.key]).agg(
            *[e.alias(n) for n, e in self.aggs.items()], *[e.alias(f"_x{i}") for i, e in enumerate(self.carried.values())]
        )
        names = list(self.checks)
        # a row with the totals, whatever the samples are, then the samples of each check
        sums = [F.coalesce(F.sum(f"_x{i}"), F.lit(0)).alias(f"_x{i}") for i in range(len(self.carried))]
        totals = kp.agg(*[F.count_if(self.checks[c][0]).alias(f"_t{i}") for i, c in enumerate(names)], *sums)
        branches = totals.select(F.lit(-1).alias("_q"), F.to_json(F.struct(*totals.columns)).alias("_s"))
        for i, c in enumerate(names):
            pred, cols = self.checks[c]
            branches = branches.unionByName(
                kp.where(pred)
                .orderBy(*[qcol(k) for k in self.key])
                .limit(self.n)
                .select(F.lit(i).alias("_q"), _json(self.key + cols).alias("_s"))
            )
        rows = branches.collect()
        count = json.loads(next(r["_s"] for r in rows if r["_q"] == -1))
        self._counts = {n: int(count[f"_x{i}"]) for i, n in enumerate(self.carried)}
        return {c: (int(count[f"_t{i}"]), [r["_s"] for r in rows if r["_q"] == i]) for i, c in enumerate(names)}

    def get(self, name: str) -> tuple[int, list[str]]:
        with self._lock:
            self._ensure()
            return self._result[name]


class StageKeys:
    """What one tagged aggregate over both layers of a stage finds (``layerkeys``): the row counts, NULL counts,
    duplicate keys, missing keys and differing keys that the source→staging checks report.

    It runs when a check first needs it, once; if it fails, the checks fall back on their own plans, so that
    only those that really cannot be evaluated report ``Error``.
    """

    def __init__(self, ctx: StageContext, compare: bool, null_columns: Sequence[str]):
        self.left, self.right, self.key = ctx.left, ctx.right, list(ctx.spec.key)
        types = {f.name: f.dataType for f in self.right.schema.fields}
        self.counters = {c: is_null_or_blank(qcol(c), types[c]) for c in null_columns if c in types}
        if ctx.spec.unparsable_column in types:
            self.counters[_UNPARSABLE] = qcol(ctx.spec.unparsable_column).isNotNull()
        self.plan = C.plan_consistency(self.left, self.right, self.key, compared_columns(ctx)) if compare else None
        self._found: layerkeys.KeyFindings | None = None
        self._failed = False
        self._lock = threading.Lock()

    @staticmethod
    def usable(left: DataFrame, right: DataFrame, key: Sequence[str]) -> bool:
        """Keys of both layers are there and equal as they are (no cast between number and text)."""
        if not all(k in left.columns and k in right.columns for k in key):
            return False
        kinds = [(left.schema[k].dataType, right.schema[k].dataType) for k in key]
        return all(a == b or (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)) for a, b in kinds)

    @property
    def compares(self) -> bool:
        return self.plan is not None and C.has_digest(self.plan)

    def found(self) -> layerkeys.KeyFindings | None:
        """The findings, or None where the aggregate failed."""
        with self._lock:
            if self._found is None and not self._failed:
                try:
                    if self.compares:
                        self._found = C.find_differing(self.left, self.right, self.plan, self.counters, only_differing=False)
                    else:
                        self._found = layerkeys.find(self.left, self.right, self.key, counters=self.counters)
                except Exception:
                    self._failed = True
            return self._found


def _found(ctx: StageContext) -> layerkeys.KeyFindings | None:
    return ctx.stage_keys.found() if ctx.stage_keys is not None else None


@dataclass
class StageContext:
    spec: DatasetSpec
    stage: Stage
    left: DataFrame  # source (S->S) or staging (S->T)
    right: DataFrame  # staging (S->S) or target (S->T)
    left_profile: TableProfile
    right_profile: TableProfile
    key_profile: KeyProfile | None = None
    stage_keys: StageKeys | None = None


def _json(columns: Sequence[str]) -> Column:
    """A row's columns as JSON text, NULLs included."""
    return F.to_json(F.struct(*[qcol(c) for c in columns]), {"ignoreNullFields": "false"})


def sampled(viol: DataFrame, order: Sequence[str], n: int, total: Column | None = None) -> tuple[int, list[str]]:
    """(total, first ``n`` violations in ``order`` as JSON) in one action; the total does not depend on ``n``."""
    total_expr = F.coalesce((total if total is not None else F.count(F.lit(1))).cast("bigint"), F.lit(0).cast("bigint"))
    totals = viol.agg(total_expr.alias("_total")).select(F.lit(None).cast("string").alias("_s"), "_total")
    firsts = viol.orderBy(*[qcol(c) for c in order]).limit(n).select(_json(viol.columns).alias("_s"), F.lit(None).cast("bigint").alias("_total"))
    rows = totals.unionByName(firsts).collect()
    return next(int(r["_total"]) for r in rows if r["_total"] is not None), [r["_s"] for r in rows if r["_total"] is None]


def _firsts(viol: DataFrame, order: Sequence[str], n: int, total: int) -> list[str]:
    """The first ``n`` violations in ``order`` as JSON; no job where there is none."""
    if not total or n < 1:
        return []
    return [r["_s"] for r in viol.orderBy(*[qcol(c) for c in order]).limit(n).select(_json(viol.columns).alias("_s")).collect()]


def _status(ok: bool) -> str:
    return SUCCESS if ok else FAIL


# name of the count of rows that do not parse
_UNPARSABLE = "_unparsable"


def compared_columns(ctx: StageContext) -> list[str] | None:
    """The columns that consistency compares: all, but for the text of rows that do not parse."""
    c = ctx.spec.unparsable_column
    return [x for x in ctx.left.columns if x != c] if c in ctx.left.columns else None


# ---------------------------------------------------------------- checks


def check_schema(ctx: StageContext) -> CheckResult:
    """Issues of the schema; for a layer read as declared also the rows that do not parse."""
    expected = ctx.spec.expected_schema_for(ctx.stage)
    if expected is None:
        return CheckResult(SCHEMA, SUCCESS, 0, details="no expected schema declared")
    own = T.StructType([f for f in ctx.right.schema.fields if f.name != ctx.spec.unparsable_column])
    issues = compare_schemas(own, expected, ctx.spec.check_nullable)
    msgs = [i.message() for i in issues]
    metrics, bad = {"issues": len(issues)}, 0
    if ctx.spec.unparsable_column in ctx.right.columns:
        found = _found(ctx)
        bad = int(found.totals[f"counter:{_UNPARSABLE}"] if found is not None else ctx.right_profile.get(_UNPARSABLE))
        metrics["unparsable_rows"] = bad
        msgs += [f"{bad} row(s) do not parse as declared"] if bad else []
    return CheckResult(
        SCHEMA,
        _status(not msgs),
        len(issues) + bad,
        metrics,
        msgs[: ctx.spec.sample_size],
        "; ".join(msgs) if msgs else "schema is valid",
    )


def check_count(ctx: StageContext) -> CheckResult:
    found = _found(ctx)
    if found is not None:
        s, t = found.totals["left_rows"], found.totals["right_rows"]
    elif ctx.stage_keys is not None:
        s, t = V.row_counts(ctx.left, ctx.right).first()
    else:
        s, t = ctx.left_profile.get("_count"), ctx.right_profile.get("_count")
    return CheckResult(
        COUNT, _status(s == t), abs(s - t), {"source_count": s, "target_count": t}, details=f"source={s}, target={t}"
    )


def check_nulls(ctx: StageContext) -> CheckResult:
    cols = ctx.spec.non_null_for(ctx.stage)
    present = set(ctx.right.columns)
    missing = [c for c in cols if c not in present]
    found = _found(ctx)
    if found is not None:
        counts = {c: found.totals[f"counter:{c}"] for c in cols if c in present}
    elif ctx.stage_keys is not None:
        counts = {r["column_name"]: r["null_count"] for r in V.null_or_blank_counts(ctx.right, [c for c in cols if c in present]).collect()}
    else:
        counts = {c: int(ctx.right_profile.get(f"_null:{c}")) for c in cols if c in present}
    bad = {c: n for c, n in counts.items() if n > 0}
    parts = [f"{c}: {n}" for c, n in bad.items()] + [f"{c}: missing column" for c in missing]
    return CheckResult(
        NULLS,
        _status(not bad and not missing),
        sum(counts.values()) + len(missing),
        counts,
        details="nulls or blanks in " + ", ".join(parts) if parts else "no NULL or blank values in the non-null columns",
    )


def check_duplicates(ctx: StageContext) -> CheckResult:
    key = list(ctx.spec.key)
    if ctx.key_profile is not None and "duplicates" in ctx.key_profile.checks:
        total, samples = ctx.key_profile.get("duplicates")
    elif (found := _found(ctx)) is not None:
        total = found.totals["duplicates"]
        samples = _firsts(found.duplicates(), key, ctx.spec.sample_size, total)
    else:
        total, samples = sampled(V.duplicate_keys(ctx.right, key), key, ctx.spec.sample_size)
    return CheckResult(
        DUPLICATES,
        _status(total == 0),
        total,
        {"duplicate_keys": total},
        samples,
        "no duplicate keys" if total == 0 else f"{total} key(s) occur more than once",
    )


def check_completeness(ctx: StageContext) -> CheckResult:
    key = list(ctx.spec.key)
    if (found := _found(ctx)) is not None:
        total = found.totals["missing"]
        samples = _firsts(found.missing(), key, ctx.spec.sample_size, total)
    else:
        total, samples = sampled(V.missing_keys(ctx.left, ctx.right, key), key, ctx.spec.sample_size)
    return CheckResult(
        COMPLETENESS,
        _status(total == 0),
        total,
        {"missing_keys": total},
        samples,
        "all source keys present" if total == 0 else f"{total} source key(s) missing",
    )


def check_consistency(ctx: StageContext) -> CheckResult:
    """Per-column mismatch totals, the pair count and the first mismatching keys, in one action.

    Where the stage's tagged aggregate has found no key whose rows differ, there is nothing to read.
    """
    key = list(ctx.spec.key)
    plan = C.plan_consistency(ctx.left, ctx.right, key, compared_columns(ctx))
    names = [p.name for p in plan.compared]
    per_col = {c: 0 for c in names}
    pairs = 0
    samples: list[str] = []
    found = _found(ctx) if ctx.stage_keys is not None and ctx.stage_keys.compares else None
    hot = {"hot_key_rows": ctx.spec.hot_key_rows, "max_hot_keys": ctx.spec.max_hot_keys}
    if found is not None:
        pairs = found.totals["pairs"]
        if found.totals["single"] + found.totals["multi"]:
            per_col, samples = C.summary_with_samples(ctx.left, ctx.right, found, plan, ctx.spec.sample_size, **hot)
    elif names:
        totals, keyed = C.consistency_parts(ctx.left, ctx.right, key, compared_columns(ctx), **hot)
        none = F.lit(None)
        firsts = keyed.orderBy(*[qcol(k) for k in key], "column_name").limit(ctx.spec.sample_size)
        firsts = firsts.select(none.cast("string").alias("column_name"), none.cast("bigint").alias("mismatches"), none.cast("bigint").alias("pairs"), _json(keyed.columns).alias("_s"))
        for r in totals.withColumn("_s", none.cast("string")).unionByName(firsts).collect():
            if r["_s"] is None:
                per_col[r["column_name"]], pairs = int(r["mismatches"]), int(r["pairs"])
            else:
                samples.append(r["_s"])
    total = sum(per_col.values())
    notes = [f"{c}: {n} mismatches" for c, n in per_col.items() if n]
    if plan.skipped:
        notes.append("not in both layers: " + ", ".join(plan.skipped))
    if plan.drifted:
        notes.append("compared as text (type drift): " + ", ".join(plan.drifted))
    return CheckResult(
        CONSISTENCY,
        _status(total == 0),
        total,
        {**per_col, "_pairs": pairs},
        samples,
        "; ".join(notes) if notes else "values consistent",
    )


def check_latest_batch(ctx: StageContext) -> CheckResult:
    b = ctx.spec.batch_column
    if b not in ctx.left.columns or b not in ctx.right.columns:
        return CheckResult(LATEST_BATCH, FAIL, None, details=f"{b} column missing in staging or target")
    row = V.latest_batch_counts(ctx.left, ctx.right, b).first()
    if row["batch_value"] is None:
        return CheckResult(LATEST_BATCH, FAIL, None, details=f"no {b} value in staging")
    s, t = int(row["staging_count"]), int(row["target_count"])
    return CheckResult(
        LATEST_BATCH,
        _status(s == t),
        abs(s - t),
        {"staging_count": s, "target_count": t},
        details=f"batch {row['batch_value']}: staging={s}, target={t}",
    )


def check_scd2_count(ctx: StageContext) -> CheckResult:
    s, t = ctx.left_profile.get("_count"), ctx.right_profile.get("_count")
    return CheckResult(
        SCD2_COUNT,
        _status(t >= s),
        max(s - t, 0),
        {"staging_count": s, "target_count": t},
        details=f"target={t} {'>=' if t >= s else '<'} staging={s}",
    )


def check_active_flag(ctx: StageContext) -> CheckResult:
    spec = ctx.spec
    if not spec.active_flag:
        return CheckResult(ACTIVE_FLAG, FAIL, None, details="no active flag column configured")
    if spec.active_flag not in ctx.right.columns:
        return CheckResult(ACTIVE_FLAG, FAIL, None, details=f"active flag column {spec.active_flag} missing in target")
    key = list(spec.key)
    if ctx.key_profile is not None and "active_flag" in ctx.key_profile.checks:
        total, samples = ctx.key_profile.get("active_flag")
    else:
        viol = V.active_flag_violations(ctx.right, key, spec.active_flag, spec.active_values)
        total, samples = sampled(viol, key, spec.sample_size)
    return CheckResult(
        ACTIVE_FLAG,
        _status(total == 0),
        total,
        {"invalid_keys": total},
        samples,
        "each key has exactly one active version" if total == 0 else f"{total} key(s) without exactly one active version",
    )


def check_history(ctx: StageContext) -> CheckResult:
    spec = ctx.spec
    if not spec.active_flag:
        return CheckResult(HISTORY, SUCCESS, 0, details="no active flag column configured")
    if spec.active_flag not in ctx.right.columns:
        return CheckResult(HISTORY, FAIL, None, details=f"active flag column {spec.active_flag} missing in target")
    inactive = int(ctx.right_profile.get("_inactive"))
    unknown = int(ctx.right_profile.get("_unknown_flag"))
    return CheckResult(
        HISTORY,
        SUCCESS,
        0,
        {"inactive_count": inactive, "unknown_flag_count": unknown},
        details=f"{inactive} closed version(s) kept; {unknown} row(s) with an unrecognised flag",
    )


def check_referential(ctx: StageContext) -> CheckResult:
    lk = ctx.spec.lookup
    if lk is None:
        return CheckResult(REFERENTIAL, SUCCESS, 0, details="no lookup configured")
    if lk.table is None:
        return CheckResult(REFERENTIAL, FAIL, None, details=f"lookup table '{lk.name}' not loaded" + (f": {lk.error}" if lk.error else ""))
    if lk.target_column not in ctx.right.columns:
        return CheckResult(REFERENTIAL, FAIL, None, details=f"column {lk.target_column} missing in target")
    viol = V.orphan_values(ctx.right, lk.target_column, lk.table, lk.lookup_column)
    total, samples = sampled(viol, [lk.target_column], ctx.spec.sample_size, total=F.sum("n_rows"))
    return CheckResult(
        REFERENTIAL,
        _status(total == 0),
        total,
        {"orphan_rows": total},
        samples,
        f"all {lk.target_column} values found in the lookup" if total == 0 else f"{total} row(s) with an unknown {lk.target_column}",
    )


def check_rules(ctx: StageContext) -> CheckResult:
    rules = [r for r in ctx.spec.rules if r.applies_to(ctx.right)]
    counts = {r.name: int(ctx.right_profile.get(f"_rule:{r.name}")) for r in rules}
    bad = {n: c for n, c in counts.items() if c}
    return CheckResult(
        RULES,
        _status(not bad),
        sum(counts.values()),
        counts,
        details=("; ".join(f"{n}: {c} row(s)" for n, c in bad.items()) if bad else "all business rules hold"),
    )


# ---------------------------------------------------------------- stage plans

SOURCE_TO_STAGING = (check_schema, check_count, check_nulls, check_duplicates, check_completeness, check_consistency)


def stage_checks(spec: DatasetSpec, stage: Stage):
    if stage is Stage.SOURCE_TO_STAGING:
        return list(SOURCE_TO_STAGING)
    checks = [check_schema]
    checks.append(check_latest_batch if spec.scd_type is ScdType.TYPE1 else check_scd2_count)
    checks += [check_nulls, check_duplicates]
    if spec.scd_type is ScdType.TYPE2:
        checks += [check_active_flag, check_history]
    if spec.lookup is not None:
        checks.append(check_referential)
    checks.append(check_rules)
    return checks


def plan_profiles(ctx: StageContext, checks) -> None:
    """Register the aggregate values the chosen checks read, so each table is scanned once."""
    spec, right = ctx.spec, ctx.right
    # source→staging: counts, NULLs, duplicates, completeness and consistency come out of one aggregate by key
    shared = [c for c in (check_duplicates, check_completeness, check_consistency) if c in checks]
    if ctx.stage is Stage.SOURCE_TO_STAGING and len(shared) > 1 and StageKeys.usable(ctx.left, right, spec.key):
        ctx.stage_keys = StageKeys(ctx, check_consistency in checks, spec.non_null_for(ctx.stage) if check_nulls in checks else ())
    if check_scd2_count in checks or (check_count in checks and ctx.stage_keys is None):
        ctx.left_profile.need("_count", F.count(F.lit(1)))
        ctx.right_profile.need("_count", F.count(F.lit(1)))
    if check_nulls in checks and ctx.stage_keys is None:
        for c, e in V.null_or_blank_exprs(right, spec.non_null_for(ctx.stage)).items():
            ctx.right_profile.need(f"_null:{c}", e)
    if check_schema in checks and spec.unparsable_column in right.columns:
        ctx.right_profile.need(_UNPARSABLE, F.count_if(qcol(spec.unparsable_column).isNotNull()))
    if check_history in checks and spec.active_flag and spec.active_flag in right.columns:
        f = qcol(spec.active_flag)
        ctx.right_profile.need("_inactive", F.count_if(_is_inactive(f, spec.inactive_values)))
        ctx.right_profile.need(
            "_unknown_flag", F.count_if(~_is_inactive(f, spec.inactive_values) & ~_is_active(f, spec.active_values))
        )
    if check_rules in checks:
        for name, e in V.rule_exprs(right, spec.rules).items():
            ctx.right_profile.need(f"_rule:{name}", e)
    # duplicate keys and active-flag counts both group the target by key: share that shuffle, and let it
    # carry the target's counts (rows, NULLs, flags, rules), so that no job counts them on its own
    if ctx.stage_keys is None and check_duplicates in checks and all(k in right.columns for k in spec.key):
        n_rows, active = free_names(spec.key, "n_rows", "active_count")
        kp = KeyProfile(right, spec.key, spec.sample_size)
        kp.need("duplicates", {n_rows: F.count(F.lit(1))}, F.col(n_rows) > 1, [n_rows])
        if check_active_flag in checks and spec.active_flag and spec.active_flag in right.columns:
            kp.need("active_flag", {active: F.count_if(_is_active(qcol(spec.active_flag), spec.active_values))}, F.col(active) != 1, [active])
        if ctx.right_profile.by_key is None:
            kp.carry(ctx.right_profile.exprs)
            ctx.right_profile.by_key = kp
        ctx.key_profile = kp


def run_check(fn, ctx: StageContext) -> CheckResult:
    """Run one check; an exception becomes an ``Error`` result instead of aborting the suite."""
    name = fn.__name__
    try:
        return fn(ctx)
    except Exception as exc:
        label = _CHECK_NAMES.get(name, name)
        return CheckResult(label, ERROR, None, details="".join(traceback.format_exception_only(exc)).strip())


# check function → reported name (for the Error row of a check that raised)
_CHECK_NAMES = {
    "check_schema": SCHEMA,
    "check_count": COUNT,
    "check_nulls": NULLS,
    "check_duplicates": DUPLICATES,
    "check_completeness": COMPLETENESS,
    "check_consistency": CONSISTENCY,
    "check_latest_batch": LATEST_BATCH,
    "check_scd2_count": SCD2_COUNT,
    "check_active_flag": ACTIVE_FLAG,
    "check_history": HISTORY,
    "check_referential": REFERENTIAL,
    "check_rules": RULES,
}
