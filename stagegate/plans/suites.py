"""Check suites per stage (source→staging, staging→target type 1 / type 2) and their summary.

``run_suite`` evaluates the checks of each requested stage and returns one
DataFrame of result rows (``RESULT_SCHEMA``): a few counts and at most
``sample_size`` sample rows per check reach the driver, never the data.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import DatasetSpec, Mode, Stage, parse_mode
from .checks import RESULT_SCHEMA, SUCCESS, CheckResult, StageContext, TableProfile, plan_profiles, run_check, stage_checks


def _contexts(spec: DatasetSpec, stages, layers) -> list[tuple[StageContext, list]]:
    """Plan every stage before running any: a layer used by two stages (staging in
    ``both``) gets one profile, so all its aggregates come from a single scan."""
    profiles: dict[int, TableProfile] = {}

    def profile(df: DataFrame) -> TableProfile:
        return profiles.setdefault(id(df), TableProfile(df))

    out = []
    for stage in stages:
        left, right = layers[stage]
        ctx = StageContext(spec, stage, left, right, profile(left), profile(right))
        checks = stage_checks(spec, stage)
        plan_profiles(ctx, checks)
        out.append((ctx, checks))
    return out


def _run_all(planned: list[tuple[StageContext, list]], parallelism: int) -> list[list[CheckResult]]:
    """Run every check of every planned stage; results keep the stage's check order.

    Checks are independent Spark jobs, so up to ``parallelism`` of them are
    submitted at once from driver threads and Spark schedules their tasks side
    by side.  Shared per-table aggregates are computed once (the first check
    that needs one runs it, the others wait for its value).
    """
    if parallelism <= 1:
        return [[run_check(fn, ctx) for fn in checks] for ctx, checks in planned]
    with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="stagegate-check") as pool:
        # a stage's aggregate by key goes first, and the checks that wait for it last
        for ctx, _ in planned:
            if ctx.stage_keys is not None:
                pool.submit(ctx.stage_keys.found)
        futures: list[list] = [[] for _ in planned]
        for i, (ctx, checks) in sorted(enumerate(planned), key=lambda p: p[1][0].stage_keys is not None):
            futures[i] = [pool.submit(run_check, fn, ctx) for fn in checks]
        return [[f.result() for f in fs] for fs in futures]


def run_stage(
    spec: DatasetSpec, stage: Stage, left: DataFrame, right: DataFrame, parallelism: int = 4
) -> list[CheckResult]:
    """All checks of one stage, in the fixed order of that stage."""
    return _run_all(_contexts(spec, [stage], {stage: (left, right)}), parallelism)[0]


def run_suite(
    spark: SparkSession,
    spec: DatasetSpec,
    mode: str | Mode = Mode.BOTH,
    source: DataFrame | None = None,
    staging: DataFrame | None = None,
    target: DataFrame | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Run the stages of ``mode`` and return their result rows.

    source→staging compares ``source`` with ``staging``; staging→target compares
    ``staging`` with ``target``.  Missing layers for a requested stage raise
    ``ValueError`` before any job runs.  The checks of all stages share one pool
    of ``parallelism`` driver threads.
    """
    mode = parse_mode(mode)
    layers = {}
    for stage in mode.stages:
        left, right = (source, staging) if stage is Stage.SOURCE_TO_STAGING else (staging, target)
        if left is None or right is None:
            raise ValueError(f"stage {stage.value} needs both layers; got {'left' if left is None else 'right'} missing")
        layers[stage] = (left, right)
    planned = _contexts(spec, mode.stages, layers)
    rows = []
    for (ctx, _), results in zip(planned, _run_all(planned, parallelism)):
        for seq, r in enumerate(results, start=1):
            rows.append((spec.name, ctx.stage.value, seq, r.check, r.status, r.violation_count, r.metrics, r.samples, r.details))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def summarize(results: DataFrame) -> DataFrame:
    """Totals per dataset and stage, per dataset, and overall (``rollup``); ``Error`` counts as failed."""
    agg = results.rollup("dataset", "stage").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("passed"),
    )
    return agg.select("dataset", "stage", "total", "passed", (F.col("total") - F.col("passed")).alias("failed"))
