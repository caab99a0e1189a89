"""The tagged aggregate: digests against exact comparison, no exchange on bucketed layers, few reads, no key cache."""

import random

import pytest

from stagegate.operators import consistency as C
from stagegate.operators import layerkeys
from stagegate.plans.suites import run_stage
from stagegate.spec import DatasetSpec, Stage


def layer(rnd, n):
    values = [None, "", "a", "ab", "b"]
    return [(rnd.choice([None, 1, 1, 2, 3, 4, 5, 6]), rnd.choice(values), rnd.choice(values), rnd.choice([None, 0.0, -0.0, 1.5, float("nan")]), rnd.choice([None, True, False])) for _ in range(n)]


SCHEMA = "k int, a string, b string, f double, t boolean"


@pytest.mark.parametrize("seed,hot_rows", [(1, 100_000), (2, 100_000), (3, 2), (4, 100_000)])
def test_digest_equals_exact(spark, seed, hot_rows):
    rnd = random.Random(seed)
    left, right = (spark.createDataFrame(layer(rnd, rnd.randint(0, 25)), SCHEMA) for _ in range(2))
    rows = lambda df: sorted(map(tuple, df.collect()))
    args = dict(key=["k"], hot_key_rows=hot_rows)
    assert rows(C.consistency_summary(left, right, **args)) == rows(C.consistency_summary(left, right, **args, exact=True))
    keyed = rows(C.inconsistent_keys(left, right, **args))
    assert keyed == rows(C.inconsistent_keys(left, right, **args, exact=True))
    plan = C.plan_consistency(left, right, ["k"])
    totals, samples = C.summary_with_samples(left, right, C.find_differing(left, right, plan), plan, 4, hot_rows)
    assert totals == {r[0]: r[1] for r in rows(C.consistency_summary(left, right, **args))}
    assert samples == [f'{{"k":{k},"column_name":"{c}","mismatches":{n}}}' for k, c, n in keyed[:4]]


def test_null_and_neighbouring_values_have_own_digests(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", ""), (None, None), ("aa", ""), ("", "aa")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(*layerkeys.digests([df.a, df.b])).distinct().count() == len(rows)


def test_bucketed_layers_meet_without_exchange(spark):
    left, right = (spark.range(0, 4000).selectExpr("id AS k", f"id % {m} AS v") for m in (7, 5))
    names = {"layerkeys_left": left, "layerkeys_right": right}
    try:
        for name, df in names.items():
            df.write.bucketBy(4, "k").sortBy("k").mode("overwrite").saveAsTable(name)
        a, b = (spark.table(n) for n in names)
        plan = C.plan_consistency(a, b, ["k"])
        tagged = layerkeys.tagged(a, b, ["k"], [p.left for p in plan.compared], [p.right for p in plan.compared])
        assert "Exchange" not in tagged._jdf.queryExecution().executedPlan().toString()
        assert C.find_differing(a, b, plan, only_differing=False).totals == C.find_differing(left, right, C.plan_consistency(left, right, ["k"]), only_differing=False).totals
        assert sorted(map(tuple, C.consistency_summary(a, b, ["k"]).collect())) == sorted(map(tuple, C.consistency_summary(left, right, ["k"]).collect()))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_stage_without_cache_and_with_failing_aggregate(spark, monkeypatch):
    """Five checks stand on one aggregate; where it fails each falls back on a plan of its own, with the same result."""
    rnd = random.Random(9)
    left, right = (spark.createDataFrame(layer(rnd, 30), SCHEMA) for _ in range(2))
    spec = DatasetSpec(name="x", key=("k",), non_null=("k", "a"))
    calls = []
    find = layerkeys.find
    monkeypatch.setattr(layerkeys, "find", lambda *a, **b: calls.append(1) or find(*a, **b))
    shared = run_stage(spec, Stage.SOURCE_TO_STAGING, left, right)
    assert len(calls) == 1 and spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()

    def broken(*a, **b):
        raise RuntimeError("no aggregate")

    monkeypatch.setattr(layerkeys, "find", broken)
    monkeypatch.setattr(C, "find_differing", lambda *a, **b: broken())
    monkeypatch.setattr(C, "has_digest", lambda plan: False)
    alone = run_stage(spec, Stage.SOURCE_TO_STAGING, left, right)
    assert shared == alone


def test_rows_are_shuffled_once_for_all_uses(spark, monkeypatch, tmp_path):
    """One exchange of the tagged aggregate for totals and keys, one of each side's rows for single and multi keys."""
    spark.range(0, 3000).selectExpr("id % 2000 AS k", "id AS v", "id % 5 AS w").write.parquet(f"{tmp_path}/rows")
    left = spark.read.parquet(f"{tmp_path}/rows")
    right = left.where("k % 31 <> 4").selectExpr("k", "IF(v % 13 = 1, v + 1, v) AS v", "w")
    kept, checkpoint = [], type(left).checkpoint
    monkeypatch.setattr(type(left), "checkpoint", lambda df, *a, **b: (kept.append(df), checkpoint(df, *a, **b))[1])
    monkeypatch.setattr(layerkeys, "BROADCAST_BYTES", -1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summary = C.consistency_summary(left, right, ["k"])
        got = sorted(map(tuple, summary.collect()))
        kept[0].collect()
        final = [df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0] for df in (kept[0], summary)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "ReusedExchange" in final[0]
    assert final[1].count("ReusedExchange") == 2  # the rows of each side
    assert got == sorted(map(tuple, C.consistency_summary(left, right, ["k"], exact=True).collect()))
