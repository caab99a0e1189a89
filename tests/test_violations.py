"""Edge cases of the check operators: NULL keys, blanks, flags, type drift, odd column names."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from stagegate.operators import consistency as C
from stagegate.operators import violations as V
from stagegate.operators.schema import compare_schemas
from stagegate.spec import DatasetSpec, Rule, parse_expected_schema


def test_blank_is_trimmed_spaces_only(spark):
    df = spark.createDataFrame([("\t",), (" ",), ("\n",), ("",), (None,), ("x",)], "s string")
    r = V.null_or_blank_counts(df, ["s"]).first()
    assert r["null_count"] == 3  # ' ', '' and NULL; tab and newline are not blank


def test_null_counts_non_string_and_missing_column(spark):
    df = spark.createDataFrame([(1, None), (None, 2.0), (3, 4.0)], "a int, b double")
    got = {r["column_name"]: r["null_count"] for r in V.null_or_blank_counts(df, ["a", "b", "zz"]).collect()}
    assert got == {"a": 1, "b": 1, "zz": None}


def test_null_keys_group_as_duplicates(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    rows = V.duplicate_keys(df, ["k"]).collect()
    assert len(rows) == 1 and rows[0]["k"] is None and rows[0]["n_rows"] == 2


def test_composite_key_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "k1 int, k2 string")
    rows = V.duplicate_keys(df, ["k1", "k2"]).collect()
    assert [(r["k1"], r["k2"], r["n_rows"]) for r in rows] == [(1, "a", 2)]


def test_missing_keys_null_key_always_missing(spark):
    src = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    stg = spark.createDataFrame([(1,), (None,)], "k int")
    got = sorted((r["k"] is None, r["k"]) for r in V.missing_keys(src, stg, ["k"]).collect())
    assert got == [(False, 2), (True, None)]


def test_missing_keys_same_dataframe_both_sides(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    assert V.missing_keys(df, df, ["k"]).count() == 0


def test_column_names_with_spaces_and_dots(spark):
    df = spark.createDataFrame([(1, "x"), (1, " ")], "`my key` int, `a.b` string")
    assert V.duplicate_keys(df, ["my key"]).first()["n_rows"] == 2
    assert V.null_or_blank_counts(df, ["a.b"]).first()["null_count"] == 1


@pytest.mark.parametrize(
    "values,active",
    [
        (["Y", "y", " Y ", "N", None, "A"], 3),
        ([True, False, None], 1),
        ([1, 0, 2], 1),
        (["TRUE", "1", "false"], 2),
    ],
)
def test_active_flag_normalisation(spark, values, active):
    rows = [(1, v) for v in values]
    sample = next(v for v in values if v is not None)
    typ = {str: "string", bool: "boolean", int: "int"}[type(sample)]
    df = spark.createDataFrame(rows, f"k int, f {typ}")
    v = V.active_flag_violations(df, ["k"], "f").collect()
    got = v[0]["active_count"] if v else 1
    assert got == active


def test_history_counts_unknown_flags(spark):
    df = spark.createDataFrame([("N",), ("n",), ("FALSE",), ("0",), ("Y",), ("A",), (None,)], "f string")
    r = V.history_counts(df, "f").first()
    assert (r["inactive_count"], r["unknown_flag_count"]) == (4, 2)


def test_orphans_null_fk_is_orphan_and_counts_rows(spark):
    tgt = spark.createDataFrame([(1,), (4,), (4,), (None,)], "fk int")
    lk = spark.createDataFrame([(1,), (2,)], "id bigint")
    got = {r["fk"]: r["n_rows"] for r in V.orphan_values(tgt, "fk", lk, "id").collect()}
    assert got == {4: 2, None: 1}


def test_rules_null_and_nan_do_not_violate(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (float("nan"),), (2.0,)], "amount double")
    rules = [Rule("neg", "amount < 0", ("amount",)), Rule("skipped", "missing_col > 0", ("missing_col",))]
    got = {r["rule"]: r["violations"] for r in V.rule_violation_counts(df, rules).collect()}
    assert got == {"neg": 1}


def test_latest_batch_counts(spark):
    stg = spark.createDataFrame([(1, dt.date(2025, 1, 2)), (2, dt.date(2025, 1, 2)), (3, dt.date(2025, 1, 1))], "k int, batch_date date")
    tgt = spark.createDataFrame([(1, dt.date(2025, 1, 2)), (1, dt.date(2025, 1, 1))], "k int, batch_date date")
    r = V.latest_batch_counts(stg, tgt).first()
    assert (r["batch_value"], r["staging_count"], r["target_count"]) == (dt.date(2025, 1, 2), 2, 1)


def test_consistency_type_drift_and_map_columns(spark):
    src = spark.createDataFrame([(1, "1", {"a": 1}, 1.0), (2, "x", {"a": 1, "b": 2}, -0.0)], "k int, v string, m map<string,int>, d double")
    stg = spark.createDataFrame([(1, 1, {"a": 1}, 1), (2, 2, {"b": 2, "a": 1}, 0)], "k int, v int, m map<string,int>, d int")
    plan = C.plan_consistency(src, stg, ["k"])
    assert plan.drifted == ("v",)
    got = {r["column_name"]: r["mismatches"] for r in C.consistency_summary(src, stg, ["k"]).collect()}
    assert got == {"v": 1, "m": 0, "d": 0}


def test_consistency_skips_columns_missing_on_one_side(spark):
    src = spark.createDataFrame([(1, "a", "b")], "k int, x string, only_src string")
    stg = spark.createDataFrame([(1, "a")], "k int, x string")
    assert C.plan_consistency(src, stg, ["k"]).skipped == ("only_src",)
    assert [r["column_name"] for r in C.consistency_summary(src, stg, ["k"]).collect()] == ["x"]


def test_schema_compare_order_ignored_and_messages():
    actual = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.IntegerType(), False), T.StructField("z", T.StringType())])
    expected = parse_expected_schema([{"name": "a", "type": "IntegerType", "nullable": False}, {"name": "b", "type": "StringType"}, {"name": "c", "type": "date"}])
    issues = compare_schemas(actual, expected)
    assert [(i.field_name, i.issue) for i in issues] == [("b", "type"), ("c", "missing"), ("z", "extra")]
    assert not compare_schemas(actual, expected, check_nullable=False) == []


def test_spec_validation():
    with pytest.raises(ValueError):
        DatasetSpec(name="x", key=())
    with pytest.raises(ValueError):
        DatasetSpec(name="x", key=("k",), scd_type="type3")
    s = DatasetSpec(name="x", key="k", non_null=["a"])
    assert s.key == ("k",) and s.non_null_for(list(s.non_null)[0]) == ("a",)


def test_suite_isolates_errors_and_missing_flag(spark):
    from stagegate.plans.suites import run_suite
    from stagegate.spec import DatasetSpec, Rule

    stg = spark.createDataFrame([(1, 5.0), (2, -1.0)], "k int, amount double")
    tgt = spark.createDataFrame([(1, 5.0), (2, -1.0)], "k int, amount double")
    spec = DatasetSpec(
        name="t", key=("k",), scd_type="type2", active_flag="is_active",
        rules=(Rule("neg", "amount < 0", ("amount",)), Rule("broken", "no_such_function(amount) > 0", ("amount",))),
    )
    rows = {r["check"]: r for r in run_suite(spark, spec, "staging_to_target", staging=stg, target=tgt).collect()}
    assert rows["scd_type2_active_flag"]["status"] == "Fail" and "missing" in rows["scd_type2_active_flag"]["details"]
    assert rows["scd_type2_history"]["status"] == "Fail"
    assert rows["transformation_rules"]["status"] == "Error"
    assert rows["primary_key_val"]["status"] == "Success"
    assert rows["scd_type2_record_count"]["status"] == "Success"


def test_orphan_rows_with_hot_orphan_value_and_null_fk(spark):
    tgt = spark.range(0, 3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 999 WHEN id % 50 = 1 THEN NULL ELSE id % 10 END AS fk")
    lk = spark.range(0, 10).selectExpr("id AS cid")
    got = V.orphan_rows(tgt, "fk", lk, "cid")
    want = tgt.where("fk IS NULL OR fk NOT IN (0,1,2,3,4,5,6,7,8,9)")
    assert got.count() == want.count() == 1000 + 40
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_source_to_staging_shared_key_counts_match_standalone(spark):
    from stagegate.operators import consistency as C
    from stagegate.plans.suites import run_suite
    from stagegate.spec import DatasetSpec

    src = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (2, "d"), (3, "e"), (3, "f")], "k int, v string")
    stg = spark.createDataFrame([(1, "a"), (None, "b"), (None, "x"), (3, "e"), (3, "e"), (4, "z")], "k int, v string")
    spec = DatasetSpec(name="t", key=("k",), rules=())
    rows = {r["check"]: r for r in run_suite(spark, spec, "source_to_staging", source=src, staging=stg).collect()}
    assert rows["primary_key_val"]["violation_count"] == V.duplicate_keys(stg, ["k"]).count() == 2  # NULL and 3
    assert rows["data_completeness"]["violation_count"] == V.missing_keys(src, stg, ["k"]).count() == 2  # NULL and 2
    summary = {r["column_name"]: r["mismatches"] for r in C.consistency_summary(src, stg, ["k"]).collect()}
    assert rows["data_consistency"]["metrics"]["v"] == summary["v"] == 2  # key 3: (e,e)(e,e)(f,e)(f,e) → 2 differ


def test_shared_key_counts_composite_key_with_null_parts(spark):
    from stagegate.operators import consistency as C
    from stagegate.plans.suites import run_suite
    from stagegate.spec import DatasetSpec

    src = spark.createDataFrame(
        [(1, "a", 1), (1, None, 2), (1, None, 3), (2, "b", 4), (2, "b", 5), (3, "c", 6)], "k1 int, k2 string, v int"
    )
    stg = spark.createDataFrame([(1, "a", 1), (1, None, 2), (2, "b", 4), (2, "b", 9), (4, "d", 7)], "k1 int, k2 string, v int")
    spec = DatasetSpec(name="t", key=("k1", "k2"), rules=())
    rows = {r["check"]: r for r in run_suite(spark, spec, "source_to_staging", source=src, staging=stg).collect()}
    assert rows["count_val"]["metrics"] == {"source_count": 6, "target_count": 5}
    assert rows["primary_key_val"]["violation_count"] == V.duplicate_keys(stg, ["k1", "k2"]).count() == 1  # (2, b)
    assert rows["data_completeness"]["violation_count"] == V.missing_keys(src, stg, ["k1", "k2"]).count() == 2
    want = {r["column_name"]: r["mismatches"] for r in C.consistency_summary(src, stg, ["k1", "k2"]).collect()}
    assert rows["data_consistency"]["metrics"]["v"] == want["v"] == 3  # (2,b): 2x2 pairs, one equal


def test_summary_counts_errors_as_failed(spark):
    from stagegate.plans.checks import RESULT_SCHEMA
    from stagegate.plans.suites import summarize

    rows = [
        ("d", "source_to_staging", 1, "a", "Success", 0, {}, [], ""),
        ("d", "source_to_staging", 2, "b", "Error", None, {}, [], "boom"),
        ("d", "staging_to_target", 1, "c", "Fail", 3, {}, [], ""),
    ]
    out = {(r["dataset"], r["stage"]): (r["total"], r["passed"], r["failed"]) for r in summarize(spark.createDataFrame(rows, RESULT_SCHEMA)).collect()}
    assert out[("d", "source_to_staging")] == (2, 1, 1)
    assert out[(None, None)] == (3, 1, 2)
