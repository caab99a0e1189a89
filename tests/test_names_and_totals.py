"""Odd column names, totals that do not depend on the sample size, exact comparison, lookups and stream restarts."""

import datetime as dt
from decimal import Decimal

import pytest

from stagegate.operators import consistency as C
from stagegate.operators import violations as V
from stagegate.plans.suites import run_suite
from stagegate.sources.config import validate_dataset
from stagegate.spec import DatasetSpec, Lookup
from stagegate.streaming.loads import check_each_load


@pytest.mark.parametrize("key", ["a.b", "a b", "a`b"])
def test_quoted_key_names(spark, key):
    src = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "w")], "k int, v string").withColumnRenamed("k", key)
    stg = spark.createDataFrame([(1, "q"), (2, "y")], "k int, v string").withColumnRenamed("k", key)
    assert V.missing_keys(src, stg, [key]).collect()[0][0] is None
    assert [(r["column_name"], r["mismatches"], r["pairs"]) for r in C.consistency_summary(src, stg, [key]).collect()] == [("v", 2, 3)]
    assert V.duplicate_keys(src, [key]).count() == 1


def test_internal_names_as_columns(spark):
    names = ["_m", "_n", "_k0", "_salt", "_hot", "_v", "_left"]
    df = spark.createDataFrame([(1, *range(7)), (1, *range(7)), (2, *range(7))], "k int, " + ", ".join(f"{n} int" for n in names))
    assert {r["mismatches"] for r in C.consistency_summary(df, df, ["k"]).collect()} == {0}
    assert V.orphan_rows(df, "k", spark.createDataFrame([(2,)], "id int"), "id").count() == 2
    dup = V.duplicate_keys(df.withColumnRenamed("k", "n_rows"), ["n_rows"]).collect()
    assert [tuple(r) for r in dup] == [(1, 2)]


@pytest.mark.parametrize("n", [0, 1, 10])
def test_totals_do_not_depend_on_the_sample_size(spark, n):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, v string")
    stg = spark.createDataFrame([(1, "a"), (1, "a"), (2, "x")], "k int, v string")
    spec = DatasetSpec(name="t", key=("k",), rules=(), sample_size=n)
    rows = {r["check"]: r for r in run_suite(spark, spec, "source_to_staging", source=src, staging=stg).collect()}
    got = {c: (rows[c]["status"], rows[c]["violation_count"], len(rows[c]["samples"])) for c in ("primary_key_val", "data_completeness", "data_consistency")}
    assert got == {"primary_key_val": ("Fail", 1, min(n, 1)), "data_completeness": ("Fail", 2, min(n, 2)), "data_consistency": ("Fail", 1, min(n, 1))}
    if n:
        assert rows["data_completeness"]["samples"][0] == '{"k":null}'
    tgt = spark.createDataFrame([(1, "Y", 9), (1, "Y", 1), (2, "N", None)], "k int, is_active string, fk int")
    lookup = Lookup(spark.createDataFrame([(1,)], "id int"), "id", "fk")
    spec = DatasetSpec(name="t", key=("k",), scd_type="type2", rules=(), active_flag="is_active", lookup=lookup, sample_size=n)
    rows = {r["check"]: r for r in run_suite(spark, spec, "staging_to_target", staging=tgt, target=tgt).collect()}
    assert {c: (rows[c]["status"], rows[c]["violation_count"]) for c in ("primary_key_val", "scd_type2_active_flag", "referential_integrity")} == {
        "primary_key_val": ("Fail", 1), "scd_type2_active_flag": ("Fail", 2), "referential_integrity": ("Fail", 2),
    }


def test_exact_numbers_and_maps(spark):
    def mismatches(left, right):
        s, o = spark.sql(f"SELECT 1 AS k, {left} AS v"), spark.sql(f"SELECT 1 AS k, {right} AS v")
        return C.consistency_summary(s, o, ["k"]).first()["mismatches"]

    assert mismatches("9007199254740993L", "CAST(9007199254740992 AS DECIMAL(20,0))") == 1
    assert mismatches("9007199254740993L", "CAST(9007199254740993 AS DECIMAL(22,2))") == 0
    assert mismatches("CAST('90071992547409920000.01' AS DECIMAL(24,2))", "CAST('90071992547409920000.02' AS DECIMAL(26,2))") == 1
    # no decimal type holds both: as text
    assert mismatches("CAST('1.50' AS DECIMAL(38,2))", "CAST('1.5' AS DECIMAL(38,30))") == 0
    assert mismatches("CAST('100' AS DECIMAL(38,2))", "CAST('100' AS DECIMAL(38,30))") == 0
    assert mismatches("CAST('1.50' AS DECIMAL(38,2))", "CAST('1.51' AS DECIMAL(38,30))") == 1
    assert mismatches("1.5D", "CAST('1.5' AS DECIMAL(5,2))") == 0
    assert mismatches("named_struct('m', map('a', 1, 'b', 2))", "named_struct('m', map('b', 2, 'a', 1))") == 0
    assert mismatches("map('x', map('a', 1, 'b', 2))", "map('x', map('b', 2, 'a', 1))") == 0
    assert mismatches("map('x', map('a', 1))", "map('x', map('a', 2))") == 1
    assert mismatches("array(map('a', 1))", "array(map('a', CAST(NULL AS INT)))") == 1


def test_lookup_has_its_own_options_and_guards(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id|fk|batch_date\n1|7|2025-01-01\n2|8|2025-01-01\n")
    (tmp_path / "c.csv").write_text("cid,name\n7,a\n")
    (tmp_path / "empty.csv").write_text("cid,name\n")
    files = {
        "d": {"stg_file_path": str(tmp_path / "t.csv"), "trgt_file_path": str(tmp_path / "t.csv"), "primary_key": ["id"], "read_options": {"sep": "|"},
              "lookup": {"lookup_file": "c", "lookup_column": "cid", "target_column": "fk"}},
        "c": {"trgt_file_path": str(tmp_path / "c.csv"), "primary_key": ["cid"]},
    }

    def referential():
        rows = validate_dataset(spark, "d", files, mode="staging_to_target").collect()
        return next(r for r in rows if r["check"] == "referential_integrity")

    assert (referential()["status"], referential()["violation_count"]) == ("Fail", 1)
    files["c"]["trgt_file_path"] = str(tmp_path / "empty.csv")
    assert "lookup layer is empty" in referential()["details"]
    files["c"]["trgt_file_path"] = str(tmp_path / "missing.csv")
    assert "PATH_NOT_FOUND" in referential()["details"]


def test_restarted_stream_keeps_earlier_results(spark, tmp_path):
    landing, results, ckpt = tmp_path / "landing", tmp_path / "results", tmp_path / "ckpt"
    spec = DatasetSpec(name="t", key=("k",), non_null=("k",), rules=())
    schema = "k int, batch_date date"
    day = dt.date(2025, 1, 1)
    target = spark.createDataFrame([(1, day)], schema)

    def load(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(landing / name))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(landing))
        check_each_load(stream, spec, "staging_to_target", target, str(results), str(ckpt)).awaitTermination(120)

    load("one", [(1, day), (2, day)])
    load("two", [(1, day)])
    got = {r["batch_id"]: r["status"] for r in spark.read.parquet(str(results)).where("check = 'count_val_latest_batch'").collect()}
    assert got == {0: "Fail", 1: "Success"}


def test_decimal_values_survive(spark):
    df = spark.createDataFrame([(1, Decimal("1.10"))], "k int, v decimal(10,2)")
    assert C.consistency_summary(df, df, ["k"]).first()["mismatches"] == 0
