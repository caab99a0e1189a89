"""Expected check outcomes on the original framework's sample data (type 1 customers, type 2 orders)."""

import json

import pytest

from sample_data import SCHEMA_CONFIG, write_fixture
from stagegate.plans.suites import summarize
from stagegate.sources.config import validate_dataset


@pytest.fixture(scope="module")
def fixture_config(tmp_path_factory):
    folder = tmp_path_factory.mktemp("samples")
    files = write_fixture(folder)
    fpath, spath = folder / "datasets.json", folder / "schemas.json"
    fpath.write_text(json.dumps(files))
    spath.write_text(json.dumps(SCHEMA_CONFIG))
    return str(fpath), str(spath)


def _by_check(df):
    return {(r["stage"], r["check"]): r for r in df.collect()}


def test_customer_both_stages(spark, fixture_config):
    res = validate_dataset(spark, "customer_data", *fixture_config, mode="both")
    r = _by_check(res)
    s2s, s2t = "source_to_staging", "staging_to_target"
    assert [x["check"] for x in res.orderBy("stage", "seq").collect()] == [
        "schemachk", "count_val", "null_val", "primary_key_val", "data_completeness", "data_consistency",
        "schemachk", "count_val_latest_batch", "null_val", "primary_key_val", "transformation_rules",
    ]
    sc = r[(s2s, "schemachk")]
    assert sc["status"] == "Fail" and sc["violation_count"] == 4
    assert r[(s2s, "count_val")]["status"] == "Success"
    assert r[(s2s, "count_val")]["metrics"] == {"source_count": 5, "target_count": 5}
    assert r[(s2s, "null_val")]["status"] == "Success"
    pk = r[(s2s, "primary_key_val")]
    assert pk["status"] == "Fail" and pk["violation_count"] == 1 and json.loads(pk["samples"][0]) == {"customer_id": 3, "n_rows": 2}
    assert r[(s2s, "data_completeness")]["status"] == "Success"
    cons = r[(s2s, "data_consistency")]
    assert cons["status"] == "Fail"
    m = cons["metrics"]
    assert m["_pairs"] == 7
    for c in ["first_name", "last_name", "email", "phone_number", "address", "city", "zip_code"]:
        assert m[c] == 2, c
    assert m["state"] == 0
    assert r[(s2t, "schemachk")]["violation_count"] == 4
    lb = r[(s2t, "count_val_latest_batch")]
    assert lb["status"] == "Success" and lb["metrics"] == {"staging_count": 5, "target_count": 5}
    assert "2025-12-17" in lb["details"]
    assert r[(s2t, "null_val")]["status"] == "Success"
    pk2 = r[(s2t, "primary_key_val")]
    assert pk2["violation_count"] == 4
    assert [json.loads(s) for s in pk2["samples"]] == [
        {"customer_id": 1, "n_rows": 3}, {"customer_id": 2, "n_rows": 3}, {"customer_id": 3, "n_rows": 6}, {"customer_id": 5, "n_rows": 3},
    ]
    assert r[(s2t, "transformation_rules")]["status"] == "Success"
    total = summarize(res).where("dataset IS NULL").first()
    assert (total["total"], total["passed"], total["failed"]) == (11, 6, 5)


def test_orders_both_stages(spark, fixture_config):
    res = validate_dataset(spark, "orders_data", *fixture_config, mode="both")
    r = _by_check(res)
    s2s, s2t = "source_to_staging", "staging_to_target"
    assert [x["check"] for x in res.where(f"stage = '{s2t}'").orderBy("seq").collect()] == [
        "schemachk", "scd_type2_record_count", "null_val", "primary_key_val", "scd_type2_active_flag",
        "scd_type2_history", "referential_integrity", "transformation_rules",
    ]
    assert r[(s2s, "schemachk")]["violation_count"] == 6
    for c in ["count_val", "null_val", "primary_key_val", "data_completeness", "data_consistency"]:
        assert r[(s2s, c)]["status"] == "Success", c
    assert r[(s2s, "data_consistency")]["metrics"]["_pairs"] == 5
    assert r[(s2t, "schemachk")]["violation_count"] == 9
    assert "unexpected field 'batch_date'" in r[(s2t, "schemachk")]["details"]
    rc = r[(s2t, "scd_type2_record_count")]
    assert rc["status"] == "Success" and rc["metrics"] == {"staging_count": 5, "target_count": 15}
    assert r[(s2t, "null_val")]["status"] == "Success"
    assert r[(s2t, "primary_key_val")]["violation_count"] == 5
    af = r[(s2t, "scd_type2_active_flag")]
    assert af["status"] == "Fail" and af["violation_count"] == 5
    assert {json.loads(s)["order_id"]: json.loads(s)["active_count"] for s in af["samples"]} == {101: 3, 102: 3, 103: 2, 104: 3, 105: 2}
    hist = r[(s2t, "scd_type2_history")]
    assert hist["status"] == "Success" and hist["metrics"]["inactive_count"] == 2
    ri = r[(s2t, "referential_integrity")]
    assert ri["status"] == "Fail" and ri["violation_count"] == 3
    assert [json.loads(s) for s in ri["samples"]] == [{"customer_id": 4, "n_rows": 3}]
    assert r[(s2t, "transformation_rules")]["status"] == "Success"
    total = summarize(res).where("dataset IS NULL").first()
    assert (total["total"], total["passed"], total["failed"]) == (14, 9, 5)


def test_single_stage_modes(spark, fixture_config):
    a = validate_dataset(spark, "orders_data", *fixture_config, mode="source_to_staging")
    assert {r["stage"] for r in a.collect()} == {"source_to_staging"}
    b = validate_dataset(spark, "orders_data", *fixture_config, mode="staging_to_target")
    assert b.count() == 8


def test_load_failure_is_a_result_row(spark, fixture_config, tmp_path):
    files = json.loads(open(fixture_config[0]).read())
    files["orders_data"]["trgt_file_path"] = str(tmp_path / "nope.csv")
    res = validate_dataset(spark, "orders_data", files, fixture_config[1], mode="both").collect()
    assert len(res) == 1 and res[0]["check"] == "load" and res[0]["status"] == "Error"
    assert "PATH_NOT_FOUND" in res[0]["details"] or "not exist" in res[0]["details"]


def test_empty_layer_is_a_load_error(spark, fixture_config, tmp_path):
    empty = tmp_path / "empty.csv"
    empty.write_text("order_id,customer_id,order_date,amount\n")
    files = json.loads(open(fixture_config[0]).read())
    files["orders_data"]["src_file_path"] = str(empty)
    res = validate_dataset(spark, "orders_data", files, fixture_config[1], mode="source_to_staging").collect()
    assert res[0]["check"] == "load" and "empty" in res[0]["details"]


def test_unknown_mode_rejected(spark, fixture_config):
    with pytest.raises(ValueError):
        validate_dataset(spark, "orders_data", *fixture_config, mode="everything")


def test_command_line(spark, fixture_config, tmp_path):
    from stagegate.__main__ import main

    out = tmp_path / "results"
    code = main(["--file-config", fixture_config[0], "--schema-config", fixture_config[1],
                 "--dataset", "orders_data", "--mode", "source_to_staging", "--output", str(out)])
    assert code == 1  # the schema check fails on the sample data
    assert spark.read.parquet(str(out)).count() == 6


def test_parquet_layers_via_config_format(spark, fixture_config, tmp_path):
    from stagegate.sources.readers import read_layer

    files = json.loads(open(fixture_config[0]).read())
    for layer in ("src_file_path", "stg_file_path", "trgt_file_path"):
        for ds in ("customer_data", "orders_data"):
            out = str(tmp_path / ds / layer)
            read_layer(spark, files[ds][layer]).write.parquet(out)
            files[ds][layer] = out
        files[ds]["format"] = "parquet"
    files["customer_data"]["format"] = files["orders_data"]["format"] = "parquet"
    res = validate_dataset(spark, "orders_data", files, fixture_config[1], mode="both")
    got = {(r["stage"], r["check"]): r["status"] for r in res.collect()}
    assert got[("staging_to_target", "referential_integrity")] == "Fail"
    assert got[("staging_to_target", "scd_type2_active_flag")] == "Fail"
    assert got[("source_to_staging", "data_consistency")] == "Success"


def test_zero_byte_layer_is_empty(spark, fixture_config, tmp_path):
    empty = tmp_path / "zero.csv"
    empty.write_text("")
    files = json.loads(open(fixture_config[0]).read())
    files["customer_data"]["src_file_path"] = str(empty)
    res = validate_dataset(spark, "customer_data", files, fixture_config[1], mode="source_to_staging").collect()
    assert res[0]["check"] == "load" and res[0]["status"] == "Error"


def test_persisted_layers_give_same_results(spark, fixture_config):
    cached_before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    a = validate_dataset(spark, "orders_data", *fixture_config, mode="both")
    b = validate_dataset(spark, "orders_data", *fixture_config, mode="both", persist=True)
    key = lambda df: sorted((r["stage"], r["check"], r["status"], r["violation_count"]) for r in df.collect())
    assert key(a) == key(b)
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == cached_before  # released after the checks


def test_rules_from_config(spark, fixture_config):
    files = json.loads(open(fixture_config[0]).read())
    files["orders_data"]["rules"] = [
        {"name": "amount_over_550", "violation": "amount > 550", "requires": ["amount"]},
        {"name": "needs_missing_column", "violation": "nope > 0", "requires": ["nope"]},
    ]
    res = validate_dataset(spark, "orders_data", files, fixture_config[1], mode="staging_to_target")
    r = {x["check"]: x for x in res.collect()}["transformation_rules"]
    assert r["status"] == "Fail" and r["metrics"] == {"amount_over_550": 3}  # 600, 600, 620 for order 105
