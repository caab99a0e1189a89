"""Properties over the shared test tables: identical layers pass, deleted keys are found, built histories pass."""

import pytest
from pyspark.sql import functions as F

from stagegate.operators import consistency as C
from stagegate.operators import history as H
from stagegate.operators import violations as V
from stagegate.sources import seeded

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def orders(spark):
    return seeded.table(spark, SF, "orders")


def test_identical_layers_pass(spark, orders):
    r = V.row_counts(orders, orders).first()
    assert r["source_count"] == r["target_count"]
    assert V.missing_keys(orders, orders, ["o_orderkey"]).count() == 0
    assert all(r["mismatches"] == 0 for r in C.consistency_summary(orders, orders, ["o_orderkey"]).collect())


@pytest.mark.parametrize("modulus", [7, 13])
def test_deleting_k_keys_is_reported_as_k(spark, orders, modulus):
    kept = orders.where(F.col("o_orderkey") % modulus != 0)
    k = orders.where(F.col("o_orderkey") % modulus == 0).select("o_orderkey").distinct().count()
    assert V.missing_keys(orders, kept, ["o_orderkey"]).count() == k


def test_built_history_has_one_active_version_per_key(spark):
    lineitem = seeded.table(spark, SF, "lineitem")
    v = H.build_versions(lineitem.select("l_orderkey", "l_linenumber", "l_shipdate"), ["l_orderkey"], "l_shipdate", ["l_linenumber"])
    assert V.active_flag_violations(v, ["l_orderkey"], "is_active").count() == 0
    assert v.count() == lineitem.count()
