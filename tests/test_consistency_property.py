"""The pair-free consistency count equals the pairwise count, including hot duplicate keys and NULLs."""

import itertools
import random

import pytest

from stagegate.operators import consistency as C


def brute(src, stg):
    out = {"a": 0, "b": 0}
    pairs = 0
    for s, t in itertools.product(src, stg):
        if s[0] is None or t[0] is None or s[0] != t[0]:
            continue
        pairs += 1
        for i, c in ((1, "a"), (2, "b")):
            if s[i] != t[i]:
                out[c] += 1
    return out, pairs


@pytest.mark.parametrize("seed,hot_rows", [(0, 100_000), (1, 100_000), (2, 100_000), (3, 2), (4, 2), (5, 3)])
def test_pair_free_matches_brute_force(spark, seed, hot_rows):
    """hot_rows = 2 or 3 routes every key with more rows than that through the broadcast hot-key path."""
    rnd = random.Random(seed)
    def rows(n):
        out = []
        for _ in range(n):
            k = rnd.choice([None, 0, 0, 0, 1, 2, 3, 4])  # key 0 is hot
            out.append((k, rnd.choice([None, 1, 2]), rnd.choice([None, "x", "y"])))
        return out
    src, stg = rows(rnd.randint(0, 30)), rows(rnd.randint(0, 30))
    schema = "k int, a int, b string"
    got_rows = C.consistency_summary(
        spark.createDataFrame(src, schema), spark.createDataFrame(stg, schema), ["k"], hot_key_rows=hot_rows
    ).collect()
    want, pairs = brute(src, stg)
    assert {r["column_name"]: r["mismatches"] for r in got_rows} == want
    assert all(r["pairs"] == pairs for r in got_rows)
    keyed = C.inconsistent_keys(
        spark.createDataFrame(src, schema), spark.createDataFrame(stg, schema), ["k"], hot_key_rows=hot_rows
    ).collect()
    per_col = {"a": 0, "b": 0}
    for r in keyed:
        per_col[r["column_name"]] += r["mismatches"]
    assert per_col == want


def test_hot_key_rows_are_spread_over_sub_keys(spark):
    # with a low bar, key 0 (a third of the rows) is hot: where its rows meet the key counts they have many sub-keys
    src = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "CAST(id % 7 AS INT) AS a")
    stg = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "CAST(id % 5 AS INT) AS a")
    summary = C.consistency_summary(src, stg, ["k"], hot_key_rows=100)
    assert "_salt" in summary._jdf.queryExecution().optimizedPlan().toString()
    got = {x["column_name"]: x["mismatches"] for x in summary.collect()}
    ref = {x["column_name"]: x["mismatches"] for x in C.consistency_summary(src, stg, ["k"]).collect()}
    assert got == ref


def test_hot_key_plan_has_no_pairwise_join(spark):
    # a key with many rows on both sides: the plan never joins rows of that key pairwise
    src = spark.range(0, 2000).selectExpr("0 AS k", "CAST(id % 7 AS INT) AS a", "CAST(id % 3 AS STRING) AS b")
    stg = spark.range(0, 2000).selectExpr("0 AS k", "CAST(id % 5 AS INT) AS a", "CAST(id % 3 AS STRING) AS b")
    got = {r["column_name"]: (r["mismatches"], r["pairs"]) for r in C.consistency_summary(src, stg, ["k"]).collect()}
    # a: values 0..6 on one side, 0..4 on the other
    from collections import Counter
    ca, cb = Counter(i % 7 for i in range(2000)), Counter(i % 5 for i in range(2000))
    eq_a = sum(ca[v] * cb[v] for v in ca)
    cs = Counter(i % 3 for i in range(2000))
    eq_b = sum(cs[v] ** 2 for v in cs)
    assert got["a"] == (4_000_000 - eq_a, 4_000_000)
    assert got["b"] == (4_000_000 - eq_b, 4_000_000)


def _brute_generic(src, stg, nkey, ncols):
    """Pairwise reference: keys joined with '=', values compared NULL-safely (NaN == NaN, -0.0 == 0.0)."""
    import math

    def same(a, b):
        if a is None or b is None:
            return a is None and b is None
        if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
            return True
        return a == b

    out, pairs = [0] * ncols, 0
    for s, t in itertools.product(src, stg):
        ks, kt = s[:nkey], t[:nkey]
        if any(x is None for x in ks + kt) or ks != kt:
            continue
        pairs += 1
        for i in range(ncols):
            if not same(s[nkey + i], t[nkey + i]):
                out[i] += 1
    return out, pairs


@pytest.mark.parametrize("seed,hot_rows", [(11, 100_000), (12, 2), (13, 100_000)])
def test_composite_key_floats_dates_maps(spark, seed, hot_rows):
    import datetime as dt

    rnd = random.Random(seed)
    floats = [None, 0.0, -0.0, 1.5, float("nan")]
    dates = [None, dt.date(2025, 1, 1), dt.date(2025, 1, 2)]
    maps = [None, {"a": 1}, {"a": 1, "b": 2}, {"b": 2, "a": 1}]

    def rows(n):
        return [
            (rnd.choice([None, 1, 1, 2]), rnd.choice(["x", "x", "y", None]), rnd.choice(floats), rnd.choice(dates), rnd.choice(maps))
            for _ in range(n)
        ]

    src, stg = rows(rnd.randint(5, 25)), rows(rnd.randint(5, 25))
    schema = "k1 int, k2 string, f double, d date, m map<string,int>"
    s_df, o_df = spark.createDataFrame(src, schema), spark.createDataFrame(stg, schema)
    got = {r["column_name"]: (r["mismatches"], r["pairs"]) for r in C.consistency_summary(s_df, o_df, ["k1", "k2"], hot_key_rows=hot_rows).collect()}
    want, pairs = _brute_generic(src, stg, 2, 3)
    assert got == {"f": (want[0], pairs), "d": (want[1], pairs), "m": (want[2], pairs)}
    keyed = C.inconsistent_keys(s_df, o_df, ["k1", "k2"], hot_key_rows=hot_rows).collect()
    per = {"f": 0, "d": 0, "m": 0}
    for r in keyed:
        per[r["column_name"]] += r["mismatches"]
    assert [per["f"], per["d"], per["m"]] == want
