"""History operators: versions across range boundaries with a hot key, latest per key, merges."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stagegate.operators import history as H


def test_build_versions_matches_window_lead_with_hot_key(spark):
    # key 0 holds a third of the rows and spans several ranges; NULL keys form their own group
    df = spark.range(0, 3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 97 = 1 THEN NULL ELSE id % 50 END AS k",
        "CAST(id DIV 7 AS BIGINT) AS t",
        "id AS tb",
    )
    got = H.build_versions(df, ["k"], "t", ["tb"], end_name="e", flag_name="f", num_partitions=13)
    w = Window.partitionBy("k").orderBy("t", "tb")
    want = df.select("k", "tb", F.lead("t").over(w).alias("e2"), F.lead("tb").over(w).isNull().alias("last"))
    bad = got.join(want, ["tb"]).where(
        ~F.col("e").eqNullSafe(F.col("e2")) | ((F.col("f") == "Y") != F.col("last"))
    )
    assert bad.count() == 0
    assert got.count() == 3000


def test_build_versions_single_partition_and_empty(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 3, 2), (2, 1, 3)], "k int, t int, tb int")
    rows = {r["tb"]: (r["e"], r["f"]) for r in H.build_versions(df, ["k"], "t", ["tb"], end_name="e", flag_name="f", num_partitions=1).collect()}
    assert rows == {2: (5, "N"), 1: (None, "Y"), 3: (None, "Y")}
    empty = df.limit(0)
    assert H.build_versions(empty, ["k"], "t", ["tb"], num_partitions=4).count() == 0


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "a", dt.date(2025, 1, 1)), (1, "b", dt.date(2025, 1, 2)), (2, "c", dt.date(2025, 1, 1))], "k int, v string, batch_date date"
    )
    got = {r["k"]: r["v"] for r in H.latest_per_key(df, ["k"]).collect()}
    assert got == {1: "b", 2: "c"}


def test_apply_changes_and_update_where(spark):
    df = spark.createDataFrame([(1, 10, "x"), (2, 20, "y")], "k int, a int, b string")
    ch = spark.createDataFrame([(2, 99)], "k int, a int")
    assert {r["k"]: (r["a"], r["b"]) for r in H.apply_changes(df, ch, ["k"]).collect()} == {1: (10, "x"), 2: (99, "y")}
    up = H.update_where(df, "k = 1", {"b": "z"})
    assert {r["k"]: r["b"] for r in up.collect()} == {1: "z", 2: "y"}


def test_scd2_load_and_merge(spark):
    d1, d2 = dt.date(2025, 12, 15), dt.date(2025, 12, 16)
    load1 = spark.createDataFrame([(101, 250), (102, 450), (103, 300)], "order_id int, amount int")
    hist = H.scd2_load(load1, d1)
    batch = spark.createDataFrame([(101, 250, d2), (103, 310, d2), (104, 500, d2)], "order_id int, amount int, batch_date date")
    merged = H.merge_versions(hist, batch, ["order_id"], ["amount"])
    rows = sorted((r["order_id"], r["amount"], r["effective_start_date"], r["effective_end_date"], r["is_active"]) for r in merged.collect())
    assert rows == [
        (101, 250, d1, None, "Y"),
        (102, 450, d1, None, "Y"),
        (103, 300, d1, d2, "N"),
        (103, 310, d2, None, "Y"),
        (104, 500, d2, None, "Y"),
    ]
    # merged history passes the one-active-version check by construction
    from stagegate.operators.violations import active_flag_violations

    assert active_flag_violations(merged, ["order_id"], "is_active").count() == 0


def test_batch_stamp_and_counts(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    hist = H.append_batch(H.stamp_batch(df, "2025-12-15"), H.stamp_batch(df.limit(1), dt.date(2025, 12, 16)))
    got = {r["batch_date"]: r["n_rows"] for r in H.batch_counts(hist).collect()}
    assert got == {dt.date(2025, 12, 15): 2, dt.date(2025, 12, 16): 1}


def test_merge_batch_with_repeated_key_keeps_latest(spark):
    d1, d2, d3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    hist = H.scd2_load(spark.createDataFrame([(1, 10)], "k int, a int"), d1)
    batch = spark.createDataFrame([(1, 20, d2), (1, 30, d3)], "k int, a int, batch_date date")
    rows = sorted((r["a"], r["effective_end_date"], r["is_active"]) for r in H.merge_versions(hist, batch, ["k"], ["a"]).collect())
    assert rows == [(10, d3, "N"), (30, None, "Y")]


def test_hot_key_is_spread_over_ranges(spark):
    # one key holds a third of all rows; the ranges stay balanced (no task gets the whole key)
    df = spark.range(0, 30000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS t")
    counts = [r["n"] for r in H.ordered_ranges(df, ["k", "t"], 12).groupBy("_pid").agg(F.count("*").alias("n")).collect()]
    assert len(counts) >= 10
    assert max(counts) < 2.5 * (30000 / len(counts))
    hot_ranges = H.ordered_ranges(df, ["k", "t"], 12).where("k = 0").select("_pid").distinct().count()
    assert hot_ranges >= 3


def test_join_key_stats_hot_and_cold_agree(spark):
    from stagegate.operators.skew import join_key_stats

    rows = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 100 END AS k", "id")
    stats = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    plain = {(r["id"], r["top"]) for r in rows.join(stats, "k").collect()}
    for bar in (100_000, 5):  # nothing hot / key 0 and more are hot
        got = {(r["id"], r["top"]) for r in join_key_stats(rows, stats, ["k"], stats, "n", hot_key_rows=bar).collect()}
        assert got == plain


def test_merge_rejects_late_changes_but_reapplies_unchanged(spark):
    import pytest

    d1, d2 = dt.date(2025, 1, 2), dt.date(2025, 1, 1)
    hist = H.scd2_load(spark.createDataFrame([(1, 10)], "k int, a int"), d1)
    same = spark.createDataFrame([(1, 10, d2)], "k int, a int, batch_date date")
    assert H.merge_versions(hist, same, ["k"], ["a"]).count() == 1  # nothing changes: fine
    late = spark.createDataFrame([(1, 99, d2)], "k int, a int, batch_date date")
    with pytest.raises(Exception, match="late load"):
        H.merge_versions(hist, late, ["k"], ["a"]).collect()


def test_build_versions_random_layouts(spark):
    import random

    w = Window.partitionBy("k").orderBy("t", "tb")
    for seed in range(4):
        rnd = random.Random(seed)
        n = rnd.randint(50, 400)
        hot_share = rnd.choice([0.0, 0.3, 0.6])
        rows = []
        for i in range(n):
            k = 7 if rnd.random() < hot_share else rnd.choice([None, 1, 2, 3, 4, 5])
            rows.append((k, rnd.choice([None, 1, 2, 3, 5, 8]), i))
        df = spark.createDataFrame(rows, "k int, t int, tb int")
        got = H.build_versions(df, ["k"], "t", ["tb"], end_name="e", flag_name="f", num_partitions=rnd.randint(1, 9))
        want = df.select("tb", F.lead("t").over(w).alias("e2"), F.lead("tb").over(w).isNull().alias("last"))
        bad = got.join(want, "tb").where(~F.col("e").eqNullSafe(F.col("e2")) | ((F.col("f") == "Y") != F.col("last")))
        assert bad.count() == 0, seed
        assert got.count() == n


def test_latest_per_key_with_map_column(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1}, dt.date(2025, 1, 1)), (1, {"b": 2}, dt.date(2025, 1, 2))], "k int, m map<string,int>, batch_date date"
    )
    r = H.latest_per_key(df, ["k"]).first()
    assert r["m"] == {"b": 2}


def test_apply_changes_skew_safe_matches_plain(spark):
    df = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 40 END AS k", "id", "CAST(id AS INT) AS a")
    changes = df.groupBy("k").agg(F.lit(-1).alias("a")).where("k % 2 = 0")  # pre-aggregated: partitioned by k
    plain = H.apply_changes(df, changes, ["k"]).collect()
    safe = H.apply_changes(df, changes, ["k"], skew_safe=True)
    assert sorted(map(tuple, safe.collect())) == sorted(map(tuple, plain))
    from stagegate.operators import skew

    hot_rows = skew.join_key_stats(
        df.withColumn("_ck0", F.col("k")), changes.select(F.col("k").alias("_ck0"), F.col("a").alias("new_a")), ["_ck0"],
        df.groupBy(F.col("k").alias("_ck0")).count(), "count", hot_key_rows=500, how="left",
    )
    assert hot_rows.count() == 3000


def test_rebuild_with_tracked_equals_sequential_merges(spark):
    import random

    rnd = random.Random(7)
    days = [dt.date(2025, 1, d) for d in range(1, 6)]
    loads = []
    for d in days:
        rows = []
        for k in range(12):
            if rnd.random() < 0.8:
                rows.append((k, rnd.choice([1, 1, 1, 2, None]), d))
        loads.append(spark.createDataFrame(rows, "k int, a int, batch_date date"))
    hist = H.scd2_load(loads[0].drop("batch_date"), days[0])
    for load in loads[1:]:
        hist = H.merge_versions(hist, load, ["k"], ["a"])
    log = loads[0]
    for load in loads[1:]:
        log = H.append_batch(log, load)
    rebuilt = H.build_versions(
        log, ["k"], "batch_date", start_name="effective_start_date", end_name="effective_end_date",
        tracked=["a"], num_partitions=3,
    )
    norm = lambda df: sorted(
        ((r["k"], r["a"], r["effective_start_date"], r["effective_end_date"], r["is_active"]) for r in df.collect()),
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )
    assert norm(rebuilt) == norm(hist)


def test_merge_empty_batch_keeps_history(spark):
    d1 = dt.date(2025, 1, 1)
    hist = H.scd2_load(spark.createDataFrame([(1, 10), (2, 20)], "k int, a int"), d1)
    empty = spark.createDataFrame([], "k int, a int, batch_date date")
    merged = H.merge_versions(hist, empty, ["k"], ["a"])
    assert sorted(tuple(r) for r in merged.collect()) == sorted(tuple(r) for r in hist.collect())


def test_merge_carries_untracked_columns_from_the_batch(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    hist = H.scd2_load(spark.createDataFrame([(101, 1, 250)], "order_id int, customer_id int, amount int"), d1)
    batch = spark.createDataFrame([(101, 7, 300, d2)], "order_id int, customer_id int, amount int, batch_date date")
    rows = {r["amount"]: r["customer_id"] for r in H.merge_versions(hist, batch, ["order_id"], ["amount"]).collect()}
    assert rows == {250: 1, 300: 7}


def test_versions_keep_every_value(spark):
    # big integers beside NULLs, NaN beside NULL and the usual open-end date come out as they went in
    rows = [
        (1, dt.datetime(2025, 1, 1), 9007199254740993, float("nan"), dt.datetime(9999, 12, 31)),
        (1, dt.datetime(2025, 1, 2), 9007199254740992, None, None),
        (1, dt.datetime(9999, 12, 31), None, float("nan"), dt.datetime(9999, 12, 31)),
    ]
    df = spark.createDataFrame(rows, "k int, t timestamp, big bigint, x double, until timestamp")
    got = {r["t"]: r for r in H.build_versions(df, ["k"], "t", end_name="e", tracked=["big", "x"]).collect()}
    assert [got[r[1]]["big"] for r in rows] == [9007199254740993, 9007199254740992, None]
    assert got[rows[0][1]]["x"] != got[rows[0][1]]["x"] and got[rows[1][1]]["x"] is None
    assert got[rows[1][1]]["e"] == dt.datetime(9999, 12, 31) and got[rows[0][1]]["until"] == dt.datetime(9999, 12, 31)


def test_tracked_arrays_and_maps(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 1, array(1, 2), map('a', 1, 'b', 2)), (1, 2, array(1, 2), map('b', 2, 'a', 1)), "
        "(1, 3, array(2, 1), map('a', 1, 'b', 2)), (1, 4, array(2, 1), map('a', 1)) AS t(k, t, arr, m)"
    )
    got = sorted(r["t"] for r in H.build_versions(df, ["k"], "t", tracked=["arr", "m"]).collect())
    assert got == [1, 3, 4]  # the second row repeats the first


def test_tracked_repeats_over_many_ranges(spark):
    # one key over 13 ranges, its value changing every 250 rows; whole ranges hold repeats only
    df = spark.range(0, 2000).selectExpr("CAST(0 AS INT) AS k", "id AS t", "CAST(id DIV 250 AS INT) AS v")
    got = sorted((r["t"], r["e"], r["is_active"]) for r in H.build_versions(df, ["k"], "t", end_name="e", tracked=["v"], num_partitions=13).collect())
    assert got == [(i * 250, (i + 1) * 250 if i < 7 else None, "N" if i < 7 else "Y") for i in range(8)]


def test_versions_without_an_order_fail(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 5, "c")], "k int, t int, v string")
    with pytest.raises(Exception, match="without an order"):
        H.build_versions(df, ["k"], "t").collect()
    # a repeat of the same values is dropped, not a tie
    same = spark.createDataFrame([(1, 5, "a"), (1, 5, "a")], "k int, t int, v string")
    assert H.build_versions(same, ["k"], "t", tracked=["v"]).count() == 1


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, 1, 7), (1, 2, 8)], "_pid int, _next int, _tail int")
    got = {r["_next"]: (r["_tail"], r["effective_end"]) for r in H.build_versions(df, ["_pid"], "_next").collect()}
    assert got == {1: (7, 2), 2: (8, None)}
    ch = spark.createDataFrame([(1, 99)], "_pid int, _tail int")
    for safe in (False, True):
        assert {r["_tail"] for r in H.apply_changes(df, ch, ["_pid"], skew_safe=safe).collect()} == {99}
        assert H.scd2_load(df, "2025-01-01", ch, ["_pid"], skew_safe=safe).count() == 2


def test_merge_matches_null_keys_and_equals_the_rebuild(spark):
    import random

    rnd = random.Random(3)
    days = [dt.date(2025, 1, d) for d in (1, 2, 3, 4)]
    big = 9007199254740993
    loads = [[(k, rnd.choice([None, big, big - 1]), rnd.choice([None, float("nan"), 1.0]), d) for k in (None, 1, 2, 3, 4) if rnd.random() < 0.8] for d in days]
    schema = "k int, v bigint, x double, batch_date date"
    frames = [spark.createDataFrame(x, schema) for x in loads]
    hist = H.scd2_load(frames[0].drop("batch_date"), days[0])
    for f in frames[1:]:
        hist = H.merge_versions(hist, f, ["k"], ["v", "x"])
    everything = spark.createDataFrame([r for x in loads for r in x], schema)
    rebuilt = H.build_versions(everything, ["k"], "batch_date", start_name="effective_start_date", end_name="effective_end_date", tracked=["v", "x"])
    told = lambda df: sorted(map(str, df.select("k", "v", "x", "effective_start_date", "effective_end_date", "is_active").collect()))
    assert told(hist) == told(rebuilt)
    assert hist.where("k IS NULL AND is_active = 'Y'").count() <= 1
