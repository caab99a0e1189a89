"""Loads in any order against the rebuild from all of them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stagegate.operators import history as H

DAY = dt.date(2025, 1, 1)
HISTORY = "k int, v string, w int, effective_start_date date, effective_end_date date, is_active string, confirmed_dates array<date>"


def rebuilt(spark, loads):
    log = spark.createDataFrame(loads, "k int, v string, w int, batch_date date")
    return H.build_versions(log, ["k"], "batch_date", start_name="effective_start_date", end_name="effective_end_date", tracked=["v", "w"])


def by_key(rows):
    return sorted(((r[0], r[1], r[2], r[3], r[4] or dt.date.max, r[5]) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_equals_rebuild(spark, seed):
    rnd = random.Random(seed)
    loads = []
    for day in range(6):
        for k in [None, 1, 2, 3, 4]:
            if rnd.random() < 0.8:
                loads.append((k, rnd.choice(["a", "a", "b", None]), rnd.choice([1, 1, None]), DAY + dt.timedelta(day)))
    days = [DAY + dt.timedelta(d) for d in range(6)]
    rnd.shuffle(days)
    got = spark.createDataFrame([], HISTORY)
    for day in days:
        batch = spark.createDataFrame([r for r in loads if r[3] == day], "k int, v string, w int, batch_date date")
        got = spark.createDataFrame(H.insert_load(got, batch, ["k"], ["v", "w"]).collect(), HISTORY)
    cols = ["k", "v", "w", "effective_start_date", "effective_end_date", "is_active"]
    assert by_key(map(tuple, got.select(*cols).collect())) == by_key(map(tuple, rebuilt(spark, loads).select(*cols).collect()))


def test_repeat_changes_nothing_and_contradiction_fails(spark):
    empty = spark.createDataFrame([], HISTORY)
    load = spark.createDataFrame([(1, "a", 1, DAY), (2, "b", 2, DAY)], "k int, v string, w int, batch_date date")
    once = spark.createDataFrame(H.insert_load(empty, load, ["k"], ["v", "w"]).collect(), HISTORY)
    twice = H.insert_load(once, load, ["k"], ["v", "w"])
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
    with pytest.raises(Exception, match="two loads of one date disagree"):
        H.insert_load(once, load.withColumn("v", F.lit("z")), ["k"], ["v", "w"]).collect()


def test_without_confirmations_and_other_columns(spark):
    schema = "k int, v string, note string, s date, e date, f boolean"
    day = lambda n: DAY + dt.timedelta(n)
    history = spark.createDataFrame([(1, "a", "x", day(0), day(5), False), (1, "c", "y", day(5), None, True), (2, "a", "z", day(0), None, True)], schema)
    batch = spark.createDataFrame([(1, "b", day(3), "n"), (3, "q", day(1), "m")], "k int, v string, batch_date date, note string")
    out = H.insert_load(history, batch, ["k"], ["v"], start_name="s", end_name="e", flag_name="f", active="true", inactive="false", confirmed_name=None)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a", "x", day(0), day(3), False), (1, "b", "n", day(3), day(5), False), (1, "c", "y", day(5), None, True), (2, "a", "z", day(0), None, True), (3, "q", "m", day(1), None, True)],
        key=str,
    )
