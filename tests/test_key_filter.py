"""The filtered referential check: same rows as the plain one, at any filter size, and few keys pass."""

import random

import pytest

from stagegate.operators import violations as V


@pytest.mark.parametrize("most_blocks", [1, 4, 1 << 20])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_same_rows_as_the_plain_join(spark, most_blocks, kind):
    rng = random.Random(most_blocks)
    values = [(None if rng.random() < 0.1 else rng.randrange(400),) for _ in range(600)]
    keys = [(None if rng.random() < 0.1 else rng.randrange(100, 5000),) for _ in range(900)]
    df = spark.createDataFrame(values, "fk long").selectExpr(f"CAST(fk AS {kind}) AS fk")
    lookup = spark.createDataFrame(keys, "k long").selectExpr(f"CAST(k AS {kind}) AS k")
    rows = lambda x: sorted(map(tuple, x.collect()), key=str)
    assert rows(V.orphan_values_filtered(df, "fk", lookup, "k", 600, most_blocks=most_blocks)) == rows(V.orphan_values(df, "fk", lookup, "k"))


def test_false_positives_stay_under_the_stated_rate(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    held, blocks = V.key_filter(keys, "k", 20_000)
    other = spark.range(1_000_000, 1_100_000).select("id", *V._marks(V.qcol("id"), blocks))
    passed = other.join(held, "_block").where("_held & _bits = _bits").count()
    assert passed < 100_000 / 100
    own = keys.select("k", *V._marks(V.qcol("k"), blocks)).join(held, "_block").where("_held & _bits = _bits").count()
    assert own == 20_000
