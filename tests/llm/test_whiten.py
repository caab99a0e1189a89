"""Whitening against exact fractions and plain numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagegate.llm import queries, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(vectors, weighted=False):
    """n, exact sums, eigenvalues, eigenvectors and trace of the distinct integer vectors, by fractions and one dense product."""
    ints = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = ints if weighted else sorted(set(ints))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in fit])
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    return ints, n, sums, values[::-1], axes[:, ::-1], np.trace(cov)


def check(rows, got, weighted=False):
    ints, n, sums, values, axes, trace = brute([v for _, v in rows], weighted)
    by_key = {(r.vec_id, r.component): r for r in got}
    k = min(4, len(sums))
    assert len(by_key) == len(got) == k * len(rows)
    for c in range(k):
        sign = None
        for (i, _), x in zip(rows, ints):
            r = by_key[i, c + 1]
            assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums))
            assert r.explained == pytest.approx(values[c] / trace, rel=1e-9)
            want = float(np.dot(np.array(x) - np.array(sums) / n, axes[:, c]) / math.sqrt(values[c]))
            sign = sign or (1 if want * r.whitened > 0 else -1)
            assert r.whitened == pytest.approx(sign * want, abs=1e-7)
            assert r.identity_error < 1e-9


def test_query_against_numpy(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, [0.4, 0.3, 0.2, 0.1, 0.05, 0.01]) - [0, 1, 0, 0, 0, 0]).tolist(), None) for i in range(300)]
    rows += [(1000 + i, rows[0][1], i) for i in range(400)]  # one vector many times
    rows += [(2000, rows[1][1], 0), (2000, rows[1][1], 0)][:1]
    bad = [(3000, None, 1), (3001, [1.0, None, 0, 0, 0, 0], 1), (3002, [float("nan")] * 6, 1), (3003, [float("inf")] * 6, 1)]
    bad = [(i, v if v is None else [None if c is None else float(c) for c in v], k) for i, v, k in bad]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumn("x", F.lit(1)).withColumn("copies", F.lit(2)).withColumn("n", F.lit("a"))
    df.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    check([(i, v) for i, v, _ in rows], queries.op12_whitening(spark, str(tmp_path)).collect())


def test_sf_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, d, "embeddings").collect() if whole(r.embedding)]
    check(rows, queries.op12_whitening(spark, d).collect())


def test_weighted_fit(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).tolist(), None) for i in range(40)] + [(100 + i, [0.5, 0.25, -1.0, 2.0, 0.0], None) for i in range(60)]
    out = whiten.whiten(spark.createDataFrame(rows, SCHEMA), weighted=True)
    got = out.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
    check([(i, v) for i, v, _ in rows], got.collect(), weighted=True)


def test_hot_vector_is_spread(spark, monkeypatch):
    """The salted route of the join gives the same rows."""
    monkeypatch.setattr(whiten.skew.salted_stats_join, "__defaults__", (3, 100_000, "inner", 8))
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist(), None) for i in range(30)] + [(100 + i, [0.5, 0.25, -1.0, 2.0], None) for i in range(50)]
    out = whiten.whiten(spark.createDataFrame(rows, SCHEMA))
    assert out.count() == 80 and out.where("vec_id >= 100").select("whitened").distinct().count() == 1


def test_edges(spark):
    call = lambda rows: {r.vec_id: r for r in whiten.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert call([]) == {}
    assert call([(1, None, None)]) == {}
    one = call([(1, [1.0, 2.0, 3.0], None), (2, [1.0, 2.0, 3.0], None), (None, [1.0, 2.0, 3.0], None)])
    assert set(one) == {1, 2, None} and one[1].n == 1 and one[1].deviation == 0
    assert one[1].whitened == [None] * 3 and one[1].explained == [None] * 3 and one[1].identity_error is None
    # lengths are populations of their own; fewer distinct vectors than components
    mixed = call([(1, [1.0], None), (2, [2.0], None), (3, [0.0, 1.0, 5.0], None), (4, [1.0, 1.0, 5.0], None), (5, [], None)])
    assert len(mixed[1].whitened) == 1 and mixed[1].n == 2 and mixed[5].whitened == []
    assert mixed[3].whitened[0] is not None and mixed[3].whitened[1:] == [None, None] and mixed[3].identity_error < 1e-12
    # negative zero and exact sums beyond 2^53
    big = call([(1, [-0.0, 3.0e13], None), (2, [0.0, -1.0e13], None), (3, [0.5, 0.0], None)])
    ints = [[math.floor(256 * float(np.float32(c))) for c in v] for v in ([0.0, 3.0e13], [0.0, -1.0e13], [0.5, 0.0])]
    sums = [sum(c) for c in zip(*ints)]
    for i, x in enumerate(ints):
        assert big[i + 1].deviation == sum((3 * a - s) ** 2 for a, s in zip(x, sums))
    with pytest.raises(Exception, match="does not fit a long"):
        call([(1, [1e30, 1.0], None)])
