"""Components against a union-find: chains, stars, random graphs, with nodes spread and not."""

import random

import pytest

from stagegate.llm import components
from stagegate.llm.common import Scratch


def brute(links):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return {x: top(x) for x in list(up)}


@pytest.mark.parametrize("hot", [100_000, 4])
def test_against_union_find(spark, monkeypatch, hot):
    monkeypatch.setattr(components.skew, "HOT_KEY_MIN_ROWS", hot)
    monkeypatch.setattr(components.skew.salted_stats_join, "__defaults__", (hot, 100_000, "inner", 8))
    rng = random.Random(2)
    chain = [(i + 1000, i + 1001) for i in range(40)]
    star = [(5000, 5001 + i) for i in range(60)] + [(6000 + i, 6100) for i in range(60)]
    links = chain + star + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(-5, 7), (3, 3)]
    rng.shuffle(links)
    got = components.connected_components(spark.createDataFrame(links * 2, "a long, b long"), Scratch(spark, "test"))
    rows = got.collect()
    assert {r.node: r.root for r in rows} == brute(links) and len(rows) == len(brute(links))


def test_no_links(spark):
    assert components.connected_components(spark.createDataFrame([(1, 1)], "a long, b long"), Scratch(spark, "test")).count() == 0
