"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import skew
from .common import Scratch


def _meet(links: DataFrame, least: DataFrame, many: bool) -> DataFrame:
    """Each link with the row of its node ``u``; a node with very many links is spread where there can be one."""
    return skew.salted_stats_join(links, least, ["u"], "n") if many else links.join(least, "u")


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b long); root is the least node of its component.

    Each round hangs a node's larger neighbours, then its smaller ones, on the
    least of its neighbourhood, until nothing changes; the rounds grow with the logarithm of the
    longest chain.  The least neighbour is a partial aggregate, and where it goes back to the links
    the links of a node with over ``skew.HOT_KEY_MIN_ROWS`` of them are spread over sub-keys, so a star of any
    size has no task of its own.  Every round ends in a table of the shared folder.
    """
    edges = scratch.table(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = lambda: tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    last, now = None, seen()
    while now != last:
        many = 2 * now[0] > skew.HOT_KEY_MIN_ROWS  # else no node can have that many links
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = _meet(both.where("v > u"), least, many).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.table(large) if many else large
        small = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        hung = _meet(large, small, many).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.table(hung.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        last, now = now, seen()
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
