"""Connected components of a table of links, by rounds of star contraction.

Each round joins every node to the smallest node it knows; the number of rounds grows with
the logarithm of the longest path. Tables are written after each round, so lost executors
cost one round, and a node with very many links is summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finquarry.llm.common import dropped, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest node of the neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node itself, is linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    return down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").union(low.select("u", F.col("low").alias("v"))).distinct()


def _ordered(links: DataFrame) -> DataFrame:
    return links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def contracted(links: DataFrame, rounds: int = 2) -> DataFrame:
    """``links`` (u, v) after some rounds: other links, of the same components, mostly already stars.

    For steps that only gain by knowing part of the components: no test for the end, so no more than ``rounds`` small writes.
    """
    edges = _ordered(links)
    before = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "links")
        if before is not None:
            dropped(before)
        before = edges
    return edges


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) of bigint; returns (node, component), the smallest node reachable, for all linked nodes."""
    edges = stored(_ordered(links), "links")
    before = None
    while True:
        last, edges = edges, stored(_small_star(_large_star(edges)), "links")
        dropped(last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
