"""Connected components of a graph of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridagro.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node that can be reached from it.

    Each step points nodes at the smallest neighbour they know, first those above a node, then those
    below it; the number of steps grows with the logarithm of the longest path. The smallest neighbour
    is an aggregate that is combined before it is shuffled, so a node may have any number of links.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        edges, before, state = new, state, _state(new)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(nodes.select(F.col("label").alias("node"), "label").distinct())
