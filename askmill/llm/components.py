"""Connected components of links between long ids, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmill.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component_id) for every node of the links (a, b): the smallest node it reaches.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked with the
    least of its neighbourhood, then every smaller one is. Both only take minima by node, which
    are made before the shuffle, so a node with many links is no burden; chains shrink by half or
    more in a round. Each round's links are written to the shared folder.
    """
    edges = saved(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(least, "a")
        small = joined.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = saved(small.union(least.select("a", F.col("least").alias("b"))).distinct(), "links")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    # A star of each component around its least node.
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.union(roots).select(F.col("a").alias("node"), F.col("b").alias("component_id")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).head())
