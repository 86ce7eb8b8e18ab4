"""Connected components by alternating large-star and small-star steps, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import measured
from leadlake.session import cut_lineage


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, low): the smallest of u and its neighbours; partial minima come before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u goes to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and every smaller neighbour go to the smallest of them. Edges point down: u > v."""
    low = _lowest(edges)
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b): the smallest node that can be reached.

    Each step is checkpointed; only a count and a checksum reach the driver. A node with links to a third of all
    others is one partial minimum a task, and a join key that AQE splits. Minima are broadcast only where their shuffle
    was small, as links to one node take so little room in a file that Spark would size them too low. Repeated links
    and links of a node to itself change nothing. No links: no rows.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = cut_lineage(edges), None
    with measured(links.sparkSession):
        while True:
            seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if seen[0] == 0 or seen == before:
                break
            before = seen
            edges = cut_lineage(_small_star(cut_lineage(_large_star(edges))))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
