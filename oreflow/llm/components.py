"""Connected components of a graph of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node to its least neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    linked = (near.where("b > a") if large else near).join(least, "a")
    out = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the least node reachable.

    Each round is two aggregates with map-side combine and two joins; the rounds grow with
    the logarithm of the longest chain. Only a count and a checksum reach the driver. No
    edges give no rows.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = saved(edges.where("a != b").distinct(), name)
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).head()
        if state[0] == 0 or state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        edges = saved(_star(_star(edges, large=True), large=False), name)
