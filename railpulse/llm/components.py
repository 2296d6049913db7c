"""Connected components of an undirected graph by alternating large-star and
small-star rounds, all joins and grouped minima on Spark.

Each round makes every node point to the smallest node it sees; a component
ends as a star around its smallest node. The minima are combined before the
shuffle and stored, so that the join of a node with very many links has plain
shuffles on both sides, which adaptive execution splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.llm.common import checkpointed


def _point_to_least(edges: DataFrame) -> DataFrame:
    """(u, v) rows -> (u, v, m): m the least neighbour of u, or u itself."""
    least = checkpointed(edges.groupBy("u").agg(F.min("v").alias("m")))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")),
                           F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of comparable, non-null node ids -> (node, root), root
    the smallest id of the component. Nodes without an edge to another node do
    not appear."""
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .where("u != v").distinct())
    state = _state(edges)
    while state[0]:
        # Large star: every larger neighbour of u moves to the least neighbour of u.
        large = _point_to_least(_both_ways(edges)).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = checkpointed(large.where("u != v").distinct())
        # Small star: u and its smaller neighbours move to the least of them.
        seen = _point_to_least(large)
        small = seen.select("u", F.col("m").alias("v")).union(seen.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = checkpointed(small.where("u != v").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
