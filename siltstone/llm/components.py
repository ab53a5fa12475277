"""Connected components by alternating large-star and small-star steps on a DataFrame of edges.

Every step is an aggregation (minimum neighbour of a node, combined before the shuffle) and a join of the edges with it, one
row a node, so a hub's edges can be split by the adaptive skew join; neighbour lists are never gathered. Each round is written to
the shared folder. The rounds stop when the edges no longer change; their number grows with the logarithm of the
components' diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised


def _minimum(edges: DataFrame) -> DataFrame:
    """least: the smallest of u and the neighbours that edges list for it."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    up = both.where("v > u").join(_minimum(both), "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return up.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = _minimum(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Changes whenever the edges do, and cannot overflow. xor needs edges without repeats."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long). Returns node, root (smallest node of its component) for every node that is not itself a root.

    Loops and repeated edges are allowed; no edges give no rows.
    """
    now = materialised(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        new = _state(now)
        if new == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
        now = materialised(_small_star(_large_star(now)))
