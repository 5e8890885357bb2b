"""Connected components of an edge table by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(
        edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """`node`, `component` for every node that is not the smallest of its component.

    Edges are pairs of longs in any order; null ends, loops and repeats are ignored. Each round halves
    the distance to the smallest node and is written to the checkpoint folder; the driver sees only a
    count and a checksum. An empty table gives an empty table.
    """
    found = cut(edges.where(f"{left} <> {right}")
                .select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct())
    before = None
    while True:
        now = found.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return found.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        found = cut(_small_star(_large_star(found)))
