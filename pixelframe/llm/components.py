"""Connected components of a distributed edge list by alternating large-star
and small-star rounds (Kiveris et al., 2014): the edges of every round are
written to the shared folder, only their number and a checksum reach the
driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pixelframe.llm.base import stored


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long) that is not its
    component's smallest node; ``root`` is that smallest node."""
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .distinct(), "edges")
    state = _checksum(e)
    if state[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        e = stored(_small_star(_large_star(e)), "edges")
        now = _checksum(e)
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _checksum(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()
