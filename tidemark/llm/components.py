"""Connected components by alternating large-star and small-star steps.

A node's smallest neighbour comes from an aggregate that folds before its shuffle and is
joined back to the node's edges, so a node with very many neighbours is no list in one
task, and an adaptive join can split it. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import freeze


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node among it and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = near.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``u`` and the smallest node ``v`` that it reaches, for all nodes but the smallest ones.

    ``edges`` has columns u and v, in any order, with repeats or loops or not; rows with a
    null are left out.
    """
    edges = freeze(edges.select("u", "v").where("u <> v").distinct())
    before = None
    while (now := _print(edges)) != before:
        before = now
        edges = freeze(small_star(large_star(edges)))
    return edges
