"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select("v", "u"))
    least = (both.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"),
                                                         F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of ``edges(u, v)``, longs: a component is named by its
    smallest node. Nodes without an edge are not listed. Each round is written to
    the shared folder; rounds end when the edges stay as they are."""
    current = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                 F.least("u", "v").alias("v")).distinct(),
                    "edges")
    mark = _mark(current)
    while True:
        current = stage(_small_star(_large_star(current)), "edges")
        now = _mark(current)
        if now == mark:
            break
        mark = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select("v", "v").distinct())


def _mark(edges: DataFrame) -> tuple:
    """The edges' count and a checksum that their order doesn't change."""
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
