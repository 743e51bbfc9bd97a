"""Connected components of a link table by alternating large-star and small-star steps; nothing reaches the driver but two sums a step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def _large_star(edges: DataFrame, keep) -> DataFrame:
    """Every larger neighbour of a node goes to the least of the node and its neighbours.

    ``keep`` writes the least neighbours, so that the join meets two plain exchanges and a node of many links can be split.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, keep) -> DataFrame:
    """A node and its smaller neighbours go to the least of these."""
    least = keep(edges.groupBy("u").agg(F.min("v").alias("m")))
    rest = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, root (the least node it can reach) for every node of ``links`` (a, b) that isn't its own root."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    before, step = None, 0
    while True:
        kept = lambda kind: lambda df: scratch.write(df, f"{name}-{step}-{kind}")  # noqa: B023, E731
        large = scratch.write(_large_star(edges, kept("large-least")), f"{name}-{step}-large")
        edges = scratch.write(_small_star(large, kept("small-least")), f"{name}-{step}")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, step = now, step + 1
