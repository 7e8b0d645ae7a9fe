"""Connected components of a graph given by its links, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringlens.session import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node below the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    around = both.select(F.col("hi").alias("node"), F.col("lo").alias("near"))
    least = around.groupBy("node").agg(F.least("node", F.min("near")).alias("least"))
    return (
        around.where("near > node")
        .join(least, "node")
        .select(F.col("near").alias("hi"), F.col("least").alias("lo"))
        .distinct()
    )


def small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours below the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    lower = edges.join(least, "hi").where("lo > least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return lower.unionByName(least.select("hi", F.col("least").alias("lo"))).distinct()


def is_settled(edges: DataFrame) -> bool:
    """Every node hangs below one node, which hangs below none."""
    several = edges.groupBy("hi").agg(F.count("*").alias("n")).where("n > 1").select("hi")
    chained = edges.select(F.col("lo").alias("hi")).join(edges.select("hi"), "hi", "left_semi")
    return several.unionByName(chained).isEmpty()


def contracted(edges: DataFrame) -> DataFrame:
    """One large and one small star: the same components, whose nodes hang lower."""
    return stored(small_star(large_star(edges)), "star")


def hung(links: DataFrame, a: str, b: str) -> DataFrame:
    """The links as ``hi`` above ``lo``."""
    return links.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for each linked node but the smallest ones.

    Alternates large and small stars, each one aggregation and one join per
    node, until all nodes hang directly below their smallest. Each round is
    written to the shared folder, so a lost executor costs one round at most.
    Links to itself and links with a null are ignored; no links give no rows.
    """
    edges = stored(hung(links, a, b).distinct(), "links")
    while not is_settled(edges):
        edges = contracted(edges)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
