"""Connected components of a table of links, by rounds of joins and minimums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardlift.shared import write_shared


def _minimum_neighbours(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _round(links: DataFrame) -> DataFrame:
    """Larger neighbours move to the smallest neighbour, then smaller ones do (links are a > b)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _minimum_neighbours(both).withColumn("least", F.least("a", "least"))
    large = (
        both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    )
    large = large.where("a <> b").distinct()
    least = _minimum_neighbours(large)
    moved = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) from links (a, b): the smallest node that can be reached, for every linked node.

    Links may come in any direction and repeated; loops and nulls are ignored. Minimums are taken on the map
    side and joined, so a node with very many links is split like any skewed join. Each round is written to
    the shared folder, and rounds go on until nothing changes; their number grows with the logarithm of the nodes.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct()
    links = write_shared(links, "links")
    state = None
    while True:
        # A link is settled when its target has no link of its own upwards: then all are stars.
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        links = write_shared(_round(links), "links")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
