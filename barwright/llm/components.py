"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import stored


def _toward_least(edges: DataFrame) -> DataFrame:
    """(a, least neighbour of a or a itself) for every node of edges (a, b)."""
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node of the component.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the
    node's least neighbour, then every smaller one is. Each round is a few joins over a written
    table of links; no component is gathered anywhere. Links of a node to itself are dropped.
    """
    a, b, least = F.col("a"), F.col("b"), F.col("least")
    edges = stored(links.where(a != b).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    state = None
    while True:
        wide = _both_ways(edges)
        wide = wide.join(_toward_least(wide), "a").where(b > a).select(
            b.alias("a"), least.alias("b")).where(a != b).distinct()
        narrow = wide.join(_toward_least(wide), "a")
        edges = stored(narrow.where(b != least).select(b.alias("a"), least.alias("b")).unionByName(
            narrow.select("a", least.alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    # Every node but a root now has one link, to its root.
    return edges.select(a.alias("node"), b.alias("root")).unionByName(
        edges.select(b.alias("node"), b.alias("root")).distinct())
