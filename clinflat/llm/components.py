"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.session import stage


def _minima(edges: DataFrame) -> DataFrame:
    """The smallest of each node u and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    turned = both.where("v > u").join(_minima(both), "u")
    return turned.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node itself, is tied to the smallest of them."""
    least = _minima(edges)
    turned = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return turned.unionByName(own).where("u > v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the links (u, v); the root is the smallest node.

    Both steps keep the components and replace edges by at most as many. Minima are
    aggregated before the shuffle; a node with very many edges is only ever joined to
    one row, a join whose large partitions Spark splits. Every round is written to the
    shared folder. Ends when a round changes nothing.
    """
    edges = links.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges, before = stage(edges.distinct(), "links"), None
    while True:
        edges = stage(_small_star(_large_star(edges)), "links")
        state = edges.agg(
            F.count("u").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    tops = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(tops).select(F.col("u").alias("node"), F.col("v").alias("root"))
