"""Connected components on Spark by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that occurs in ``edges(a, b)``; root is the smallest node
    of its component. Each round is written to the shared folder, so lineage stays short;
    nothing but one count per round reaches the driver. An empty input gives no rows.

    A hub's edges are joined with one minimum per node, so only the join side that AQE can
    split is skewed, never an aggregate's group."""
    links = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    before = None
    for _ in range(max_rounds):
        links = stage(_small_star(_large_star(links)), "star")
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the smallest of u and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the smallest neighbour (a > b holds)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
