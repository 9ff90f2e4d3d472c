"""Distributed union-find over a table of links, with DataFrame operations only."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tellmark.session import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on the smallest node it sees."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs itself and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of its component.

    Each round halves the depth of the trees, a hub never sits in one task (its links are only
    counted by a minimum and joined), and each round's table is written, so lineage stays short.
    Links of a node to itself and nulls are ignored.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select("b").distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
