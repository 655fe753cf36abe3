"""Connected components of an edge list by alternating stars, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quire.llm.store import stored


def _settled(links: DataFrame) -> bool:
    """Whether the links form stars: no end of a link starts another one, and no start has two ends."""
    sides = links.select(F.col("a").alias("node"), F.lit(1).alias("starts"), F.lit(0).alias("ends")).union(
        links.select("b", F.lit(0), F.lit(1)))
    return sides.groupBy("node").agg(F.sum("starts").alias("starts"), F.max("ends").alias("ends")).filter(
        "starts + ends > 1").isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `edges` (a, b: long) that are not the smallest of their component.

    Each round links larger neighbours, then smaller ones, to the smallest neighbour of a node. It only takes minima
    per node, so a hub's edges are pre-aggregated and are never gathered. Rounds end when the links form stars, after
    about log(longest path) of them. Self-loops and repeated edges are harmless.
    """
    links = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    while not _settled(links):
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (both.filter("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        links = stored(small.select("a", F.col("low").alias("b"))
                       .union(small.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")))
                       .filter("a <> b").distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges`; a component is named after its smallest node (see `stars`).

    Nodes of self-loops alone are not in the result.
    """
    links = stars(edges)
    return links.union(links.select("component", "component").distinct())
