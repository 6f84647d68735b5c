"""Connected components of a graph of links, by alternating star operations on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glotspark.functions.storage import Scratch

from .joins import small


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` of every node of ``links (a, b)``: the least node it can reach.

    Every round replaces links by links to the least neighbour, in time and size proportional to
    the links; a few rounds are enough, also for long chains (their length is squared away). Nodes
    with many links are handled by joins, which may split them, and by aggregates that combine
    before they shuffle. Each round's table is written to the shared folder.
    """
    edges = scratch.table(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    count = edges.count()
    while count and not _are_stars(edges, count):
        large = scratch.table(_large_star(edges, scratch), "edges")
        scratch.drop(edges)
        edges = scratch.table(_small_star(large, scratch), "edges")
        scratch.drop(large)
        count = edges.count()
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select("v", "v").distinct())


def _are_stars(edges: DataFrame, count: int) -> bool:
    """Whether every node has one link, to a node without one. Links go to lesser nodes, so that is the
    least of the component. The first look needs no shuffle."""
    onward = small(edges.select(F.col("u").alias("v")), 16 * count)
    if edges.join(onward, "v", "left_semi").limit(1).count():
        return False
    return not edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node links its larger neighbours to its least one."""
    both = edges.union(edges.select("v", "u"))
    # A table of its own, so that the join can split a node with many links.
    least = scratch.table(
        both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least"
    )
    joined = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node links its smaller neighbours and itself to the least of them."""
    least = scratch.table(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = edges.join(least, "u").filter(F.col("v") != F.col("m"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    ).distinct()
