"""Connected components of a link table, by neighbour minima and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node it can reach.

    Large-star and small-star rounds (Kiveris et al., 2014): each node hands its neighbours to the
    smallest one, so a path of n links needs about log n rounds and the link count never grows. Both
    steps only aggregate a minimum per node and join it back; a hub's links are combined before the
    shuffle and adaptive execution splits its side of the join. Nulls and self-links are ignored.
    """
    # Written first: what finds the links runs once.
    both = scratch.keep(links.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna())
    nodes = both.select("a").union(both.select("b")).distinct()
    edges = scratch.keep(_down(both))
    left = None
    while True:
        edges = scratch.keep(_small_star(_large_star(edges)))
        # A fixed point is reached when every edge's lower end is nobody's higher end.
        stats = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("hi", "lo").cast("long")).alias("s")).first()
        if left == (stats["n"], stats["s"]) and edges.join(
            edges.select(F.col("hi").alias("lo")), "lo", "left_semi"
        ).isEmpty():
            break
        left = (stats["n"], stats["s"])
    roots = edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
    return (
        nodes.withColumnRenamed("a", "node")
        .join(roots, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"))
    )


def _down(edges: DataFrame) -> DataFrame:
    return (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    ends = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _down(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("a")).join(least, "u").select("a", F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to its smallest neighbour."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    return _down(
        joined.select(F.col("lo").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("hi").alias("a"), F.col("m").alias("b"))
        )
    )
