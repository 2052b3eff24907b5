"""Connected components of a link table, as repeated joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.spark_io import delete, written


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One step of alternating stars: hang neighbours below the smallest one.

    `edges` holds (a, b) with a > b. The larger step moves the larger neighbours of
    every node, the other one the smaller neighbours.
    """
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    near = both.join(least, "a")
    if larger:
        root = F.least("a", "least")
        moved = near.where("b > a").select(F.col("b").alias("a"), root.alias("b"))
    else:
        hung = near.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = hung.unionByName(least.select("a", F.col("least").alias("b")))
    moved = moved.where("a != b")
    # Repeats that the larger step leaves go with those of the other one.
    return moved if larger else moved.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs below one other that hangs below none, (a, b) with a > b."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"))
    )
    # A node that hangs below one and has nothing below it occurs once, a root never as `a`.
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return nodes.where("up > 0 and n > 1").isEmpty()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Alternating large and small stars need about log(nodes) rounds whatever the
    shape. A node with very many links is counted by partial aggregates, and its
    join partition is split by adaptive execution. Links with a null end and links
    of a node to itself are left out; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    a, b = F.col(left), F.col(right)
    start = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    )
    current = written(start.distinct(), "links")
    while not _settled(current):
        following = written(_stars(_stars(current, True), False), "links")
        delete(spark, current)
        current = following
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
