"""Connected components of an edge table, by alternating stars; nothing is gathered per component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``a``-``b`` edges.

    Large star: each node hands its smallest neighbour to its larger ones. Small star: it hands it to its
    smaller ones and itself. Edges end up pointing at the smallest node of their component. Smallest
    neighbours are written before they are joined, so the join has an exchange on both sides and the edges of
    one node may be split over tasks.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")))
        large = scratch.write(both.join(least, "a").where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        current = scratch.write(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        # Done when every edge points at a node that points at nothing: one edge a node, none at a node with one.
        ends = current.select("a", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            current.select(F.col("b").alias("a"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        open_ = ends.groupBy("a").agg(F.sum("out").alias("out"), F.sum("into").alias("into")).where(
            "out > 1 or (out = 1 and into > 0)")
        if open_.isEmpty():
            break
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
