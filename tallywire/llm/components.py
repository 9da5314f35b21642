"""Connected components by alternating large-star and small-star steps, all joins and map-side folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywire.llm.text import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the larger (large star) or the smaller (small star) neighbours of every node at its smallest one."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = near.groupBy("a").agg(F.min("b").alias("_low")).select(F.col("a").alias("_a"), F.least("a", "_low").alias("_low"))
    joined = near.join(low, F.col("a") == F.col("_a"))
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_low").alias("b"))
    else:
        own = low.select(F.col("_a").alias("a"), F.col("_low").alias("b"))
        moved = joined.select(F.col("b").alias("a"), F.col("_low").alias("b")).unionByName(own)
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Every node of an edge with the smallest node it reaches: node, component. Nodes must be comparable.

    The edge table is written after each round, so lineage stays short. Rounds go on until the edges are stars,
    which takes a number of rounds that grows with the logarithm of the nodes.
    """
    now = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a") != F.col("b")), "links")
    state = None
    while True:
        now = written(_star(_star(now, large=True), large=False), "links")
        # stars have settled when neither the number of edges nor the sum over their ends changes
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
