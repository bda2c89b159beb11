"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.llm.storage import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on (u, v): neighbours of each node are tied to the smallest of them.

    Minima are combined before their shuffle, and the join back is one AQE splits, so a node with very
    many neighbours is no single task.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter("v < u")
    lowest = near.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    tied = near.join(lowest, "u")
    if large:
        out = tied.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            lowest.select("u", F.col("low").alias("v"))
        )
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b). Eager, in rounds.

    Large and small stars take turns; the rounds grow with the logarithm of the longest path.
    """
    now = scratch.store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    last = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == last or not mark[0]:
            break
        last = mark
        new = scratch.store(_star(_star(now, large=True), large=False))
        scratch.drop(now)
        now = new
    # every edge now leads from a node to the smallest node of its component
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
