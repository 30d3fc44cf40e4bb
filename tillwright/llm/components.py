"""Connected components by alternating large-star and small-star steps over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import written


def packed(frame: DataFrame, label: str) -> DataFrame:
    """`written` by a few tasks per core: for tables that are small against the corpus and written many times.
    Each task goes through its shuffle partitions one after another, so it needs no more memory for them."""
    return written(frame.coalesce(4 * frame.sparkSession.sparkContext.defaultParallelism), label)


def _nearest(edges: DataFrame) -> DataFrame:
    """Smallest node among each node and its neighbours. Written, so that Spark can split a hot node's join."""
    return packed(edges.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u")), "nearest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours are hung onto the smallest node around each node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return packed(hung.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours, and the node itself, are hung onto the smallest node around it."""
    nearest = _nearest(edges)
    hung = edges.join(nearest, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return packed(hung.unionByName(nearest.select("u", F.col("low").alias("v"))).distinct(), "small-star")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs onto one other node that itself hangs onto none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"))
    )
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.min("hangs").alias("low"))
    return nodes.where("hangs > 1 OR (hangs = 1 AND low = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """`u`, `v` for each node that is not the smallest of its component, with `v` the smallest.

    `edges` holds bigint columns `u > v` in any number of copies. The number of rounds grows with the logarithm
    of the number of nodes; the driver learns only whether a round was the last.
    """
    state = packed(edges.select("u", "v").distinct(), "edges")
    while not _are_stars(state):
        state = _small_star(_large_star(state))
    return state
