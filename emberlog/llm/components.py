"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is one aggregation and one join over the edges; nothing is gathered per component or on
the driver. After each round the edges are stored, so lost executors cost one round at most. The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link all larger neighbours of a node, and the node, to its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "node")
    joined = both.filter("b > a").join(least, F.col("a") == F.col("node"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """With edges from larger to smaller nodes: link all smaller neighbours, and the node, to the smallest."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    moved = down.join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to ``node, component``: every node that has an edge, with the smallest node it reaches."""
    def mark(frame: DataFrame):
        return tuple(frame.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first())

    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before, after = None, mark(now)
    while after != before:
        now = stored(_small_star(_large_star(now)))
        before, after = after, mark(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
