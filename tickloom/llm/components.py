"""Connected components as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import forget, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (two long columns ``a`` and ``b``).

    The component is the smallest node that can be reached. Large-star and small-star steps alternate
    until the edges stay the same, a number of rounds that grows with the logarithm of the longest
    path. Minima combine on the map side; in the joins one side has a row per node, so that adaptive
    execution splits a hub. Each round is written to the shared folder and replaces the one before. Edges with a null or from a
    node to itself give no node; repeated edges change nothing.
    """
    now = written(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.expr("sum(CAST(xxhash64(a, b) AS DECIMAL(38,0)))")).first()
        if state == seen or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
        seen = state
        before, now = now, written(_small_star(_large_star(now)).where("a <> b").distinct(), "edges")
        forget(before)
