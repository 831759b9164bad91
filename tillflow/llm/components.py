"""Connected components of a graph given as edges, by alternating stars.

Every round links each node to the lowest node of its neighbourhood, first for its
higher neighbours, then for its lower ones; components shrink to stars around their
lowest node in a few rounds.  Each round is written to the checkpoint folder.  Only a
count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import settle


def _stars(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("high").alias("x"), F.col("low").alias("y")).unionByName(
        edges.select(F.col("low").alias("x"), F.col("high").alias("y")))
    lowest = both.groupBy("x").agg(F.min("y").alias("m")).select(
        F.col("x").alias("n"), F.least("x", "m").alias("m"))
    large = (both.join(lowest, F.col("x") == F.col("n")).where("y > x")
             .select(F.col("y").alias("high"), F.col("m").alias("low")).distinct())
    lowest = large.groupBy("high").agg(F.min("low").alias("m")).select(F.col("high").alias("n"), "m")
    small = (large.join(lowest, F.col("high") == F.col("n")).where("low <> m")
             .select(F.col("low").alias("high"), F.col("m").alias("low")))
    return small.unionByName(lowest.select(F.col("n").alias("high"), F.col("m").alias("low"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is its lowest node."""
    now = settle(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct())
    state = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
                       .alias("h")).first()
        if (seen["n"], seen["h"]) == state or not seen["n"]:
            break
        state = (seen["n"], seen["h"])
        now = settle(_stars(now))
    own = now.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return own.unionByName(now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
