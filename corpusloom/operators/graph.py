"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """`node, component` with `component` the least node of each component. Isolated nodes don't occur.

    Each step is one shuffle; every node's neighbourhood is reduced by aggregation and joined back, never
    collected into one row, so a hub of any degree is fine. Rounds grow with the logarithm of the diameter
    and end when nothing changes.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = cut(e)
    before = None
    while True:
        # large star: every larger neighbour is linked to the least of the neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours and the node itself are linked to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e2 = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(e2.unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
