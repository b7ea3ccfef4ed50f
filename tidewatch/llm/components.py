"""Connected components of an undirected graph, as joins and aggregations.

Alternating large-star and small-star steps: every node is re-linked to the
smallest node it can see until the edges are a forest of stars.  Every step
is written to the shared folder, so a lost executor costs one step, and both
sides of each join are plain shuffles that adaptive execution splits when a
hub has very many neighbours.  Nothing about single nodes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import written


def _is_star_forest(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, and no node is both a leaf and a centre."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up > 1 or (up > 0 and down > 0)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node that has an edge.

    Loops, repeated edges and null ends are allowed and ignored.
    """
    e = written(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if _is_star_forest(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select("v", "v").distinct())
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m"))
                      .select("u", F.least("u", "m").alias("m")), "large-star-min")
        large = written(both.filter("v > u").join(low, "u")
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                        "large-star")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "small-star-min")
        e = written(large.join(low, "u").filter("v > m").select(F.col("v").alias("u"),
                                                                F.col("m").alias("v"))
                    .union(low.select("u", "m")).distinct(), "small-star")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
