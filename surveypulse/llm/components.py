"""Connected components by alternating large-star and small-star steps.

Edges are rows (u, v), u <> v. Large-star joins every larger neighbour of a node to the smallest node
of its neighbourhood; small-star joins the node and its smaller neighbours to their smallest. Both
keep the components, and when neither changes an edge, each node hangs on the smallest node of its
component. Smallest neighbours come from an aggregate that is merged before the shuffle and go back
by a join that can be split, so a hub's neighbours are never gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveypulse.llm.common import written


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame) -> DataFrame:
    """``edges`` with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def settled(edges: DataFrame) -> bool:
    """Whether ``edges`` (u > v) are stars: no u has two edges, and no v is a u."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counted = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame, most_steps: int = 50) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    for _ in range(most_steps):
        if settled(now):
            # Each node that is not the smallest has one edge, to the smallest.
            tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
        now = written(small_star(large_star(now)))
    raise RuntimeError(f"components did not settle in {most_steps} steps")
