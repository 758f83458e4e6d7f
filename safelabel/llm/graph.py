"""Connected components on Spark, by alternating large-star and small-star steps.

No adjacency list is gathered: each step takes the smallest neighbour of every node by a
combined aggregate and joins it back to the edges, so a hub costs no more than its edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.store import remove, written


def settled(edges: DataFrame) -> bool:
    """True if every node of ``edges`` (u, v) points to one node at most, and none to a node that points on; one shuffle."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("hit")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("hit").alias("hit")).where("out > 1 or out = 1 and hit = 1").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: long); a component is named by its smallest node.

    Loops and repeated edges change nothing. No edges give no rows.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        if settled(now):
            break
        # Large star: larger neighbours of a node go to its smallest neighbour.
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: smaller neighbours and the node itself go to the smallest.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small, "u")
        last, now = now, written(
            joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
        remove(last)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
