"""Connected components by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import kept, small


# The least neighbours are kept before they are joined: few are broadcast, so that the edges stay where they are; many meet
# the edges in a join that adaptive execution splits where one node has most of them, which it can't do if the
# least ones are found in the same stage.
def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = small(kept(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` lead from the larger to the smaller node."""
    least = small(kept(edges.groupBy("a").agg(F.min("b").alias("least"))))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long): root is the least node of the node's component.

    Loops, repeated edges and either direction are fine; no edges give no rows. A round keeps at most as many edges as it
    got, and rounds grow with the logarithm of the longest path. Nothing is gathered but a count and a checksum.
    """
    now = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        large = kept(_large_star(now).where("a <> b").distinct())
        now = kept(_small_star(large).where("a <> b").distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
