"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.plans.lineage import cut

ROUNDS = 60


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over (u, v) with u > v. large: every larger neighbour of a node is tied to
    the node's smallest neighbour; small: every smaller one and the node itself."""
    if small:
        around = edges
    else:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join below is one of two plain exchanges, which adaptive execution
    # can split where a node has very many neighbours
    least = cut(around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    tied = around.join(least, "u")
    if small:
        moved = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u"), F.col("m")))
    else:
        moved = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges(a, b): the smallest node it is connected
    with. Nodes are longs; the number of rounds grows with the logarithm of the longest
    path. Each round is written, so a lost executor costs a round at most."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).distinct())
    before = None
    for _ in range(ROUNDS):
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark["n"] == 0 or tuple(mark) == before:
            break
        before = tuple(mark)
        now = cut(_star(_star(now, small=False), small=True))
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
