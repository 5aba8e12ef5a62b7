"""Connected components by alternating large-star and small-star steps, each a grouped minimum.

State is only a table of edges; every round is written to the shared folder, so lineage stays short and a lost
executor re-reads files. No component or link reaches the driver; a round reports three sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour of a node moves to the node's smallest neighbour (itself included); small: every smaller."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    if large:
        moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # edges point from the larger node a to the smaller b
        moved = both.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge (columns a, b; null ends and loops are ignored)."""
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now = materialize(now, "components")
    state = None
    while True:
        after = materialize(_star(_star(now, True), False), "components")
        sums = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = after
        if tuple(sums) == state:
            break
        state = tuple(sums)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
