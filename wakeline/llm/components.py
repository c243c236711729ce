"""Connected components of an edge table, by contracting edges until none is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import dropped, kept


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of an edge ``a, b``: the smallest node reachable.

    Every node moves to the smallest of itself and its neighbours, and the edges with it; those
    that then join a node to itself are gone. A hub's edges are reduced before they are shuffled.
    Every round is written, so that it is not worked out again, and the one before it dropped.
    """
    edges = kept(edges.select("a", "b").where("a <> b").distinct())
    ends = F.explode(F.array("a", "b")).alias("node")
    labels, old = edges.select(ends).distinct().withColumn("component", F.col("node")), []
    while not edges.isEmpty():
        both = edges.select(
            F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        )
        moves = both.groupBy("a").agg(F.min("b").alias("least"))
        near = kept(moves.select(F.col("a").alias("old"), F.least("a", "least").alias("new")))
        again = near.select(F.col("old").alias("new"), F.col("new").alias("newer"))
        moves = kept(near.join(again, "new").select("old", F.col("newer").alias("new")))
        labels = kept(
            labels.join(moves, F.col("component") == F.col("old"), "left").select(
                "node", F.coalesce("new", "component").alias("component")
            )
        )
        left = moves.select(F.col("old").alias("a"), F.col("new").alias("x"))
        right = moves.select(F.col("old").alias("b"), F.col("new").alias("y"))
        moved = edges.join(left, "a").join(right, "b").where("x <> y")
        old += [near, moves, edges]
        edges = kept(
            moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        dropped(*old)
        old = [labels]
    return labels
