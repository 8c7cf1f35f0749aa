"""Connected components of a graph given as edges, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.runs import checkpointed


def _linked_to_least(neighbours: DataFrame) -> DataFrame:
    """Adds to every (u, v) the least of u and all its v.

    The minima build on partial minima. They are written before they join back, so the join sees
    plain rows on both sides and can split a node with very many neighbours.
    """
    least = neighbours.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    return neighbours.join(checkpointed(least), "u")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that has an edge.

    ``edges`` has u and v of any orderable type; direction, repeats, loops and rows with nulls do
    not matter. Every round's edges lie in the checkpoint folder; the number of rounds grows with
    the logarithm of the longest path, squared at most.
    """
    ends = edges.select("u", "v").filter("u is not null and v is not null")
    now = checkpointed(
        ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _linked_to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        loops = now.filter("u = v")
        down = large.unionByName(loops).distinct()
        near = _linked_to_least(down)
        small = near.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            near.select("u", F.col("least").alias("v"))
        )
        now = checkpointed(small.distinct())
        before, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
