"""Connected components of an edge table by large-star and small-star rounds.

Every round is two groupings and two joins over edges; nothing is gathered per component
and nothing comes to the driver but a count and a checksum. A node with a third of all
edges is folded map-side to one minimum; the join that spreads it is one that Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecat.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of each node (the larger, or the smaller ones) to its least neighbour."""
    if large:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = seen.groupBy("u").agg(F.min("v").alias("_least"))
    least = least.select(F.col("u").alias("_u"), F.least("_least", "u").alias("least"))
    near = seen.join(least, F.col("u") == F.col("_u"))
    moved = near.filter("v > u" if large else "v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    if not large:
        moved = moved.unionByName(least.select(F.col("_u").alias("u"), F.col("least").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) for every node of edges u, v (longs); rounds until nothing changes."""
    now = materialise(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = materialise(_star(_star(now, True), False), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
