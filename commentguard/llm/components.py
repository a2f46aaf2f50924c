"""Connected components of an edge table by alternating large and small stars.

Each round keeps linear-size edges and only groups by node with partial aggregation and joins
on node (AQE can split a hub's rows); rounds are cut by tables written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentguard.llm.common import materialise

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link every larger neighbour to the least one. Small star: likewise the smaller ones and the node itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("node"), F.least("m", "a").alias("m"))
    joined = both.join(least, both["a"] == least["node"])
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Edges (a, b) of any one orderable type -> (node, root): root is the least node reachable.

    Nodes without edges do not appear. An empty table gives an empty result.
    """
    now = materialise(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        now = materialise(_star(_star(now, True), False), name)
        last, mark = mark, _mark(now)
        if tuple(last) == tuple(mark):
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
