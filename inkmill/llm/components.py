"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm import common


def _to_least(rows: DataFrame) -> DataFrame:
    """Rows (u, v) with m, the least of u and its neighbours.

    The least neighbour is a partial aggregation before any shuffle; a hub's rows get it from a broadcast, not in one task.
    """
    least = common.cut(rows.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")), "least")
    return common.join_counted(rows, least, ["u"], "n")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u long, v long); the component is its least node.

    Each step is an aggregation to a least neighbour and an equi-join that is split at hubs; each round is a table in
    the shared folder, and takes the place of the one before.  Loops and repeated edges are allowed; a node whose edges are
    all loops, or null, has no row; an empty table gives an empty table.
    """
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = common.cut(e, "edges")
    before = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return _stars(e)
        before = now
        both = e.union(e.select("v", "u"))
        large = _to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = common.cut(large, "edges")
        small = _to_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        last, e = e, common.cut(small.filter("u <> v").distinct(), "edges")
        common.drop(last)
        common.drop(large)


def _stars(e: DataFrame) -> DataFrame:
    """Converged edges all point from a node to its component's least node."""
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
