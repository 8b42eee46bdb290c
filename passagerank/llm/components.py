"""Connected components of an edge table: alternating large and small stars.

Every round writes its edges to the shared folder, so no lineage grows and a lost executor costs
one round at most.  Edges of a large component meet its smallest node by a join on a
written table, which adaptive execution splits where one node has very many edges.

Edge cases: loops and repeated edges count for nothing; edges with a null end belong to no component; an empty table gives no
rows; columns other than ``u`` and ``v`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagerank.llm.shared import stored


def _with_least(edges: DataFrame) -> DataFrame:
    """``u, v, m``: every edge with the least of ``u`` and its neighbours in ``edges(u, v)``."""
    least = stored(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star-least")
    return edges.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    both = stored(edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v"), "star-both")
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "star-down")
    found = _with_least(down)
    kept = found.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = found.select("u", F.col("m").alias("v"))
    return kept.union(own).filter("u <> v").distinct()


def _mark(edges: DataFrame):
    """What tells two edge tables apart: their count and two sums of hashes."""
    hashed = F.xxhash64("u", "v")
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.pmod(hashed, F.lit(1 << 31))), F.sum(F.shiftrightunsigned(hashed, 33))
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(u, v)``; the component is its least node.

    Nodes are integers.  Loops are ignored; an empty table gives no rows.
    """
    now = stored(edges.select("u", "v").filter("u <> v").distinct(), "star")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small(stored(_large(now), "star-large")), "star")
        after = _mark(now)
        if after == mark:
            break
        mark = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(now.select(F.col("v"), F.col("v")).distinct())
