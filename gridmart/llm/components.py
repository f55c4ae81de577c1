"""Connected components of an edge table by alternating star contractions.

Every round links each node's larger neighbours to its smallest one (large
star), then each node's smaller neighbours to its smallest one (small star);
both are a minimum by node and a join.  The edges become one star for each
component after a number of rounds that grows with the logarithm of the
longest path.  Edges never leave the executors; each round is cut by a
checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v != m") \
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` lead from larger to smaller nodes."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) but the roots
    themselves; the root is the component's smallest node."""
    edges = common.cut(edges.filter("u != v").select(F.greatest("u", "v").alias("u"),
                                                     F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        edges = common.cut(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
