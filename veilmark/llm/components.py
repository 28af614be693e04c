"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilmark.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = _both_ways(edges)
    least = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("least"))
    least = least.select("n", F.least("n", "least").alias("least"))
    linked = both.where("v > u").join(least, F.col("u") == F.col("n"))
    return linked.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least."""
    least = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("least"))
    linked = edges.join(least, F.col("u") == F.col("n"))
    near = linked.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v")
    own = least.select(F.col("n").alias("u"), F.col("least").alias("v"))
    return near.union(own).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
    ).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component.

    ``edges`` has the long columns ``u`` and ``v``; loops are ignored and nodes
    without an edge to another do not appear. Each round is written to the shared
    folder, so a lost executor costs one round at most; the number of rounds grows
    with the logarithm of the number of nodes.
    """
    edges = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = stored(edges.distinct(), "edges")
    mark = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
