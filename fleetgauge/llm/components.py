"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetgauge.llm.common import dropped, staged


def _joined(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each edge with the least neighbour of its first end. `least` is staged: its size is known to the join strategy, and
    the join can split a hub's edges, which it could not do below an aggregate."""
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(u, v) % 1000003)")).first())


def connected_components(edges: DataFrame, first: str = "u", second: str = "v") -> DataFrame:
    """(node, root): the least node of each component, for every node that has an edge to another.

    Null ends and loops are ignored, repeated edges count once, an empty table gives an empty table. Every round writes
    a table of at most as many edges as it read; the number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.select(
        F.greatest(first, second).alias("u"), F.least(first, second).alias("v")
    ).where("u <> v").distinct()
    edges = staged(edges)
    before = _checksum(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = staged(_joined(both.where("v > u"), least).distinct())
        dropped(edges), dropped(least)
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")))
        edges = staged(_joined(large, least).union(least.select("u", F.col("m").alias("v"))).distinct())
        dropped(large), dropped(least)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
