"""Connected components of a distributed edge list by alternating large-star and
small-star steps. Edges, nodes and labels stay in Spark; each step is written to the
shared folder, so a lost executor costs one step at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.tables import written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _nearest(edges: DataFrame, key: str, other: str) -> DataFrame:
    """Smallest node next to each ``key``, itself included. Written, so that the join
    with the edges has two plain shuffles and a hub is split over tasks."""
    return written(edges.groupBy(F.col(key).alias("_key")).agg(F.least(F.col("_key"), F.min(other)).alias("_low")), "low")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node
    reachable. Loops and repeated edges are ignored; no edges give no rows."""
    current = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    before = _signature(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _nearest(both, "a", "b")
        large = written(both.where("b > a").join(low, both["a"] == low["_key"])
                        .select(F.col("b").alias("a"), F.col("_low").alias("b")).distinct(), "large")
        low = _nearest(large, "a", "b")
        moved = (large.join(low, large["a"] == low["_key"]).where("b <> _low")
                 .select(F.col("b").alias("a"), F.col("_low").alias("b")))
        current = written(moved.unionByName(low.select(F.col("_key").alias("a"), F.col("_low").alias("b"))).distinct(),
                          "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
