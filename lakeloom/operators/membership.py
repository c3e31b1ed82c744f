"""Set membership of keys across several frames in one shuffle.

INTERSECT, EXCEPT, EXISTS-OR, NOT EXISTS and overlap counts all ask in which of
several inputs a key occurs. Tagging the rows, uniting them and aggregating one
flag per input answers it in a single exchange with map-side partials, whatever
the number of copies of a key. NULL keys equal each other, as in set
operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def occurrence_flags(df: DataFrame, keys: Sequence[str], conditions: dict[str, Column]) -> DataFrame:
    """One row per key with one boolean per condition: true if any row meets it."""
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in conditions.items()])


def membership(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per distinct key, one boolean per input."""
    tagged = None
    for name, df in frames.items():
        part = df.select(*keys).withColumn("_src", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    return occurrence_flags(tagged, keys, {n: F.col("_src") == n for n in frames})


def in_all(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """INTERSECT DISTINCT of all inputs."""
    flags = membership(frames, keys)
    for n in frames:
        flags = flags.filter(F.col(n))
    return flags.select(*keys)


def in_first_only(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """First input EXCEPT DISTINCT all others."""
    first, *others = frames
    flags = membership(frames, keys).filter(F.col(first))
    for n in others:
        flags = flags.filter(~F.col(n))
    return flags.select(*keys)


def overlap_counts(flags: DataFrame, left: str, right: str) -> DataFrame:
    """Keys with the left flag only, the right flag only and both, as one row."""
    a, b = F.col(left), F.col(right)
    return flags.agg(F.count_if(a & ~b).alias("left_only"), F.count_if(~a & b).alias("right_only"),
                     F.count_if(a & b).alias("both"))
