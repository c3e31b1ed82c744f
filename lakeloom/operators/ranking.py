"""rank() without one task per group.

``rank`` of a row is one more than the number of rows of its group that sort
before it. Both operators therefore work on counts per distinct value, which
are pre-aggregated map-side, and join the rank back by value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeloom.sources.frames import written_once


def _directed(name: str, ascending: bool):
    c = F.col(name)
    return c.asc_nulls_last() if ascending else c.desc_nulls_last()


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """All rows with their number in ``order``, from 1 on, as ``row_number()`` over one
    window would give them, for any type of values and any number of equal ones.

    Rows are sorted in ranges; equal rows are told apart by a hash and a number of their
    own, so a value that many rows share is cut as well. The number of a row is its place
    in its range plus the rows of the ranges before, of which there are as many as shuffle
    partitions. The rows are written once; among equal ones the numbering is arbitrary."""
    spark = df.sparkSession
    own = df.withColumns({"_spread": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "_own": F.monotonically_increasing_id()})
    by = [*order, F.desc("_spread"), F.desc("_own")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_ = (own.repartitionByRange(ranges, *by).sortWithinPartitions(*by).drop("_spread", "_own")
               .withColumns({"_range": F.spark_partition_id(), "_place": place}))
    held = written_once(sorted_, "numbered")
    before, offsets = 0, []
    for row in held.groupBy("_range").count().orderBy("_range").collect():
        offsets.append((row["_range"], before))
        before += row["count"]
    starts = spark.createDataFrame(offsets, "_range int, _before bigint")
    return (held.join(starts, "_range").withColumn(name, F.col("_before") + F.col("_place") + 1)
            .drop("_range", "_place", "_before"))


def top_ranked(df: DataFrame, partition: Sequence[str], value: str, k: int,
               ascending: bool = False, name: str = "rnk") -> DataFrame:
    """All rows with rank() <= k in their group, ties included.

    The first k rows of a group by ``row_number()`` show every qualifying value
    and its rank. Catalyst prunes that list to k rows per group and task before
    the shuffle; the rows themselves are found again by value, so rows that tie
    are never gathered."""
    part = list(partition)
    w = Window.partitionBy(*part).orderBy(_directed(value, ascending))
    first = (df.select(*part, value).withColumns({"_rn": F.row_number().over(w), name: F.rank().over(w).cast("bigint")})
             .filter(F.col("_rn") <= k).groupBy(*part, value).agg(F.first(name).alias(name)))
    return _join_back(df, first, part + [value], name)


def value_ranks(df: DataFrame, partition: Sequence[str], value: str, ascending: bool = False,
                name: str = "rnk") -> DataFrame:
    """The rank() of every distinct value of a group, one row per value."""
    counts = df.groupBy(*partition, value).agg(F.count(F.lit(1)).alias("_n"))
    return ranks_of_counts(counts, partition, value, ascending, name).drop("_n", "_total")


def ranks_of_counts(counts: DataFrame, partition: Sequence[str], value: str, ascending: bool = False,
                    name: str = "rnk") -> DataFrame:
    """``counts`` (one row per group and value, with its rows as ``_n``) with the rank of
    each value, for any type that sorts, and the rows of its group as ``_total``.

    The values are dealt once in ranges of (group, value), as even as their own
    distribution makes them, and written with the number of their range. A rank is the count
    in the group's ranges before plus the count before it in its range: two windows, over
    as many rows as there are ranges, and over the rows of one range."""
    part = list(partition)
    ranges = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = written_once(counts.select(*part, value, "_n").repartitionByRange(ranges, *part, _directed(value, ascending))
                        .withColumn("_b", F.spark_partition_id()), "counts")
    per_range = held.groupBy(*part, "_b").agg(F.sum("_n").alias("_bn"))
    earlier = F.sum("_bn").over(Window.partitionBy(*part).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_range.withColumns({"_off": F.coalesce(earlier, F.lit(0)), "_total": F.sum("_bn").over(Window.partitionBy(*part))})
    inside = Window.partitionBy(*part, "_b").orderBy(_directed(value, ascending)).rowsBetween(Window.unboundedPreceding, -1)
    local = held.withColumn("_loc", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    values = _join_back(local, offsets, part + ["_b"], "_off", "_total")
    return values.select(*part, value, "_n", "_total", (F.col("_off") + F.col("_loc") + 1).alias(name))


def ranked(df: DataFrame, partition: Sequence[str], value: str, ascending: bool = False,
           name: str = "rnk") -> DataFrame:
    """rank() over (partition by ... order by value) for groups of any size."""
    ranks = value_ranks(df, partition, value, ascending, name)
    return _join_back(df, ranks, [*partition, value], name)


def group_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group, the mean of the two middle values for even counts.
    NULL values are left out. No group's values are gathered: a distinct value
    covers the positions from its rank on."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return median_of_counts(counts, keys, value, name)


def median_of_counts(counts: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """`group_median` from rows (keys, value, _n) with one row per group and value."""
    part = list(keys)
    placed = ranks_of_counts(counts, part, value, ascending=True, name="_rank")

    def at(position):
        covers = (F.col("_rank") <= position) & (position < F.col("_rank") + F.col("_n"))
        return F.max(F.when(covers, F.col(value)))

    lower, upper = F.floor((F.col("_total") + 1) / 2), F.ceil((F.col("_total") + 1) / 2)
    return placed.groupBy(*part).agg(((at(lower) + at(upper)) / 2).alias(name))


def _join_back(df: DataFrame, right: DataFrame, keys: Sequence[str], *keep: str) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], *keep)
    on = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return df.join(r, on, "inner").drop(*[f"_r{i}" for i in range(len(keys))])
