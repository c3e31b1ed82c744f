"""Result checks: order-insensitive fingerprints and table differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.normalize import HASH_WORDS, normalized, row_hash
from lakeloom.sources.frames import written_once


def normalize(df: DataFrame) -> DataFrame:
    """Every cell in engine-neutral text form."""
    return df.select([normalized(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def _hashed(df: DataFrame, algorithm: str, keys: Sequence[str] = ()) -> tuple[DataFrame, list[Column]]:
    """Rows as their hash words, and the aggregates over them."""
    words = [c.alias(f"_w{i}") for i, c in enumerate(row_hash(df, algorithm))]
    sums = [F.sum(F.col(f"_w{i}").cast("decimal(38,0)")).alias(f"hash_sum_{i}") for i in range(HASH_WORDS)]
    xors = [F.bit_xor(f"_w{i}").alias(f"hash_xor_{i}") for i in range(HASH_WORDS)]
    return df.select(*keys, *words), [F.count(F.lit(1)).alias("row_count"), *sums, *xors]


def fingerprint(df: DataFrame, algorithm: str = "md5") -> DataFrame:
    """Row count, and the sum and xor of each 32-bit word of the 128-bit row hash, as
    one row: one pass with map-side partials, no sort and nothing collected. The sums
    are exact (decimal)."""
    rows, totals = _hashed(df, algorithm)
    return rows.agg(*totals)


def grouped_fingerprint(df: DataFrame, keys: Sequence[str], algorithm: str = "md5") -> DataFrame:
    """Fingerprint per key, to find where two tables differ."""
    rows, totals = _hashed(df, algorithm, keys)
    return rows.groupBy(*keys).agg(*totals)


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, after normalisation (columns by
    position). Equal copies cancel out map-side."""
    cols = left.columns
    l_norm = normalize(left).select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    r_norm = normalize(right).toDF(*cols).select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    return (l_norm.unionByName(r_norm).groupBy(*cols)
            .agg(F.sum("_l").alias("left_copies"), F.sum("_r").alias("right_copies"))
            .filter(F.col("left_copies") != F.col("right_copies")))


LEAVES, FAN = 4096, 16


def key_leaf(df: DataFrame, keys: Sequence[str], leaves: int = LEAVES) -> Column:
    """The leaf of a row: equal keys, after normalisation, are in one leaf."""
    return F.pmod(F.xxhash64(*[normalized(k, df.schema[k].dataType) for k in keys]), F.lit(leaves))


def hash_tree(df: DataFrame, leaf: Column, leaves: int = LEAVES, fan: int = FAN, algorithm: str = "md5",
              columns: Sequence[str] | None = None) -> DataFrame:
    """Fingerprints per leaf and per node above, down from one root: level, node and the
    columns of `fingerprint`; written once. Rows are read for the leaves alone; a node's
    sums and counts are those of the ``fan`` nodes below added up, its xors theirs xored.
    ``leaf`` is 0 to ``leaves`` - 1; ``columns`` are those that count (default: all)."""
    words = row_hash(df.select(*(columns or df.columns)), algorithm)
    rows = df.select(leaf.cast("bigint").alias("node"), *[w.alias(f"_w{i}") for i, w in enumerate(words)])
    sums = [F.sum(F.col(f"_w{i}").cast("decimal(38,0)")).alias(f"hash_sum_{i}") for i in range(HASH_WORDS)]
    xors = [F.bit_xor(f"_w{i}").alias(f"hash_xor_{i}") for i in range(HASH_WORDS)]
    level = written_once(rows.groupBy("node").agg(F.count(F.lit(1)).alias("row_count"), *sums, *xors), "leaves")
    depth = _depth(leaves, fan)
    tree = level.withColumn("level", F.lit(depth))
    for up in range(1, depth + 1):
        node = F.floor(F.col("node") / fan**up).alias("node")
        above = level.groupBy(node).agg(
            F.sum("row_count").alias("row_count"),
            *[F.sum(f"hash_sum_{i}").cast("decimal(38,0)").alias(f"hash_sum_{i}") for i in range(HASH_WORDS)],
            *[F.bit_xor(f"hash_xor_{i}").alias(f"hash_xor_{i}") for i in range(HASH_WORDS)])
        tree = tree.unionByName(above.withColumn("level", F.lit(depth - up)))
    return written_once(tree.repartition("level"), "tree")


def _depth(leaves: int, fan: int) -> int:
    depth = 0
    while fan**depth < leaves:
        depth += 1
    return depth


def differing_leaves(left: DataFrame, right: DataFrame, leaves: int = LEAVES, fan: int = FAN) -> list[int]:
    """Leaves in which two trees differ, found from the root down: on each level only the
    nodes below differing ones are looked at. There are at most ``leaves`` of them."""
    open_nodes = [0]
    for level in range(_depth(leaves, fan) + 1):
        here = F.col("level") == level
        wanted = here & F.floor(F.col("node") / fan).isin(open_nodes) if level else here
        a, b = left.filter(wanted), right.filter(wanted)
        open_nodes = sorted(r[0] for r in a.exceptAll(b).unionByName(b.exceptAll(a)).select("node").distinct().collect())
        if not open_nodes:
            break
    return open_nodes


def tree_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], leaves: int = LEAVES, fan: int = FAN,
              leaf: str | None = None, algorithm: str = "md5") -> DataFrame:
    """`table_diff` that compares rows only where the trees of the two tables differ.

    With ``leaf``, a column of both tables that holds each row's leaf and is no part of the
    comparison, and by which the tables are stored, only the folders of differing leaves are
    read (``upsert.store`` writes such a column). Else leaves follow from ``keys``."""
    found, rows = [], []
    for df in (left, right):
        place = F.col(leaf) if leaf else key_leaf(df, keys, leaves)
        rows.append((df, place, [c for c in df.columns if c != leaf]))
        found.append(hash_tree(df, place, leaves, fan, algorithm, rows[-1][2]))
    open_leaves = differing_leaves(*found, leaves, fan)
    return table_diff(*[df.filter(place.isin(open_leaves)).select(names) for df, place, names in rows])


def count_rows(df: DataFrame) -> DataFrame:
    """Row count of any query, as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))
