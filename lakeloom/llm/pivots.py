"""Near-duplicate embeddings by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest reference points, in order. Each
pair of them is an inverted list; two vectors that share two or more pivots meet in
the lists of their shared pairs, and the shared pivots are counted. Every meeting of
vectors with equal labels and at least ``SHARED`` common pivots is verified by its
cosine in double precision.

* Vectors that are equal in all components form one class first, with its size.
* Lists are cut into blocks; a task compares two blocks at a time by one matrix
  product. A pair that meets in several lists counts in the first of them only, so
  links are counted without writing pairs down.
* A task writes one row per linked vector: how many vectors it is linked with there,
  and a tree edge to the smallest vector connected with it in the two blocks.

The pivots are ``PIVOTS`` vectors spread over a hash sample of ``SAMPLE`` different vectors;
every vector is indexed. Recall against brute force is measured in the tests. At a
cosine of 0.98 a similarity to a pivot moves by a fifth of its spread at most, so two
of six nearest pivots stay the same in all but a few pairs in ten thousand."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.tables import hash_sample, runs_of, table, written

COSINE = 0.98
PIVOTS = 128
SAMPLE = 4096
NEAREST = 6
SHARED = 2
BLOCK = 512            # vectors of a list compared with as many at once


def usable() -> Column:
    """Whether a row can link: it has a label, an id, and an embedding of finite
    components that are not all zero."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & ~F.coalesce(odd, F.lit(True)) & F.coalesce(some, F.lit(False)))


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that neither very
    large nor very small components overflow."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Per dimension, unit vectors far from each other, from at most ``sample`` rows
    (by hash of the id)."""
    rows = hash_sample(vectors.select("first", "embedding"), sample, "first", "embedding")
    by_size: dict[int, list] = {}
    for row in rows.select("embedding").collect():
        by_size.setdefault(len(row[0]), []).append(row[0])
    found = {}
    for size, listed in by_size.items():
        unit = _unit(np.array(listed, np.float64))
        chosen, near = [0], unit @ unit[0]
        while len(chosen) < min(pivots, len(unit)):
            chosen.append(int(near.argmin()))
            near = np.maximum(near, unit @ unit[chosen[-1]])
        found[size] = unit[chosen]
    return found


def _describe(shared, kind):
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                raw = np.array([vectors[i].as_py() for i in at], kind)
                unit = _unit(raw)
                pivots = shared.value.get(int(size))
                nearest = np.zeros((len(at), NEAREST), np.int32) - np.arange(1, NEAREST + 1, dtype=np.int32)
                if pivots is not None:
                    order = np.argsort(-(unit @ pivots.T), axis=1, kind="stable")[:, :NEAREST]
                    nearest[:, : order.shape[1]] = order
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([v.tobytes() for v in raw], pa.binary()),
                     pa.array(nearest.tolist(), pa.list_(pa.int32())), part.column(3)],
                    names=["class", "label", "vector", "nearest", "copies"])

    return described


def _smallest_linked(adjacent: np.ndarray) -> np.ndarray:
    """Position of the first vector connected with each, over a symmetric matrix."""
    lowest = np.arange(len(adjacent))
    while True:
        reach = np.where(adjacent, lowest[None, :], len(adjacent)).min(axis=1)
        new = np.minimum(lowest, reach)
        new = new[new]
        if (new == lowest).all():
            return lowest
        lowest = new


def _verifier(kind):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows (label, size, list, low, high, block, class, vector, nearest, copies)."""
        out: list[list] = [[], [], []]

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["class", "links", "root"])
            for x in out:
                x.clear()
            return batch

        for (_, _, key, low, high), group in runs_of(batches, ["label", "size", "list", "low", "high"]):
            if group.num_rows < 2:
                continue
            ids = np.array(group.column("class"))
            unit = _unit(np.stack([np.frombuffer(v.as_buffer(), kind) for v in group.column("vector")]))
            linked = unit @ unit.T >= COSINE
            np.fill_diagonal(linked, False)
            if low != high:
                block = np.array(group.column("block"))
                linked &= block[:, None] != block[None, :]
            one, two = np.nonzero(linked)
            if not len(one):
                continue
            nearest = np.array(group.column("nearest").to_pylist(), np.int32)
            copies = np.array(group.column("copies"))
            # shared pivots of the linked pairs; the first list they share counts them
            common = (nearest[one][:, :, None] == nearest[two][:, None, :]).any(axis=2)
            shared = np.sort(np.where(common, nearest[one], np.iinfo(np.int32).max), axis=1)
            counted = (common.sum(axis=1) >= SHARED) & (shared[:, 0] * PIVOTS + shared[:, 1] == key)
            links = np.bincount(one, copies[two] * counted, len(ids)).astype(np.int64)
            first = _smallest_linked(linked)
            touched = np.flatnonzero(linked.any(axis=1))
            out[0].extend(ids[touched].tolist())
            out[1].extend(links[touched].tolist())
            out[2].extend(ids[first[touched]].tolist())
            if len(out[0]) > 50_000:
                yield rows()
        yield rows()

    return verify


def near_links(classes: DataFrame, pivots: dict[int, np.ndarray], block: int = BLOCK) -> DataFrame:
    """Rows (class, links, root) of linked classes, from (class, label, embedding,
    copies)."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)
    kind = np.float32 if classes.schema["embedding"].dataType.elementType.simpleString() == "float" else np.float64
    label = classes.schema["label"].dataType.simpleString()
    described = written(classes.select("class", "label", "embedding", "copies").mapInArrow(
        _describe(shared, kind), f"class bigint, label {label}, vector binary, nearest array<int>, copies bigint"),
        "described").withColumn("size", F.length("vector"))
    place = [F.get("nearest", F.lit(i)) for i in range(NEAREST)]
    lists = F.array(*[F.least(place[i], place[j]) * PIVOTS + F.greatest(place[i], place[j])
                      for i, j in combinations(range(NEAREST), 2)])
    postings = described.select("label", "size", F.explode(lists).alias("list"))
    sizes = written(postings.groupBy("label", "size", "list").agg(F.count("*").alias("_n")).where("_n > 1")
                    .select("label", "size", "list", F.ceil(F.col("_n") / block).cast("int").alias("blocks")), "lists")
    keys = ["label", "size", "list", "low", "high"]
    dealt = (described.select("*", F.explode(lists).alias("list")).join(sizes, ["label", "size", "list"])
             .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "_other")).withColumn("high", F.greatest("block", "_other"))
             .select(*keys, "block", "class", "vector", "nearest", "copies"))
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "class").mapInArrow(
        _verifier(kind), "class bigint, links bigint, root bigint")


def near_duplicates(vectors: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept.

    Vectors that are null, empty, zero or have a null or non-finite component, and rows
    without label or id, link with nothing. Vectors of different length do not link.
    Repeated rows link with each other as other equal vectors do. A null id has a null
    component and is kept. Other columns are not read; an empty table gives no rows."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    classes = written(rows.where(usable()).groupBy("label", "embedding")
                      .agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
                      .withColumn("class", F.monotonically_increasing_id()), "classes")
    found = written(near_links(classes, choose_pivots(classes, pivots)), "links")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    group = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    placed = (classes.join(links, "class", "left").join(group, classes["class"] == group["node"], "left")
              .withColumn("component", F.coalesce("component", "class"))
              .select("label", "embedding", "first", "component",
                      (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    placed = written(placed, "placed")
    lowest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classed = written(placed.join(lowest, "component").select(
        F.col("label").alias("_label"), F.col("embedding").alias("_embedding"), "n_links", "component_id"), "classed")
    own = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")) & F.col("vec_id").isNotNull()
    return (rows.join(classed, own, "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op7_pivots(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
