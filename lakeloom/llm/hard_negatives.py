"""Hard negatives by a GNAT-style multiway hyperplane tree, exact.

Scores are integer inner products. A vector x is lifted by one coordinate, so that all
lifted vectors have the same length; a score window of an anchor is then an annulus of
distances around it, in a metric space.

* The tree is fitted on a hash sample of at most ``SAMPLE`` rows: a node has up to
  ``FAN`` split points far from each other, and a vector belongs to the nearest one
  (hyperplanes between them). Every row is indexed.
* A node stores, for each split point and each sibling subtree, the smallest and the
  largest distance from the point to a vector of the subtree, over all rows.
* An anchor at distance D from a split point, looking for vectors between r and R away,
  needs distances between max(D - R, r - D) and D + R from that point. A sibling whose
  range does not meet that interval is left out; the leaves that remain are searched
  whole, in blocks.
* Two searches: the positives (from the fifth best score of the sample up), then, per
  positive, its window of negatives (from the third best of the sample inside it up).

Equal vectors of one label differ by id alone, so the index keeps the first of them
(as many as a search can return, and the anchor itself); no result is lost by that.
Broadcast: tree and sample, of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.tables import hash_sample, runs_of, table, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
SAMPLE = 4096
FAN = 8
LEAF = 2048             # rows of a leaf that the tree aims at
BLOCK = 2048            # rows of a leaf searched at once
ANCHORS = 256           # anchors that search a block at once
LARGEST = 1 << 25       # components from here on take no part: scores must fit a long


def usable() -> Column:
    """Whether a row takes part: it has a label and a vector of finite components."""
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * SCALE >= LARGEST))
    return F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(True))


def quantized(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part, written."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return written(vectors.select("vec_id", "label", "embedding").where(usable())
                   .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"),
                           moved.cast("bigint").alias("label"), v.alias("v")), "quantized")


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :] - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Tree:
    """Nodes of (split points, children); a child below zero is the leaf -1 - child."""
    length: float                                       # of lifted vectors, squared
    nodes: list[tuple[np.ndarray, list[int]]] = field(default_factory=list)
    leaves: int = 0
    low: list[np.ndarray] = field(default_factory=list)   # [split point, child], per node
    high: list[np.ndarray] = field(default_factory=list)

    def lift(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        return np.hstack([v, np.sqrt(np.maximum(self.length - (v * v).sum(axis=1, keepdims=True), 0))])

    @staticmethod
    def lift_query(v: np.ndarray) -> np.ndarray:
        return np.hstack([v, np.zeros((len(v), 1))])

    def grow(self, x: np.ndarray, weight: float, leaf: int = LEAF) -> int:
        """Node or leaf over sample rows ``x``, of which each stands for ``weight`` rows."""
        if len(x) * weight > leaf and len(x) > 2 * FAN:
            fan = min(FAN, max(2, round(len(x) * weight / leaf)))
            chosen, near = [0], _distances(x, x[:1])[:, 0]
            while len(chosen) < fan and near.max() > 0:
                chosen.append(int(near.argmax()))
                near = np.minimum(near, _distances(x, x[chosen[-1:]])[:, 0])
            if len(chosen) > 1:
                points, at = x[chosen], len(self.nodes)
                self.nodes.append((points, []))
                nearest = _distances(x, points).argmin(axis=1)
                children = [self.grow(x[nearest == j], weight, leaf) for j in range(len(points))]
                self.nodes[at] = (points, children)
                return at
        self.leaves += 1
        return -self.leaves

    def place(self, x: np.ndarray, seen: Callable | None = None) -> np.ndarray:
        """Leaf of each lifted vector; ``seen(node, distances, child)`` on the way."""
        leaf, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            node, rows = todo.pop()
            points, children = self.nodes[node]
            away = _distances(x[rows], points)
            child = away.argmin(axis=1)
            if seen:
                seen(node, away, child)
            for j, below in enumerate(children):
                some = rows[child == j]
                if below < 0:
                    leaf[some] = -1 - below
                elif len(some):
                    todo.append((below, some))
        return leaf

    def reached(self, x: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) of the leaves that can hold vectors between ``least`` and
        ``most`` away from lifted queries ``x``."""
        slack = 1e-6 * (1 + np.sqrt(self.length))
        found: list[tuple[np.ndarray, int]] = []
        todo = [(0 if self.nodes else -1, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                found.append((rows, -1 - node))
                continue
            points, children = self.nodes[node]
            away = _distances(x[rows], points)
            low = np.maximum(away - most[rows, None], least[rows, None] - away) - slack
            high = away + most[rows, None] + slack
            meets = ((low[:, :, None] <= self.high[node]) & (high[:, :, None] >= self.low[node])).all(axis=1)
            for j, below in enumerate(children):
                some = rows[meets[:, j]]
                if len(some):
                    todo.append((below, some))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([r for r, _ in found]), np.concatenate([np.full(len(r), leaf) for r, leaf in found])

    def annulus(self, square: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of scores between ``least`` and ``most`` for queries of that squared
        length."""
        return (np.sqrt(np.maximum(square + self.length - 2 * most, 0)), np.sqrt(np.maximum(square + self.length - 2 * least, 0)))


@dataclass
class Index:
    trees: dict[int, Tree]           # by number of components
    sample: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]   # row, label, v


def _by_size(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(components, positions, matrix) of the vectors of a batch."""
    vectors = batch.column(column)
    sizes = np.diff(np.asarray(vectors.offsets))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield int(size), at, np.asarray(vectors.take(pa.array(at)).flatten()).reshape(len(at), size)


def _placer(shared):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value.trees
        for batch in batches:
            leaf, size_of, packed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int32), [b""] * batch.num_rows
            for size, at, v in _by_size(batch, 3):
                size_of[at] = size
                for i, one in zip(at, v.astype(np.int32)):
                    packed[i] = one.tobytes()
                if size in trees:
                    leaf[at] = trees[size].place(trees[size].lift(v))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(size_of), pa.array(leaf)],
                                             names=["row", "vec_id", "label", "v", "size", "leaf"])

    return place


def _unpacked(vectors: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors.to_pylist()), np.int32).reshape(len(vectors), size)


def _ranger(shared):
    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Smallest and largest distance per (size, node, split point, child)."""
        trees, found = shared.value.trees, {}
        for batch in batches:
            size_of = np.asarray(batch.column(0))
            for size in map(int, np.unique(size_of)):
                def seen(node, away, child, size=size):
                    k = away.shape[1]
                    low, high = found.setdefault((size, node), (np.full((k, k), np.inf), np.full((k, k), -np.inf)))
                    for j in np.unique(child):
                        part = away[child == j]
                        low[:, j] = np.minimum(low[:, j], part.min(axis=0))
                        high[:, j] = np.maximum(high[:, j], part.max(axis=0))

                if size in trees:
                    v = _unpacked(batch.column(1).take(pa.array(np.flatnonzero(size_of == size))), size)
                    trees[size].place(trees[size].lift(v), seen)
        rows = [(size, node, i, j, low[i, j], high[i, j]) for (size, node), (low, high) in found.items()
                for i in range(len(low)) for j in range(len(low)) if low[i, j] <= high[i, j]]
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int32()] * 4 + [pa.float64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         names=["size", "node", "point", "child", "low", "high"])

    return ranges


def build_index(rows: DataFrame, sample: int = SAMPLE, leaf: int = LEAF) -> tuple[Index, DataFrame]:
    """The tree with its ranges, and all rows of the index with their leaf, written."""
    spark = rows.sparkSession
    firsts = Window.partitionBy("label", "v").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    kept = written(rows.withColumn("_at", F.row_number().over(firsts)).where(F.col("_at") <= POSITIVES + 1)
                   .drop("_at"), "kept")
    chosen = hash_sample(kept, sample, "row").collect()
    drawn: dict[int, list] = {}
    for r in chosen:
        drawn.setdefault(len(r.v), []).append(r)
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    sizes = [s for s in drawn if s]
    stats = {r[0]: (r[1], r[2]) for r in kept.where(F.size("v").isin(sizes)).groupBy(F.size("v"))
             .agg(F.max(square), F.count("*")).collect()} if sizes else {}
    index = Index({}, {})
    for size, listed in drawn.items():
        v = np.array([r.v for r in listed], np.int64).reshape(len(listed), size)
        index.sample[size] = np.array([r.row for r in listed]), np.array([r.label for r in listed]), v
        if size:
            tree = Tree(float(stats[size][0]))
            tree.grow(tree.lift(v), stats[size][1] / len(v), leaf)
            index.trees[size] = tree
    placed = written(kept.mapInArrow(_placer(spark.sparkContext.broadcast(index)),
                                     "row bigint, vec_id bigint, label bigint, v binary, size int, leaf bigint"), "placed")
    for tree in index.trees.values():
        tree.low = [np.full((len(p), len(p)), np.inf) for p, _ in tree.nodes]
        tree.high = [np.full((len(p), len(p)), -np.inf) for p, _ in tree.nodes]
    ranges = (placed.select("size", "v").mapInArrow(_ranger(spark.sparkContext.broadcast(index)),
                                            "size int, node int, point int, child int, low double, high double")
              .groupBy("size", "node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    for r in ranges.collect():    # at most FAN for each row of the sample
        index.trees[r.size].low[r.node][r.point, r.child] = r.low
        index.trees[r.size].high[r.node][r.point, r.child] = r.high
    return index, placed


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` best allowed scores of each row, ties by column."""
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def _within(scores: np.ndarray, positive: np.ndarray) -> np.ndarray:
    return (50 * positive <= 100 * scores) & (100 * scores <= 95 * positive)


def _targets(shared):
    """From rows (row, vec_id, label, v, scores): leaves to search per anchor. No scores:
    the positives; else the windows of these positive scores, numbered from 0. A window
    comes with the smallest score that can still be among the best."""
    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            row, label = np.asarray(batch.column(0)), np.asarray(batch.column(2))
            listed = batch.column(4).to_pylist()
            at_all, leaf_all, windows, bounds, packed, sizes = [], [], [], [], [], []
            for size, at, v in _by_size(batch, 3):
                known_row, known_label, known = index.sample.get(size, (row[:0], label[:0], v[:0]))
                tree = index.trees.get(size)
                for begin in range(0, len(at), ANCHORS):
                    some, q = at[begin:begin + ANCHORS], v[begin:begin + ANCHORS].astype(np.float64)
                    scores = q @ known.astype(np.float64).T
                    same = label[some][:, None] == known_label[None, :]
                    own = [listed[i] or [] for i in some]
                    which = np.repeat(np.arange(len(some)), [len(x) for x in own]) if any(own) else np.arange(len(some))
                    if any(own):
                        number = np.concatenate([np.arange(len(x)) for x in own]).astype(np.int64)
                        positive = np.array([x for one in own for x in one], np.float64)
                        allowed = ~same[which] & _within(scores[which], positive[:, None])
                        least, most, k = positive / 2, positive * 0.95, NEGATIVES
                    else:
                        number = np.zeros(len(some), np.int64)
                        allowed = same & (row[some][:, None] != known_row[None, :])
                        least, most, k = np.full(len(some), -np.inf), np.full(len(some), np.inf), POSITIVES
                    if scores.shape[1] >= k:
                        bound = np.partition(np.where(allowed, scores[which], -np.inf), -k, axis=1)[:, -k]
                        least = np.maximum(least, bound)
                    open_ = least <= most
                    which, number, least, most = which[open_], number[open_], least[open_], most[open_]
                    if tree is None:
                        query, leaf = np.arange(len(which)), np.zeros(len(which), np.int64)
                    else:
                        inner, outer = tree.annulus((q * q).sum(axis=1)[which], least, most)
                        query, leaf = tree.reached(tree.lift_query(q)[which], inner, outer)
                    # one row per anchor and leaf, with the numbers of the windows
                    order = np.lexsort((number[query], leaf, which[query]))
                    who, leaf, number, least = which[query][order], leaf[order], number[query][order], least[query][order]
                    new = np.flatnonzero(np.diff(who, prepend=-1) | np.diff(leaf, prepend=-1))
                    at_all.extend(some[who[new]].tolist())
                    leaf_all.extend(leaf[new].tolist())
                    raw = [x.tobytes() for x in v[begin:begin + ANCHORS].astype(np.int32)]
                    packed.extend(raw[i] for i in who[new])
                    sizes.extend([size] * len(new))
                    for x, y in zip(new.tolist(), [*new[1:].tolist(), len(who)]):
                        windows.append(number[x:y])
                        bounds.append(least[x:y])
            part = batch.take(pa.array(at_all, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(packed, pa.binary()), part.column(4), pa.array(sizes, pa.int32()), pa.array(leaf_all, pa.int64()),
                 pa.array(windows, pa.list_(pa.int64())), pa.array(bounds, pa.list_(pa.float64()))],
                names=["row", "vec_id", "label", "v", "scores", "size", "leaf", "windows", "bounds"])

    return targets


def _searcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one block of a leaf and the anchors that search it: the best rows
    per anchor and window."""
    keys = ["size", "leaf", "block", "part"]
    for key, group in runs_of(batches, keys):
        is_anchor = np.asarray(group.column("anchor"))
        split = int(is_anchor.sum())
        if not split or split == group.num_rows:
            continue
        asks, has = group.slice(group.num_rows - split), group.slice(0, group.num_rows - split)
        asked, held = (_unpacked(x.column("v"), key[0]).astype(np.float64) for x in (asks, has))
        scores = asked @ held.T
        row_a, row_b, label_a, label_b = (np.asarray(x.column(c)) for c in ("row", "label") for x in (asks, has))
        same = label_a[:, None] == label_b[None, :]
        positives, windows = asks.column("scores").to_pylist(), asks.column("windows").to_pylist()
        which = np.repeat(np.arange(split), [len(w) for w in windows])
        number = np.array([n for w in windows for n in w], np.int64)
        least = np.array([x for w in asks.column("bounds").to_pylist() for x in w])
        near = scores[which] >= least[:, None]
        if positives[0] is None:
            one, two = _best(scores, near & same & (row_a[:, None] != row_b[None, :]), POSITIVES)
        else:
            positive = np.array([p[n] for p, w in zip(positives, windows) for n in w], np.float64)[:, None]
            row, column = np.nonzero(near & (scores[which] * 100 <= 95 * positive))
            fits = ~same[which[row], column] & (scores[which[row], column] * 100 >= 50 * positive[row, 0])
            allowed = np.zeros(near.shape, bool)
            allowed[row[fits], column[fits]] = True
            one, two = _best(scores[which], allowed, NEGATIVES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row_a[which[one]]), pa.array(number[one]), pa.array(scores[which[one], two].astype(np.int64)),
             has.column("vec_id").combine_chunks().take(pa.array(two)), pa.array(row_b[two])],
            names=["row", "number", "score", "found_id", "found_row"])


def search(placed: DataFrame, index: Index, anchors: DataFrame, k: int, name: str) -> DataFrame:
    """(row, number, rank, score, found_id, found_row): the ``k`` best of each window of
    ``anchors`` (row, vec_id, label, v, scores)."""
    shared = placed.sparkSession.sparkContext.broadcast(index)
    asked = written(anchors.mapInArrow(_targets(shared), "row bigint, vec_id bigint, label bigint, v binary, scores array<bigint>, "
                                       "size int, leaf bigint, windows array<bigint>, bounds array<double>"), f"{name}_asked")
    blocks = placed.groupBy("size", "leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    parts = asked.groupBy("size", "leaf").agg(F.ceil(F.count("*") / ANCHORS).alias("parts"))
    shape = written(blocks.join(parts, ["size", "leaf"]), f"{name}_shape")
    columns = ["size", "leaf", "block", "part", "anchor", "row", "vec_id", "label", "v", "scores", "windows", "bounds"]
    nothing = F.lit(None).cast("array<bigint>")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    def own(n: str) -> Column:
        return F.pmod(F.xxhash64("row"), F.col(n))

    dealt = (placed.join(shape, ["size", "leaf"]).withColumn("block", own("blocks")).withColumn("part", every("parts"))
             .withColumn("anchor", F.lit(0)).withColumn("scores", nothing).withColumn("windows", nothing)
             .withColumn("bounds", F.lit(None).cast("array<double>")).select(columns)
             .unionByName(asked.join(shape, ["size", "leaf"]).withColumn("part", own("parts")).withColumn("block", every("blocks"))
                          .withColumn("anchor", F.lit(1)).select(columns)))
    found = (dealt.repartition("size", "leaf", "block", "part")
             .sortWithinPartitions("size", "leaf", "block", "part", "anchor", F.col("vec_id").asc_nulls_last(), "row")
             .mapInArrow(_searcher, "row bigint, number bigint, score bigint, found_id bigint, found_row bigint"))
    best = Window.partitionBy("row", "number").orderBy(F.desc("score"), F.col("found_id").asc_nulls_last(), "found_row")
    return written(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), name)


def mine(vectors: DataFrame, every: int = 50, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by ``every``: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Rows without label or vector, or with a null or non-finite component, take no part,
    nor do components whose scaled size is 2^25 or more, as no score of theirs need fit a
    long. Rows without an id are no anchors, but positives and negatives; among equal
    scores they come last. Repeated rows are rows of their own. Vectors of different
    length never meet; empty vectors have the score 0 with each other. Anchors without a
    positive or without a negative in the window have no rows. Other columns are not
    read; an empty table gives no rows."""
    rows = quantized(vectors)
    index, placed = build_index(rows, sample, leaf)
    anchors = rows.where(F.col("vec_id") % every == 0)
    first = search(placed, index, anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), POSITIVES, "positives")
    listed = first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("_s"))
    asking = anchors.join(listed, "row").select("row", "vec_id", "label", "v", F.transform("_s", lambda x: x["score"]).alias("scores"))
    second = search(placed, index, asking, NEGATIVES, "negatives")
    positives = first.select("row", (F.col("rank") - 1).cast("bigint").alias("number"), F.col("found_id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
    return (second.join(positives, ["row", "number"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return mine(table(spark, folder, "embeddings"))


OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a, rows b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND n.score * 100 BETWEEN 50 * p.positive_score AND 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3
"""
