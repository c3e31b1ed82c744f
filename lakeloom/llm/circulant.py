"""Near-duplicate documents by circulant MinHash.

A document is the set of its distinct 5-word shingles (64-bit hashes). Two
permutations of a universe of ``UNIVERSE`` positions give the whole signature: the
first scatters the shingles, the second, shifted by k places, gives coordinate k as
the least of its values there. As the shifts of one position lie side by side, the
signature of a set is a minimum over contiguous slices.

1. Documents with equal shingle sets form one class; only its smallest id goes on.
2. Signatures are cut into bands; in each bucket of a band every member is compared
   with the bucket's smallest id, on full shingle sets.
3. Members that are still in different components are compared with each other, in
   blocks, again on full sets. No pair that shares a bucket is left untested unless
   its two documents are already connected.
4. Connected components of the confirmed links.

A pair at the threshold of 0.75 shares no bucket with a chance of
(1 - 0.75**5)**32 = 2e-4; at 0.8 it is 3e-6. Set sizes, signatures and texts go
through shuffles; nothing is gathered in the driver, and no bucket in one task."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.tables import runs_of, table, written

WIDTH = 5             # words in a shingle
SHARE = (75, 100)     # links: intersection / union of at least this
BANDS, ROWS = 32, 5
UNIVERSE = 1 << 20
BLOCK = 256           # documents of a bucket compared in one group
STAR = 200            # members compared with one copy of a bucket's smallest document
_WORDS_KEPT = 1 << 20

_SET = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(count: int, salt: int) -> np.ndarray:
    return _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


_PLACES = _odd(WIDTH, 1)


class WordHashes(dict):
    """Hash of each word met so far; emptied when it holds ``_WORDS_KEPT``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; a text of fewer than ``WIDTH`` words
    has one shingle, a text without words none."""
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    if n < WIDTH:
        return _mixed(np.array([(hashed * _PLACES[:n]).sum() + np.uint64(n)], np.uint64))
    summed = hashed[: n - WIDTH + 1] * _PLACES[0]
    for j in range(1, WIDTH):
        summed += hashed[j: n - WIDTH + 1 + j] * _PLACES[j]
    return np.unique(_mixed(summed))


@lru_cache(1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and all ``BANDS * ROWS`` shifts of the second one:
    row p holds its values at p, p + 1, ... (a view, not a copy)."""
    at = np.arange(UNIVERSE, dtype=np.uint64)
    scatter = np.argsort(_mixed(at + np.uint64(0x5851F42D4C957F2D))).astype(np.uint32)
    values = np.argsort(_mixed(at * np.uint64(0xD1342543DE82EF95) + np.uint64(3))).astype(np.uint32)
    width = BANDS * ROWS
    return scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[: width - 1]]), width)


def signature(found: np.ndarray) -> np.ndarray:
    scatter, shifted = _permutations()
    places = scatter[(found & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    least = np.full(BANDS * ROWS, UNIVERSE, np.uint32)
    for at in range(0, len(places), 1024):
        np.minimum(least, shifted[places[at: at + 1024]].min(axis=0), out=least)
    return least


_IN_BAND, _OF_BAND = _odd(ROWS, 11), _odd(BANDS, 23)


def band_keys(found: np.ndarray) -> np.ndarray:
    by_band = signature(found).astype(np.uint64).reshape(BANDS, ROWS)
    return _mixed(((by_band + np.uint64(1)) * _IN_BAND).sum(axis=1) + _OF_BAND).view(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            sizes, keys, bands = [], [], []
            for text in part.column(1):
                found = shingles(text.as_py(), known)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                bands.append(band_keys(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "set_key", "bands"])


def _linked(one: np.ndarray, two: np.ndarray) -> bool:
    small, large = sorted((one, two), key=len)
    if not len(small) or SHARE[1] * len(small) < SHARE[0] * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    shared = int((large[at] == small).sum())
    return SHARE[1] * shared >= SHARE[0] * (len(small) + len(large) - shared)


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                       pa.array([p[1] for p in pairs], pa.int64())], schema=_EDGE)


def _star_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (star, salt, role, id, text), the centre (role 0) before its members."""
    known, centre, sets = WordHashes(), None, []
    for batch in batches:
        star, salt, role, own, text = (batch.column(k) for k in range(5))
        found = []
        for s, z, r, i, t in zip(star.to_pylist(), salt.to_pylist(), role.to_pylist(), own.to_pylist(), text):
            if (s, z) != centre:
                centre, sets = (s, z), []
            mine = shingles(t.as_py(), known)
            if r == 0:
                sets.append(mine)
            elif any(_linked(mine, x) for x in sets):
                found.append((s, i))
        yield _edges(found)


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, low, high, block, id, component, text): all pairs of the two
    blocks that are not yet in one component."""
    known = WordHashes()
    for (_, low, high), rows in runs_of(batches, ["bucket", "low", "high"]):
        ids, blocks = rows.column("id").to_pylist(), rows.column("block").to_pylist()
        group = rows.column("component").to_pylist()
        sets = [shingles(t.as_py(), known) for t in rows.column("text")]
        root = {g: g for g in group}

        def top(g: int) -> int:
            while root[g] != g:
                g = root[g]
            return g

        found = []
        for i in range(len(ids)):
            for j in range(i):
                if (low == high or blocks[i] != blocks[j]) and top(group[i]) != top(group[j]) and _linked(sets[i], sets[j]):
                    root[top(group[i])] = top(group[j])
                    found.append((ids[i], ids[j]))
        yield _edges(found)


def sketches(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, set_key (128 bits of the shingle set; null when it
    is empty), bands. Written once."""
    return written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_sketched, _SET),
                   "sketches")


def _texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """``wanted`` (id, ...) with the text of each id. An id with several texts gives a
    row for each."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")
    return wanted.join(texts, wanted["id"] == texts["_id"]).drop("_id")


def links(docs: DataFrame, sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between class representatives that connect whatever is
    linked."""
    rep = classes.select("set_key", "rep")
    reps = written(sketched.where("doc_id IS NOT NULL").join(rep, "set_key").where("doc_id = rep")
                   .select("rep", "bands"), "representatives")
    postings = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = written(postings.groupBy("bucket").agg(F.min("rep").alias("centre"), F.max("rep").alias("_last"))
                     .where("centre <> _last").drop("_last"), "buckets")
    members = written(postings.join(shared, "bucket").where("rep <> centre").distinct(), "members")

    pairs = written(members.select("centre", "rep").distinct(), "pairs")
    stars = pairs.groupBy("centre").agg(F.ceil(F.count("*") / STAR).cast("int").alias("salts"))
    stars = written(stars, "stars")
    spread = pairs.join(stars, "centre").select(
        F.col("rep").alias("id"), F.col("centre").alias("star"), F.pmod(F.hash("rep"), F.col("salts")).alias("salt"),
        F.lit(1).alias("role"))
    centres = stars.select(F.col("centre").alias("id"), F.col("centre").alias("star"),
                           F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"))
    rows = _texts(spread.unionByName(centres), docs).select("star", "salt", "role", "id", "text")
    confirmed = written(rows.repartition("star", "salt").sortWithinPartitions("star", "salt", "role")
                        .mapInArrow(_star_links, "a bigint, b bigint"), "links")

    # buckets with members that the comparisons with the centres have not connected
    group = written(components(confirmed), "groups")
    placed = members.join(group, members["rep"] == group["node"], "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component"))
    placed = written(placed, "placed")
    mark = (F.count("*").alias("_n"), F.bit_xor(F.xxhash64("rep")).alias("_x"),
            F.bit_xor(F.xxhash64(F.lit(7), F.col("rep"))).alias("_y"))
    open_buckets = (placed.groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), *mark)
                    .where("_low <> _high").groupBy("_n", "_x", "_y").agg(F.min("bucket").alias("bucket"))
                    .select("bucket", F.ceil(F.col("_n") / BLOCK).cast("int").alias("blocks")))
    block = F.pmod(F.hash("rep"), F.col("blocks"))
    wanted = (placed.join(written(open_buckets, "open"), "bucket").withColumn("block", block)
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("bucket", F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
                      "block", F.col("rep").alias("id"), "component"))
    more = (_texts(wanted, docs).repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "id")
            .mapInArrow(_block_links, "a bigint, b bigint"))
    return confirmed.unionByName(more)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id,
    kept.

    Null, empty and blank texts have no shingles and link with nothing. A row without
    doc_id cannot be named by a link: it has a null component and is kept. Repeated
    rows of one doc_id are one document and share its component. Other columns are
    not read; an empty table gives an empty result."""
    sketched = sketches(docs)
    classes = written(sketched.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key")
                      .agg(F.min("doc_id").alias("rep")), "classes")
    # several texts of one doc_id are one node already: their classes meet in it
    same = sketched.where("set_key IS NOT NULL AND doc_id IS NOT NULL").join(classes, "set_key").where(
        "doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = written(components(links(docs, sketched, classes).unionByName(same)), "components")
    rows = sketched.select("doc_id", "n_shingles")
    return (rows.join(found, rows["doc_id"] == found["node"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose document is not the smallest of its component."""
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
