"""SentencePiece encoding by sampling, and decoding.

A text's pieces are drawn from the distribution over all ways to cut it into pieces
of the vocabulary, with weights exp(theta * score). Forward filtering adds up the
weights of all cuts of each prefix; backward sampling draws the pieces from the end.
No piece crosses a blank or a line end but in front, so the lattice of a text falls
into the lattices of its chunks, each filtered once and kept; sampling then runs over
many chunks in step.

Every draw is a hash of the row's key, the chunk's place in the text and the step, so
the pieces of a row depend on its key, its text and the seed alone: not on partitions,
batches or retries. Characters without a piece are written as byte pieces, so decoding
gives every text back exactly, marker characters and all white space included.

Broadcast: the vocabulary, whose size is that of the model file."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lakeloom.llm.tables import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA = 0.001          # per unit of score; a score is minus the rank of the merge
SEED = 29
EDGES = 6_000_000      # edges of chunk lattices that a task keeps; 12 bytes each
CHUNKS = 200_000       # chunks, about, filtered and sampled in step
_CHUNK = re.compile(r"\n| ?[^ \n]+| ")
_BYTE_WEIGHT = -32.0   # log weight of a character that is cut into bytes; it has no other way
_NO_SCORE = -1e8       # user-defined pieces carry a score below this; runs of markers are never drawn


@dataclass(frozen=True)
class Pieces:
    """``weight``: text (blank for the marker) -> (id, log weight); ``byte``: id of
    each byte piece; ``spelled``: bytes of each id."""

    weight: dict[str, tuple[int, float]]
    byte: list[int]
    spelled: list[bytes]


def load_pieces(path: str = MODEL, theta: float = THETA) -> Pieces:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    weight, byte, spelled = {}, [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        text = piece.replace("▁", " ")
        if model.is_byte(i):
            value = int(piece[3:-1], 16)
            byte[value] = i
            spelled.append(bytes([value]))
            continue
        spelled.append(b"" if model.is_control(i) or model.is_unknown(i) else text.encode())
        if spelled[-1] and not model.is_unused(i):
            score = model.get_score(i)
            if score <= _NO_SCORE:
                if len(text) > 1:
                    continue
                score = -model.get_piece_size()  # a lone marker is the last resort, as other characters are
            if " " in text[1:] or "\n" in text:
                raise ValueError(f"piece {piece!r} crosses a chunk border")
            weight[text] = (i, theta * score)
    return Pieces(weight, byte, spelled)


class Lattices(dict):
    """Chunk -> its last node. A node stands for the place after a character; its edges
    are the pieces that end there: ``piece``, ``source`` (node that the piece begins
    after, -1: the chunk's start) and ``until``, the running share of the node's
    edges. ``first`` is a node's first edge; both nodes and edges are in order. ``again``:
    chunks met again since they were filtered or last kept."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        texts = list(pieces.weight)
        for at, text in enumerate(texts):
            self.matcher.add_word(text, at)
        self.matcher.make_automaton()
        self.length = np.array([len(t) for t in texts])
        self.id = np.array([pieces.weight[t][0] for t in texts], np.int32)
        self.log = np.array([pieces.weight[t][1] for t in texts])
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.again: set[str] = set()
        self.first, self.piece, self.source, self.until = (np.empty(0, t) for t in (np.int32, np.int32, np.int32, np.float32))

    def shrink(self) -> None:
        """Forget the chunks that were not met again, as most rare ones are not; all, if the others are too many."""
        chunks = [c for c in self if c in self.again]
        count = np.diff(np.append(self.first, len(self.piece)))
        ends, sizes = np.array([self[c] for c in chunks], np.int64), np.array([len(c) for c in chunks], np.int64)
        kept = np.zeros(len(self.first), bool)
        kept[np.repeat(ends - sizes + 1 - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))] = True
        more = kept
        while more.any():  # nodes inside spelled characters
            sources = self.source[np.repeat(more, count)]
            more = np.zeros(len(kept), bool)
            more[sources[sources >= 0]] = True
            more &= ~kept
            kept |= more
        edges = np.repeat(kept, count)
        if edges.sum() > EDGES // 2:
            self.reset()
            return
        place = (np.cumsum(kept) - 1).astype(np.int32)
        source = self.source[edges]
        self.piece, self.until, self.source = self.piece[edges], self.until[edges], np.where(source >= 0, place[source], np.int32(-1))
        self.first = (np.cumsum(count[kept]) - count[kept]).astype(np.int32)
        self.clear()
        self.again = set()
        self.update(zip(chunks, place[ends].tolist()))

    def __missing__(self, chunk: str) -> int:
        self.add([chunk])
        return self[chunk]

    def add(self, chunks: list[str]) -> None:
        """Filter new chunks, all of them in step. All pieces in them are found by one
        pass over the chunks joined by line ends, which no piece holds."""
        if not chunks:
            return
        sizes = np.array([len(c) for c in chunks])
        starts = np.cumsum(sizes + 1) - sizes - 1
        joined = "\n".join(chunks)
        chunk_of = np.repeat(np.arange(len(chunks)), sizes + 1)[: len(joined)]
        found = np.fromiter(chain.from_iterable(self.matcher.iter(joined)), np.int64).reshape(-1, 2)
        end, which = found[:, 0], found[:, 1]
        length, piece, log = self.length[which], self.id[which], self.log[which]
        # characters without a piece of their own are spelled in bytes
        bare = np.ones(len(joined), bool)
        bare[end[length == 1]] = False
        bare[starts[1:] - 1] = False
        spelled = np.flatnonzero(bare)
        end = np.concatenate([end, spelled])
        length = np.concatenate([length, np.ones(len(spelled), np.int64)])
        piece = np.concatenate([piece, np.zeros(len(spelled), np.int32)])
        log = np.concatenate([log, np.full(len(spelled), _BYTE_WEIGHT)])
        order = np.argsort(end, kind="stable")
        is_bytes = np.flatnonzero(order >= len(found))
        end, length, piece, log = end[order], length[order], piece[order], log[order]
        chunk = chunk_of[end]
        node, start_of = end - chunk, starts[chunk]
        source = np.where(end - length < start_of, -1, end - length - chunk)

        share = self._filtered(end - start_of, node, source, log, int((sizes).sum()))
        nodes, edges, at = len(self.first), len(self.piece), int(sizes.sum())
        source[source >= 0] += nodes
        counts = np.bincount(node, minlength=at)
        first = np.cumsum(counts) - counts
        until = share.astype(np.float32)
        at_rank, rank = first, 1
        while len(at_rank := at_rank[counts[node[at_rank]] > rank]):  # the node's edges alone decide its shares
            until[at_rank + rank] += until[at_rank + rank - 1]
            rank += 1
        until[first + counts - 1] = 2.0  # the last edge takes what rounding leaves
        # a spelled character: its last byte ends at the node, the others are nodes of
        # their own with one edge each
        more_first, more_piece, more_source = [], [], []
        for e in is_bytes.tolist():
            ids = [self.pieces.byte[x] for x in joined[end[e]].encode()]
            before = int(source[e])
            for x in ids[:-1]:
                more_first.append(edges + len(node) + len(more_piece))
                more_piece.append(x)
                more_source.append(before)
                before = nodes + at + len(more_piece) - 1
            piece[e], source[e] = ids[-1], before
        self.first = np.concatenate([self.first, (first + edges).astype(np.int32), np.array(more_first, np.int32)])
        self.piece = np.concatenate([self.piece, piece.astype(np.int32), np.array(more_piece, np.int32)])
        self.source = np.concatenate([self.source, source.astype(np.int32), np.array(more_source, np.int32)])
        self.until = np.concatenate([self.until, until.astype(np.float32), np.full(len(more_piece), 2.0, np.float32)])
        self.update(zip(chunks, (nodes + starts + sizes - 1 - np.arange(len(chunks))).tolist()))

    @staticmethod
    def _filtered(depth: np.ndarray, node: np.ndarray, source: np.ndarray, log: np.ndarray, nodes: int) -> np.ndarray:
        """Share of each edge among the weights of all cuts that end at its node: the
        forward sums, in logs, for all chunks at once, one character after the other."""
        alpha, share = np.zeros(nodes + 1), np.empty(len(log))  # the last place: the starts
        deepest = int(depth.max()) if len(depth) else 0
        order = np.argsort(depth.astype(np.int16) if deepest < 1 << 15 else depth, kind="stable")  # short ones by radix
        borders = np.searchsorted(depth[order], np.arange(deepest + 2)) if len(depth) else [0]
        for low, high in zip(borders[:-1], borders[1:]):
            e = order[low:high]
            t, n = alpha[source[e]] + log[e], node[e]
            firsts = np.flatnonzero(np.concatenate([[True], n[1:] != n[:-1]]))
            runs = np.diff(np.append(firsts, len(n)))
            most = np.repeat(np.maximum.reduceat(t, firsts), runs)
            weight = np.exp(t - most)
            whole = np.add.reduceat(weight, firsts)
            share[e] = weight / np.repeat(whole, runs)
            alpha[n[firsts]] = most[firsts] + np.log(whole)
        return share


def _uniform(own: np.ndarray, step: int) -> np.ndarray:
    """A number in [0, 1) from the number of a row's chunk and a step."""
    x = own + np.uint64(step * 0xD1342543DE82EF95 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) * 2.0**-64


def sample(lattices: Lattices, ends: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of chunks with the given last nodes, in order, and how many each has."""
    first, piece, source, until = lattices.first, lattices.piece, lattices.source, lattices.until
    count = np.zeros(len(ends), np.int64)
    own = key + place * np.uint64(0x9E3779B97F4A7C15)
    active, at, drawn, step = np.arange(len(ends)), ends, [], 0
    while len(active):
        u = _uniform(own, step)
        edge = first[at]
        late = np.flatnonzero(u >= until[edge])
        while len(late):
            edge[late] += 1
            late = late[u[late] >= until[edge[late]]]
        drawn.append((active, piece[edge]))
        count[active] += 1
        at = source[edge]
        more = at >= 0
        active, at, own, step = active[more], at[more], own[more], step + 1
    last = np.cumsum(count) - 1
    ids = np.empty(int(count.sum()), np.int32)
    for step, (chunks, found) in enumerate(drawn):
        ids[last[chunks] - step] = found
    return ids, count


def _sampled(texts: list[str | None], keys: np.ndarray, lattices: Lattices) -> pa.Array:
    """Piece ids of each text; null for null."""
    chunks, numbers = [], []
    for text in texts:
        own = _CHUNK.findall(" " + text) if text else []
        chunks += own
        numbers.append(len(own))
    met = set(chunks)
    new = [c for c in met if c not in lattices]
    lattices.again |= met.difference(new)
    lattices.add(new)
    ends, numbers = list(map(lattices.__getitem__, chunks)), np.array(numbers)
    starts = np.cumsum(numbers) - numbers
    row = np.repeat(np.arange(len(texts)), numbers)
    place = (np.arange(len(row)) - starts[row]).astype(np.uint64)
    ids, count = sample(lattices, np.array(ends, np.int64), keys[row], place)
    total = np.concatenate([[0], np.cumsum(count)])
    offsets = np.concatenate([total[starts], total[-1:]])
    missing = pa.array([t is None for t in texts] + [False])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.array(missing)), pa.array(ids))


def _encoder(shared, text_at: int, key_at: int, keep: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(shared.value)
        for batch in batches:
            at, texts = 0, batch.column(text_at)
            keys = np.array(batch.column(key_at)).astype(np.int64).view(np.uint64)
            while at < batch.num_rows:
                taken, size = [], 0
                while at + len(taken) < batch.num_rows and size < CHUNKS * 6:
                    taken.append(texts[at + len(taken)].as_py())
                    size += len(taken[-1] or "")
                if len(lattices.piece) > EDGES:
                    lattices.shrink()
                part = batch.slice(at, len(taken))
                ids = _sampled(taken, keys[at: at + len(taken)], lattices)
                yield pa.RecordBatch.from_arrays([*part.columns[:keep], ids], names=[*part.schema.names[:keep], "_ids"])
                at += len(taken)

    return encoded


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", ids: str = "ids", model: str = MODEL,
           theta: float = THETA, seed: int = SEED) -> DataFrame:
    """``df`` with the column ``ids`` (array of piece ids, replaced if there is one).

    A null text gives null, an empty one no ids. A null key is a key like others, so
    rows with equal keys and texts get equal pieces. Other columns are passed on,
    whatever their names; an empty table gives an empty one."""
    kept = [c for c in df.columns if c != ids]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_text"),
                     F.xxhash64(F.lit(seed), F.col(f"`{key}`").cast("string")).alias("_seed"))
    shared = df.sparkSession.sparkContext.broadcast(load_pieces(model, theta))
    schema = StructType([*(df.schema[c] for c in kept), StructField("_ids", ArrayType(IntegerType()))])
    found = rows.mapInArrow(_encoder(shared, len(kept), len(kept) + 1, len(kept)), schema)
    return found.withColumnRenamed("_ids", ids)


def _decoder(shared, at: int):
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = shared.value.spelled
        for batch in batches:
            texts = []
            for ids in batch.column(at):
                values = ids.values
                texts.append(None if values is None else
                             b"".join(map(spelled.__getitem__, values.to_numpy(zero_copy_only=False).tolist()))[1:].decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, "_decoded"])

    return decoded


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", model: str = MODEL) -> DataFrame:
    """``df`` with the column ``text``: the texts that the piece ids came from. Null
    ids give null."""
    kept = [c for c in df.columns if c != text]
    shared = df.sparkSession.sparkContext.broadcast(load_pieces(model))
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = StructType([*(df.schema[c] for c in kept), StructField("_decoded", StringType())])
    return rows.mapInArrow(_decoder(shared, kept.index(ids)), schema).withColumnRenamed("_decoded", text)


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: number of pieces, a digest of their ids in order, and whether
    decoding gave the text back."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", F.xxhash64("text").alias("hash"), F.length("text").alias("size"))
    pieces = encode(docs).drop("text").select("doc_id", "hash", "size", "ids", F.size("ids").alias("n"),
                                              F.xxhash64("ids").alias("pieces_digest"))
    back = F.xxhash64("decoded").eqNullSafe(F.col("hash")) & F.length("decoded").eqNullSafe(F.col("size"))
    return decode(pieces).select("doc_id", F.greatest(F.col("n"), F.lit(0)).cast("bigint").alias("n_pieces"),
                                 "pieces_digest", back.alias("lossless"))
