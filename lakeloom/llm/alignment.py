"""Alignment of the tokens of two tokenizers by interval coalescing.

Both tokenizers cut the same bytes. The byte ranges of all A and B tokens are sorted by
start (`lexsort`), the largest end so far is carried along (`maximum.accumulate`), and
a group ends where a start reaches it: there a token of A and one of B end at the same
offset. Inside a group every A token is expanded to the B tokens whose ranges it
overlaps: the links.

* Neither vocabulary merges over the border between a visible character and a blank or
  line end, so a text is a row of chunks that are cut and aligned on their own. A task
  aligns the chunks it has not met yet, many at a time, and keeps them up to
  ``KEPT_BYTES``.
* A document is written once with its different links and how often each occurs. The number of
  documents that hold a link is counted over all documents; its best B token per A token
  is the one in most documents.
* The ``FREQUENT`` links that most documents hold go to the tasks as one table of that
  size; all other links are joined by Spark.

Broadcast: the two vocabularies and the table above."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from lakeloom.llm.tables import table, written

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
KEPT_BYTES = 96 << 20      # of a task's aligned chunks, about
BLOCK_BYTES = 2 << 20      # of text aligned at once; a longer text is a block of its own
FREQUENT = 1 << 19         # links looked up in a table of their own
WIDTH = 1 << 15            # a link is the number a * WIDTH + b; B has fewer ids than that

_BORDER = re.compile(r"(?<=\S)(?=[ \n])")
_ODD = re.compile(r"\s[ \n]|\0")


def chunks_of(text: str) -> list[str]:
    """``" " + text`` cut before each blank or line end that follows a visible
    character."""
    text = " " + text
    if _ODD.search(text):
        return _BORDER.split(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]


def _byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 bytes stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabularies(path_a: str = VOCABULARY_A, path_b: str = VOCABULARY_B) -> tuple[str, bytes]:
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return a.read(), b.read()


class Tokenizers:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, vocabularies: tuple[str, bytes]):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabularies[0])
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=vocabularies[1])
        letters = _byte_letters()
        named = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(named.values()) + 1)
        for piece, i in named.items():
            self.bytes_a[i] = bytes(letters[c] for c in piece if c in letters)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        if len(self.bytes_b) > WIDTH:
            raise ValueError(f"B has more than {WIDTH} ids")
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])

    def encode(self, chunks: list[str]) -> tuple[list, list]:
        """Ids of A and of B per chunk. B adds a blank itself: the one that begins the
        chunk is not given to it, and without one its first token is taken off again."""
        a = [x.ids for x in self.a.encode_batch(chunks, add_special_tokens=False)]
        blank = self.b.piece_to_id("▁")
        b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        return a, [(x or [blank]) if c[0] == " " else x[1:] for c, x in zip(chunks, b)]

    def agree(self, chunk: str, a: list, b: list) -> bool:
        want = chunk.encode()
        return (b"".join([self.bytes_a[i] for i in a]) == want
                and b"".join([self.bytes_b[i] for i in b]) == want)


def coalesce(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group of each A and of each B token, and the links as positions in A and in B.
    Ranges of each side are in order, do not overlap and are not empty."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    opens = np.ones(len(order), bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    first = np.searchsorted(end_b, start_a, "right")
    count = np.searchsorted(start_b, end_a, "left") - first
    one = np.repeat(np.arange(len(start_a)), count)
    two = np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    return group[: len(start_a)], group[len(start_a):], one, two


def _ranges(counts: np.ndarray, at: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Positions begin[at[i]] ... begin[at[i]] + counts[at[i]] - 1 of all i in a row."""
    n = counts[at]
    return np.arange(n.sum()) + np.repeat(begin[at] - (np.cumsum(n) - n), n)


class Chunks:
    """Chunks met so far: their numbers of tokens, groups and links, the groups as text,
    and their links."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.text: list[bytes] = []
        self.good = np.empty(0, bool)
        self.sizes = np.empty((0, 4), np.int64)     # n_a, n_b, n_groups, n_links
        self.begin = np.empty(0, np.int64)          # of its links
        self.links = np.empty(0, np.int64)
        self.held = 0

    def learn(self, new: list[str]) -> None:
        tok = self.tokenizers
        a, b = tok.encode(new)
        good = np.array([tok.agree(*x) for x in zip(new, a, b)], bool)
        a = [x if ok else [] for x, ok in zip(a, good)]
        b = [x if ok else [] for x, ok in zip(b, good)]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(new)) for x in (a, b))
        ids_a, ids_b = (np.fromiter((i for x in side for i in x), np.int64) for side in (a, b))
        end_a, end_b = np.cumsum(tok.size_a[ids_a]), np.cumsum(tok.size_b[ids_b])
        group_a, group_b, one, two = coalesce(end_a - tok.size_a[ids_a], end_a, end_b - tok.size_b[ids_b], end_b)
        chunk_a = np.repeat(np.arange(len(new)), n_a)
        groups = np.bincount(chunk_a[np.diff(group_a, prepend=-1) > 0], minlength=len(new))
        n_links = np.bincount(chunk_a[one], minlength=len(new))
        self.text.extend(self._spelled(ids_a, ids_b, group_a, group_b, groups))
        self.begin = np.concatenate([self.begin, len(self.links) + np.cumsum(n_links) - n_links])
        self.links = np.concatenate([self.links, ids_a[one] * WIDTH + ids_b[two]])
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, groups, n_links], axis=1)])
        self.good = np.concatenate([self.good, good])
        self.held += sum(map(len, new)) + 300 * len(new) + 20 * len(one)

    @staticmethod
    def _spelled(ids_a, ids_b, group_a, group_b, groups) -> Iterator[bytes]:
        """The groups of each chunk as ``a1,a2|b1;a3|b2,b3``."""
        n = int(groups.sum())
        cut_a, cut_b = np.searchsorted(group_a, np.arange(n + 1)), np.searchsorted(group_b, np.arange(n + 1))
        a, b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        ca, cb = cut_a.tolist(), cut_b.tolist()
        each = [",".join(a[ca[g]:ca[g + 1]]) + "|" + ",".join(b[cb[g]:cb[g + 1]]) for g in range(n)]
        at = 0
        for k in groups.tolist():
            yield ";".join(each[at:at + k]).encode()
            at += k

    def find(self, chunks: list[str]) -> np.ndarray:
        place = self.place
        new = [c for c in dict.fromkeys(chunks) if c not in place]
        if new:
            at = len(place)
            place.update(zip(new, range(at, at + len(new))))
            self.learn(new)
        return np.fromiter(map(place.__getitem__, chunks), np.int64, len(chunks))


def _blocks(texts: list) -> Iterator[list]:
    """Texts in order, about ``BLOCK_BYTES`` at a time."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "")
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _aligner(shared, at: int):
    """Batches with the text in column ``at``; the columns before it are passed on."""
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(Tokenizers(shared.value))
        for batch in batches:
            begin = 0
            for block in _blocks(batch.column(at).to_pylist()):
                part = batch.slice(begin, len(block))
                begin += len(block)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *_align_block(chunks, block)],
                                                 names=[*part.schema.names[:at], *_ALIGNED])

    return aligned


_ALIGNED = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string",
            "links": "binary", "times": "binary"}


def _align_block(chunks: Chunks, texts: list) -> list[pa.Array]:
    """Per text its numbers of tokens, groups and links, the digest of its groups, and
    its different links in order with how often each occurs (both int64)."""
    if chunks.held > KEPT_BYTES:
        chunks.clear()
    cut = [chunks_of(t) if t else [] for t in texts]
    n = np.fromiter(map(len, cut), np.int64, len(cut))
    at = chunks.find([c for x in cut for c in x])
    doc = np.repeat(np.arange(len(texts)), n)
    bad = np.bincount(doc, ~chunks.good[at], len(texts)) > 0
    at, doc = at[~bad[doc]], doc[~bad[doc]]
    sizes = np.stack([np.bincount(doc, chunks.sizes[at, k], len(texts)) for k in range(4)], axis=1).astype(np.int64)
    border = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    listed, text = at.tolist(), chunks.text
    digests = [hashlib.sha256(b";".join([text[i] for i in listed[x:y]])).hexdigest() if y > x else ""
               for x, y in zip(border, border[1:])]
    links = chunks.links[_ranges(chunks.sizes[:, 3], at, chunks.begin)]
    # the numbers of links are under 2^31 and a block has few texts, so both fit one key
    key, times = np.unique(np.repeat(doc, chunks.sizes[at, 3]) << 32 | links, return_counts=True)
    border = np.searchsorted(key >> 32, np.arange(len(texts) + 1)).tolist()
    key &= (1 << 32) - 1
    return [*(pa.array(sizes[:, k]) for k in range(4)), pa.array(digests, pa.string()),
            *(pa.array([x[i:j].astype(kind).tobytes() for i, j in zip(border, border[1:])], pa.binary())
              for x, kind in ((key, np.uint32), (times, np.int32)))]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links with the number of documents that hold them; a task sums up what it has
    met each time that much has come again, and gives out sums when they are many."""
    links, n = np.empty(0, np.int64), np.empty(0, np.int64)
    waiting: list[np.ndarray] = []

    def summed() -> tuple[np.ndarray, np.ndarray]:
        met, times = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (links[:0], n[:0])
        waiting.clear()
        both, place = np.unique(np.concatenate([links, met]), return_inverse=True)
        return both, np.bincount(place, np.concatenate([n, times]), len(both)).astype(np.int64)

    for batch in batches:
        found = np.frombuffer(b"".join(x for x in batch.column(0).to_pylist() if x), np.uint32).astype(np.int64)
        waiting.append(found)
        if sum(map(len, waiting)) > max(1 << 20, len(links)):
            links, n = summed()
            if len(links) > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(links), pa.array(n)], names=["link", "n"])
                links, n = links[:0], n[:0]
    links, n = summed()
    yield pa.RecordBatch.from_arrays([pa.array(links), pa.array(n)], names=["link", "n"])


def link_counts(aligned: DataFrame) -> DataFrame:
    """link, n (documents that hold it) and best (n is the highest of its A id)."""
    counts = written(aligned.select("links").mapInArrow(_counted, "link bigint, n bigint")
                     .groupBy("link").agg(F.sum("n").alias("n")), "counts")
    a = F.shiftright("link", WIDTH.bit_length() - 1)
    most = counts.groupBy(a.alias("_a")).agg(F.max("n").alias("_most"))
    return written(counts.join(most, a == F.col("_a")).select("link", "n", (F.col("n") == F.col("_most")).alias("best")), "best")


def _frequent(counts: DataFrame, most: int) -> tuple[int, DataFrame]:
    """The links that at least so many documents hold, at most ``most``, and that number."""
    step = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("k"), F.min("n").alias("least")).collect()
    bound, held = None, 0
    for row in sorted(sizes, key=lambda r: -r.step):
        held += row.k
        if held > most:
            break
        bound = row.least
    bound = bound if bound is not None else 1 << 62
    return bound, counts.where(F.col("n") >= bound)


def _looked_up(shared):
    """Adds to batches of (row, links, times): n_best and count_sum over the frequent
    links, and the other links with their numbers."""
    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            blocks = [x or b"" for x in batch.column(1).to_pylist()]
            links = np.frombuffer(b"".join(blocks), np.uint32)
            times = np.frombuffer(b"".join(x or b"" for x in batch.column(2).to_pylist()), np.int32).astype(np.int64)
            cut = np.concatenate([[0], np.cumsum([len(x) // 4 for x in blocks])]).astype(np.int64)
            at = np.searchsorted(known, links)
            at[at == len(known)] = 0
            hit = known[at] == links if len(known) else np.zeros(len(links), bool)
            if len(known):
                sums = [np.concatenate([[0], np.cumsum(np.where(hit, times * x[at], 0))]) for x in (best, n)]
            else:
                sums = [np.zeros(len(links) + 1, np.int64)] * 2
            rest = np.concatenate([[0], np.cumsum(~hit)]).astype(np.int32)
            offsets = pa.array(rest[cut], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x[cut[1:]] - x[cut[:-1]]) for x in sums),
                 pa.ListArray.from_arrays(offsets, pa.array(links[~hit].astype(np.int64))),
                 pa.ListArray.from_arrays(offsets, pa.array(times[~hit]))],
                names=["_row", "n_best", "count_sum", "_links", "_times"])

    return looked_up


def aligned_documents(docs: DataFrame, id: str = "doc_id", text: str = "text",
                      vocabularies: tuple[str, bytes] | None = None) -> DataFrame:
    """One row per document, written: _row, the id column, n_a, n_b, n_groups, n_links,
    groups_sha256, and its different links (uint32) with how often each occurs (int32)
    as binary columns."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies or read_vocabularies())
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    kind = docs.schema[id].dataType.simpleString()
    return written(rows.mapInArrow(_aligner(shared, 2), f"_row bigint, _id {kind}, " + ", ".join(
        f"{c} {t}" for c, t in _ALIGNED.items())), "aligned")


def align(docs: DataFrame, id: str = "doc_id", text: str = "text",
          vocabularies: tuple[str, bytes] | None = None, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs``: the id column, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256 (see the module).

    Null and empty texts, and texts that one tokenizer does not give back byte by byte
    (U+2581 is a blank to B), have no tokens: zeros and an empty digest. Blank texts are
    tokens like any other. Repeated rows and null ids are documents of their own. Ties
    for the best B token are all best. A very long text is aligned whole; a task holds
    about 60 bytes per byte of its longest text. Other columns are not read; an empty
    table gives no rows."""
    spark = docs.sparkSession
    aligned = aligned_documents(docs, id, text, vocabularies)
    counts = link_counts(aligned)
    bound, often = _frequent(counts, frequent)
    known = often.toArrow()
    link, n, best = (np.array(known.column(c)) for c in ("link", "n", "best"))
    order = np.argsort(link)
    shared = spark.sparkContext.broadcast((link[order].astype(np.uint32), n[order], best[order].astype(np.int64)))
    found = written(aligned.select("_row", "links", "times").mapInArrow(
        _looked_up(shared), "_row bigint, n_best bigint, count_sum bigint, _links array<bigint>, _times array<bigint>"), "found")
    rare = (found.where(F.size("_links") > 0)
            .select("_row", F.explode(F.arrays_zip("_links", "_times")).alias("_x"))
            .select("_row", F.col("_x._links").alias("link"), F.col("_x._times").alias("_k"))
            .join(counts.where(F.col("n") < bound), "link")
            .select("_row", F.when(F.col("best"), F.col("_k")).otherwise(0).alias("n_best"),
                    (F.col("_k") * F.col("n")).alias("count_sum")))
    sums = (found.select("_row", "n_best", "count_sum").unionByName(rare)
            .groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return (aligned.join(sums, "_row")
            .select(F.col("_id").alias(id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def _spanned(shared, at: int):
    def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(shared.value)
        for batch in batches:
            begin = 0
            for block in _blocks(batch.column(at).to_pylist()):
                part = batch.slice(begin, len(block))
                begin += len(block)
                out: list[list] = [[], [], [], [], []]
                for text in block:
                    cut = chunks_of(text) if text else []
                    a, b = tok.encode(cut) if cut else ([], [])
                    if not all(map(tok.agree, cut, a, b)):
                        a = b = []
                    ids_a, ids_b = (np.array([i for x in side for i in x], np.int64) for side in (a, b))
                    end_a, end_b = np.cumsum(tok.size_a[ids_a]), np.cumsum(tok.size_b[ids_b])
                    group_a, group_b, _, _ = coalesce(end_a - tok.size_a[ids_a], end_a, end_b - tok.size_b[ids_b], end_b)
                    last = np.flatnonzero(np.diff(group_a, append=-1))
                    for have, x in zip(out, (ids_a, ids_b, group_a, group_b, end_a[last])):
                        have.append(x.tolist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], *(pa.array(x, pa.list_(pa.int64())) for x in out)],
                    names=[*part.schema.names[:at], *_SPANS])

    return spanned


_SPANS = ("ids_a", "ids_b", "group_a", "group_b", "group_ends")


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text",
          vocabularies: tuple[str, bytes] | None = None) -> DataFrame:
    """The alignment itself: the id column, ids_a, ids_b, group_a and group_b (group of
    each token, from 0) and group_ends (byte offset in blank + text where each group
    ends). Rows as in `align`; without tokens the arrays are empty."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies or read_vocabularies())
    rows = docs.select(F.col(f"`{id}`"), F.col(f"`{text}`").alias("_text"))
    schema = StructType([docs.schema[id], *(StructField(c, ArrayType(LongType())) for c in _SPANS)])
    return rows.mapInArrow(_spanned(shared, 1), schema)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"))
