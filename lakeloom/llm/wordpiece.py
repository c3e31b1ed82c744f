"""Token counts of greedy longest-match word pieces, in time linear in the text.

The vocabulary is a trie. Where the trie has no edge for the next character, the
failure link of the node leads to the node from which matching goes on, and the
precomputed number of tokens that the move gives up is added to the count; no piece
is built and no character is read twice. A word that cannot be cut is one unknown
token. Counts of words met before are kept per task, up to a fixed number.

Broadcast: the automaton, whose size is that of the vocabulary file."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakeloom.llm.tables import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
START = " "           # stands before each word; pieces that begin with it begin a word
WORDS_KEPT = 500_000


class Automaton:
    def __init__(self, pieces: Iterable[str]):
        self.child: list[dict[str, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    is_piece.append(False)
                node = self.child[node][c]
            is_piece[node] = True
        self.fail: list[int | None] = [None] * len(self.child)
        self.popped = [0] * len(self.child)
        layer = [0]
        while layer:
            below = []
            for up in layer:
                for c, node in self.child[up].items():
                    below.append(node)
                    if is_piece[node]:
                        self.fail[node], self.popped[node] = 0, 1
                        continue
                    at, popped = self.fail[up], self.popped[up]
                    while at is not None and c not in self.child[at]:
                        popped += self.popped[at]
                        at = self.fail[at]
                    if at is not None:
                        self.fail[node], self.popped[node] = self.child[at][c], popped
            layer = below

    def count(self, word: str) -> int:
        """Number of pieces of a word; -1 if it cannot be cut."""
        child, fail, popped = self.child, self.fail, self.popped
        node = n = 0
        for c in START + word:
            while c not in child[node]:
                if fail[node] is None:
                    return -1
                n += popped[node]
                node = fail[node]
            node = child[node][c]
        while node:
            if fail[node] is None:
                return -1
            n += popped[node]
            node = fail[node]
        return n


def load_pieces(path: str = MODEL) -> list[str]:
    """Pieces of a SentencePiece model file: those that begin with the marker begin a
    word, others continue one. Bytes, control pieces and runs of markers are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    usual = (i for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)))
    return [p for p in (model.id_to_piece(i).replace("▁", START) for i in usual) if START not in p[1:]]


class WordLengths(dict):
    """Word -> pieces, for words met so far; emptied when it holds `WORDS_KEPT`."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = n = self.automaton.count(word.decode())
        return n


def _counter(shared, at: int, keep: int):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = WordLengths(shared.value)
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column(at):
                found = (text.as_py() or "").encode().split()
                n = np.fromiter(map(lengths.__getitem__, found), np.int64, len(found))
                words.append(len(found))
                tokens.append(int(np.abs(n).sum()))
                unknown.append(int((n < 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keep], *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                names=[*batch.schema.names[:keep], "n_words", "n_tokens", "n_unknown"])

    return counted


def token_counts(df: DataFrame, text: str = "text", pieces: list[str] | None = None,
                 columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``df`` (default: all) with n_words, n_tokens and n_unknown (long)
    of the whole texts; columns of these names are replaced, others are passed on.

    Words are runs of anything but the six ASCII blanks. Null, empty and blank texts
    count 0; equal texts get equal counts; an empty table gives an empty one."""
    kept = [c for c in (columns or df.columns) if c not in ("n_words", "n_tokens", "n_unknown")]
    shared = df.sparkSession.sparkContext.broadcast(Automaton(load_pieces() if pieces is None else pieces))
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_text"))
    schema = StructType([*(df.schema[c] for c in kept),
                         *(StructField(c, LongType()) for c in ("n_words", "n_tokens", "n_unknown"))])
    return rows.mapInArrow(_counter(shared, len(kept), len(kept)), schema)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), columns=["doc_id"])
