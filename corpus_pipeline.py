"""Documents to training pieces: quality rules, near-duplicate removal, mixing of the
sources to target weights, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it
kept, and its result is written and read again as the next stage's docs. All stages
but the last return the columns of ``documents`` with their values, whatever their
names; a row is carried through a stage as one struct, beside the columns that the
operators use. Texts of any length are worked on whole, and an empty table gives an
empty one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import circulant, decision_list, lattice, mixing
from lakeloom.llm.tables import table, written


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules keep (the labels judge documents of any
    earlier stage, so the rules are learned on the rows given).

    Null, empty and blank texts have no words and go. Equal texts are judged alike, so
    repeated rows stay or go together; a row without an id has no label but a verdict."""
    rules = decision_list.learn_rules(decision_list.labelled_statistics(docs, table(spark, sf_dir, "labels")))
    return decision_list.judge(docs.select(_whole(docs), "text"), rules).where("kept").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one of the smallest id; null ids come
    last, and of equal ids the first row stays.

    Rows are numbered and linked by their numbers, so rows without an id, rows that share
    one and ids of any type are told apart. Null, empty and blank texts link with nothing
    and stay, each of them."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("number"), _whole(docs)), "numbered")
    numbered = rows.select(F.col("number").alias("doc_id"), F.col("document.text").alias("text"))
    found = written(circulant.near_duplicates(numbered).select("doc_id", "component_id"), "groups")
    own = F.col("document.doc_id")
    ids = rows.select(F.col("number").alias("doc_id"), own.isNull().alias("nameless"), own.alias("own"))
    stays = (found.join(ids, "doc_id").groupBy("component_id")
             .agg(F.min(F.struct("nameless", "own", "doc_id"))["doc_id"].alias("first"), F.count("*").alias("n"))
             .where("n > 1"))
    gone = found.join(stays, "component_id").where("doc_id <> first").select(F.col("doc_id").alias("number"))
    return rows.join(gone, "number", "left_anti").select("document.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources; a document taken twice is two rows. A null source is a
    source of its own; null and empty texts have size 0; rows equal in id and text are
    taken together."""
    return mixing.mix(docs)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as sampled pieces: doc_id, lang, source, n_pieces, ids. A null
    text has null ids and an empty one none; rows equal in id and text have equal ids."""
    pieces = lattice.encode(docs.select("doc_id", "text", "lang", "source"))
    return pieces.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_pieces"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("sentence_pieces", sentence_pieces),
]

#: Sampled segmentations have no SQL form; tests compare `run` with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
