"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded texts.

Folding: lower case, look-alike letters of other scripts to Latin ones, no accents and
invisible characters, digits and signs that stand for letters, one symbol for i and l.
What is left is a row of words of letters with one blank around each.

Learning, from at most ``LABELLED`` labelled rows:

1. every word and every beginning of one (``SHORTEST`` to ``LONGEST`` letters) gets its
   mean share of the words of toxic and of clean documents, and how sure the difference
   of their roots is (Welch's t). An entry of the lexicon is sure (``SURE``), in ``FEWEST`` toxic
   documents and ``TIMES`` as common there; of entries that begin with each other the
   surest stays. Its weight is the logarithm of the ratio of the two shares.
2. exception phrases: a matched word, alone or with the word before or after it, that
   clean documents hold and toxic ones hardly do.
3. the weights found per text, normalised by its length, become a score by logistic
   regression.

Scoring looks for entries and phrases in one pass; an entry inside a phrase is nothing.
Broadcast: lexicon and phrases (at most ``ENTRIES`` and ``PHRASES``), and the ids of the
sample."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from lakeloom.llm.tables import hash_sample, table, written

LABELLED = 20_000
ENTRIES = 2_000
PHRASES = 2_000
SHORTEST, LONGEST = 3, 10
SURE = 4.0
FEWEST = 5
TIMES = 4.0
MOST_SHARE = 0.05        # of one text, so that a text of one repeated word is no outlier
LEAST_SHARE = 2e-5       # added to both shares, so that a weight is finite
PATTERNS_KEPT = 400_000  # of a task, summed up before they are given out

# Letters of other scripts that look like Latin ones.
_LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ѵ": "v", "ӏ": "i",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ϳ": "j",
    "օ": "o", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "ɑ": "a", "ɡ": "g", "ɩ": "i", "ı": "i", "ʟ": "l", "ʀ": "r",
    "ᴀ": "a", "ᴄ": "c", "ᴅ": "d", "ᴇ": "e", "ᴍ": "m", "ᴏ": "o", "ᴛ": "t", "ᴜ": "u", "ø": "o", "ł": "l", "đ": "d",
}
# Digits and signs that stand for letters.
_SIGNS = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
          "@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}

_INVISIBLE = re.compile("[­͏​-‏⁠-⁤︀-️﻿̀-ͯ]+")
_SIGN = re.compile(r"[0-9@$€]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$!|€]+(?=[^\W\d_])")
_GAP = re.compile(r"[\W\d_]+")
_LETTERS = str.maketrans(_LOOK_ALIKES)
_STANDS_FOR = str.maketrans(_SIGNS)


def fold(text: str | None) -> str:
    """The words of ``text`` in folded letters, each between blanks: ``" you idiot "``.
    Null and texts without letters give one blank."""
    text = (text or "").lower()
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).translate(_LETTERS).lower()
    text = _SIGN.sub(lambda m: m[0].translate(_STANDS_FOR), text)
    return (" " + _GAP.sub(" ", text).strip() + " ").replace("l", "i").replace("  ", " ")


@dataclass
class Model:
    weights: dict[str, float]                          # folded entry, with its leading blank -> weight
    phrases: list[str] = field(default_factory=list)   # folded exception phrases, with blanks around
    line: tuple[float, ...] = (-3.0, 0.0, 0.0, 0.0)    # of the logistic regression


class Matcher:
    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for entry, weight in model.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in model.phrases:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(place, weight) of the entries found, the longest of each place, without
        those that lie in an exception phrase."""
        if not len(self.automaton):
            return []
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            if weight is None:
                spared.append((end - size + 1, end))
            else:
                found[end - size + 1] = weight  # a longer one at the same place ends later
        if spared:
            return [(at, w) for at, w in found.items() if not any(a <= at < b for a, b in spared)]
        return list(found.items())


def _features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Rows of constant, root of weight a word, logarithms of weight and length."""
    return np.stack([np.ones(len(total)), np.sqrt(total / (words + 10.0)), np.log1p(total), np.log1p(words)], axis=1)


def _score(model: Model, total: np.ndarray, words: np.ndarray) -> np.ndarray:
    z = np.clip(_features(total, words) @ np.array(model.line), -40, 40)
    return 1 / (1 + np.exp(-z))


def _fit(total: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a slight pull to zero."""
    x, w = _features(total, words), np.zeros(4)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        pull = np.diag([1e-6, 1e-2, 1e-2, 1e-2])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull + 1e-9 * np.eye(4), x.T @ (toxic - p) - pull @ w)
        size = np.abs(step).max()
        w += step * min(1.0, 4.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return tuple(w.tolist())


def _patterns(folded: str) -> Counter:
    """Beginnings of the words of a text, and whole words (with a blank at the end)."""
    found: Counter = Counter()
    for word, n in Counter(folded.split()).items():
        if len(word) >= SHORTEST:
            found[f" {word} "] += n
            for k in range(SHORTEST, min(len(word), LONGEST) + 1):
                found[" " + word[:k]] += n
    return found


_SUMS = ("toxic_n", "toxic_share", "toxic_root", "clean_n", "clean_share", "clean_root")


def _pattern_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pattern -> documents, sum of its shares of the words and of their roots, for toxic
    and for clean documents; from (text, toxic)."""
    held: dict[str, list[float]] = {}

    def rows() -> pa.RecordBatch:
        columns = list(zip(*held.values())) or [()] * 6
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(c, pa.float64()) for c in columns)],
                                           names=["pattern", *_SUMS])
        held.clear()
        return batch

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            folded = fold(text)
            words, at = max(folded.count(" ") - 1, 1), 0 if toxic else 3
            for pattern, n in _patterns(folded).items():
                sums = held.setdefault(pattern, [0.0] * 6)
                share = min(n / words, MOST_SHARE)
                sums[at] += 1
                sums[at + 1] += share
                sums[at + 2] += math.sqrt(share)
            if len(held) > PATTERNS_KEPT:
                yield rows()
    yield rows()


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Entry -> weight, from rows (text, toxic)."""
    sizes = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if toxic < FEWEST or not clean:
        return {}
    sums = labelled.select("text", "toxic").mapInArrow(_pattern_sums, "pattern string, " + ", ".join(f"{c} double" for c in _SUMS))
    sums = sums.groupBy("pattern").agg(*(F.sum(c).alias(c) for c in _SUMS)).where(F.col("toxic_n") >= FEWEST)
    mean_t, mean_c = F.col("toxic_share") / toxic, F.col("clean_share") / clean
    root_t, root_c = F.col("toxic_root") / toxic, F.col("clean_root") / clean
    spread = (mean_t - root_t * root_t) / toxic + (mean_c - root_c * root_c) / clean
    rated = (sums.withColumn("weight", F.log((mean_t + LEAST_SHARE) / (mean_c + LEAST_SHARE)))
             .withColumn("sure", (root_t - root_c) / F.sqrt(F.greatest(spread, F.lit(1e-18)))))
    # sums of doubles depend on the order of tasks, so ranks use rounded figures
    rated = (rated.where((F.col("weight") >= math.log(TIMES)) & (F.col("sure") >= SURE))
             .select("pattern", F.round("weight", 6).alias("weight"), F.round("sure", 6).alias("sure"))
             .orderBy(F.desc("sure"), F.desc(F.length(F.trim("pattern"))), F.length("pattern"), "pattern")
             .limit(10 * ENTRIES))
    chosen: dict[str, float] = {}
    above: set[str] = set()     # beginnings of chosen entries
    for row in rated.collect():
        begins = [row.pattern[:k] for k in range(1, len(row.pattern))]
        if row.pattern not in above and not any(b in chosen for b in begins) and len(chosen) < ENTRIES:
            chosen[row.pattern] = row.weight
            above.update(begins)
    return chosen


def _contexts(shared):
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            phrase, flag = [], []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded, here = fold(text), set()
                for at, _ in matcher.hits(folded):
                    end = folded.index(" ", at + 1)
                    here.add(folded[at:end + 1])
                    if at:
                        here.add(folded[folded.rindex(" ", 0, at):end + 1])
                    if end + 1 < len(folded):
                        here.add(folded[at:folded.index(" ", end + 1) + 1])
                phrase += here
                flag += [toxic] * len(here)
            yield pa.RecordBatch.from_arrays([pa.array(phrase, pa.string()), pa.array(flag, pa.int32())], names=["phrase", "toxic"])

    return contexts


def learn_phrases(labelled: DataFrame, weights: dict[str, float]) -> list[str]:
    """Phrases around entries that at least ``FEWEST`` clean documents hold, and a
    smaller share of the toxic ones."""
    if not weights:
        return []
    sizes = {r[0]: r[1] for r in labelled.groupBy("toxic").count().collect()}
    shared = labelled.sparkSession.sparkContext.broadcast(Model(weights))
    counts = (labelled.select("text", "toxic").mapInArrow(_contexts(shared), "phrase string, toxic int")
              .groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")))
    rows = (counts.where((F.col("clean") >= FEWEST) & (F.col("toxic") * sizes.get(0, 0) < F.col("clean") * sizes.get(1, 0)))
            .orderBy(F.desc("clean"), "phrase").limit(PHRASES).collect())
    return [r.phrase for r in rows]


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled ids, chosen by hash; written. Labels
    of one id count once, as toxic if one of them is; labels that are null or neither 0
    nor 1 are left out."""
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("_id IS NOT NULL AND toxic IN (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic")))
    some = hash_sample(known, most, "_id")
    rows = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("text"))
    return written(rows.join(F.broadcast(some), F.col("_doc") == F.col("_id")).select("text", "toxic"), "labelled")


def _totals(shared, at: int):
    """Batches with the text in column ``at``: total weight and number of words."""
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        model = shared.value
        for batch in batches:
            total, words, entries = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for i, text in enumerate(batch.column(at)):
                folded = fold(text.as_py())
                hits = matcher.hits(folded)
                # weights are summed in text order, so equal texts have equal scores
                total[i], entries[i], words[i] = sum(w for _, w in hits), len(hits), max(folded.count(" ") - 1, 0)
            score = _score(model, total, words)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(total),
                 pa.array(entries), pa.array(words.astype(np.int64))],
                names=[*batch.schema.names[:at], *_SCORED])

    return totals


_SCORED = {"score": DoubleType(), "predicted": IntegerType(), "weight": DoubleType(), "n_entries": LongType(), "n_words": LongType()}


def learn(labelled: DataFrame, phrases: list[str] | None = None) -> Model:
    """A model from written rows (text, toxic): `labelled_sample`. ``phrases`` are
    exceptions of the user's own, as plain text. Without toxic or clean rows no entry is
    known and every text has the same low score."""
    weights = learn_lexicon(labelled)
    own = [fold(p) for p in phrases or [] if fold(p).strip()]
    model = Model(weights, sorted({*own, *learn_phrases(labelled, weights)}))
    shared = labelled.sparkSession.sparkContext.broadcast(model)
    rows = labelled.select("toxic", "text").mapInArrow(_totals(shared, 1), StructType(
        [StructField("toxic", IntegerType()), *(StructField(c, t) for c, t in _SCORED.items())]))
    found = rows.select("toxic", "weight", "n_words").orderBy("toxic", "weight", "n_words").toArrow()
    if found.num_rows:
        toxic, total, words = (np.array(found.column(c), np.float64) for c in ("toxic", "weight", "n_words"))
        if 0 < toxic.sum() < len(toxic):
            model.line = _fit(total, words, toxic)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (default: all) with score (0 to 1), predicted (1 if score
    >= 0.5), weight, n_entries and n_words of the whole texts; columns of these names
    are replaced.

    Null, empty and blank texts have no words and the score of a text without entries.
    Equal texts have equal scores. A very long text is folded whole: memory is a few
    times its size. An empty table gives no rows."""
    kept = [c for c in (columns or docs.columns) if c not in _SCORED]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_text"))
    schema = StructType([*(docs.schema[c] for c in kept), *(StructField(c, t) for c, t in _SCORED.items())])
    return rows.mapInArrow(_totals(shared, len(kept)), schema)


def _remainder(column: str):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(5))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored; learned from labels whose id has a remainder other than 0.
    A null id is not held out, and no label has it."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = learn(labelled_sample(docs, labels.where(_remainder("doc_id") != 0)))
    return (score(docs, model, columns=["doc_id"])
            .select("doc_id", F.coalesce(_remainder("doc_id") == 0, F.lit(False)).alias("held_out"), "score", "predicted",
                    "weight", "n_entries", "n_words"))
