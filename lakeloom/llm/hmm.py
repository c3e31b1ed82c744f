"""Hidden Markov language model.

Word counts of all training texts are aggregated in Spark. The ``FREQUENT`` most
frequent words are symbols of their own; each other word is the symbol "rare" times
its share of the rare words, so the model covers every word, also unknown ones, and
its probabilities add up to one. Latent states are trained by Baum-Welch: tasks run
the scaled forward-backward recursion over their texts (many texts in step, so a step
is one matrix product) and emit expected counts, which Spark adds up. Scoring is the
exact scaled forward recursion over the whole text and its end.

Bounds: broadcast and driver hold the parameters, (FREQUENT + 2) x STATES numbers.
Rare words, whose number grows with the corpus, are joined to their counts in Spark."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.tables import table, written

FREQUENT = 32_000     # most words that are symbols of their own; ids fit 16 bits
STATES = 8
ROUNDS = 3            # of Baum-Welch
SMOOTH = 0.1          # added to each count
MIXED = 0.1           # share of the unigram in each state's emissions
CHUNK = 500_000       # tokens in step at once when training
FLUSH = 300_000       # distinct words counted in a task before it emits them
FOLDS = 10


def held_out(doc_id: Column) -> Column:
    """Fold 0 of crc32 of the id; a null id is in training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _words(text) -> list[bytes]:
    """Lower case of A-Z, split at the six ASCII blanks."""
    return (text.as_py() or "").encode().lower().split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0):
            counts.update(_words(text))
            if len(counts) >= FLUSH:
                yield rows(counts)
                counts = Counter()
    yield rows(counts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all texts of a one-column frame."""
    return texts.mapInArrow(_counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """Symbols: 0..k-1 the frequent words, k rare words, k + 1 the end of a text."""

    words: tuple[bytes, ...]
    base: np.ndarray       # log10 unigram of each symbol's word (0 for rare)
    share: np.ndarray      # unigram probability of each symbol (rare: of all rare words)
    known: np.ndarray      # whether the symbol's word was met in training
    denominator: float     # N + SMOOTH * (V + 1)
    rare: float            # rare tokens + SMOOTH * (rare words + 1)
    total: int             # training tokens


def _most_frequent(counts: DataFrame) -> list:
    """The ``FREQUENT`` most frequent words (all, if there are no more), by count and
    word; of the words with the last count those with the smallest hashes.

    Whole sixteenths of an octave of counts are taken first, then whole counts of the
    step that is too large, then words of one count under a hash bound, so that no task
    sends words that are not taken, but for some of the last."""
    step = F.floor(F.log2("c") * 16)
    top, held = [], 0

    def whole(sizes: list) -> tuple:
        """Least level whose words all fit, and the level that is too large."""
        nonlocal held
        low = None
        for level, n in sorted(sizes, reverse=True):
            if held + n > FREQUENT:
                return low, level
            held, low = held + n, level
        return low, None

    low, over = whole([tuple(r) for r in counts.groupBy(step.alias("step")).agg(F.count("*")).collect()])
    if low is not None:
        top += counts.where(step >= low).collect()
    if over is not None and held < FREQUENT:
        inside = counts.where(step == over)
        sizes = {r[0]: r[1] for r in inside.groupBy("c").agg(F.count("*")).collect()}
        low, over = whole(list(sizes.items()))
        if low is not None:
            top += inside.where(F.col("c") >= low).collect()
        if over is not None and held < FREQUENT:
            place, need = F.pmod(F.xxhash64("word"), F.lit(1 << 31)), FREQUENT - held
            bound = min(1.0, (1.5 * need + 100) / sizes[over])
            top += (inside.where((F.col("c") == over) & (place < int(bound * (1 << 31)))).orderBy(place, "word")
                    .limit(need).collect())
    return sorted(top, key=lambda r: (-r["c"], r["word"]))


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    top = _most_frequent(counts)
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, distinct = n + ends, v + (1 if ends else 0)
    denominator = total + SMOOTH * (distinct + 1)
    c = np.array([row["c"] for row in top] + [0, ends], np.float64)
    frequent = len(top)
    rare = n - c[:frequent].sum() + SMOOTH * (v - frequent + 1)
    base = np.log10((c + SMOOTH) / denominator)
    base[frequent] = 0.0
    share = (c + SMOOTH) / denominator
    share[frequent] = rare / denominator
    known = c > 0
    return Vocabulary(tuple(bytes(row["word"]) for row in top), base, share / share.sum(), known, denominator, rare, total)


def _encoder(words):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = len(words.value)
        ids = {w: i for i, w in enumerate(words.value)}
        end = np.array([rare + 1], np.uint16).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                codes, names, times = [], [], []
                for text in part.column(2):
                    tokens = _words(text)
                    own = [ids.get(w, rare) for w in tokens]
                    codes.append(np.array(own, np.uint16).tobytes() + end)
                    others = Counter([w for w, i in zip(tokens, own) if i == rare])
                    names.append(list(others))
                    times.append(list(others.values()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(3), pa.array(codes, pa.binary()),
                     pa.array(names, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))],
                    names=["row", "doc_id", "held_out", "codes", "rare", "times"])

    return encoded


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Per row: row (a number of its own), doc_id, held_out, codes (symbols with the
    end), rare words and how often each occurs. Written once."""
    words = docs.sparkSession.sparkContext.broadcast(vocab.words)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text",
                           held_out(F.col("doc_id")).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(numbered.mapInArrow(_encoder(words), f"row bigint, doc_id {kind}, held_out boolean, codes binary, "
                                                        "rare array<binary>, times array<bigint>"), "encoded")


@dataclass(frozen=True)
class Hmm:
    start: np.ndarray      # (states,)
    step: np.ndarray       # (states, states)
    emit: np.ndarray       # (symbols, states)


def first_model(share: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
    """States that tend to stay, each with the unigram times its own factors."""
    draw = np.random.RandomState(seed)
    emit = share[:, None] * draw.exponential(1.0, (len(share), states)) + 1e-12
    step = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    return Hmm(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def _in_step(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, longest first, as one array of steps: symbols, where each step starts,
    and the order of the texts."""
    lengths = np.array([len(c) for c in codes])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    offsets = np.concatenate([[0], np.cumsum(active)])
    symbols = np.empty(offsets[-1], np.int64)
    for i, k in enumerate(order):
        symbols[offsets[: lengths[i]] + i] = codes[k]
    return symbols, offsets, order


def expected_counts(model: Hmm, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, steps and emissions of some texts, and their log likelihood."""
    symbols, offsets, _ = _in_step(codes)
    steps, states = len(offsets) - 1, len(model.start)
    emit = model.emit[symbols]
    alpha, scale = np.empty_like(emit), np.empty(len(symbols))
    for t in range(steps):
        own = slice(offsets[t], offsets[t + 1])
        n = offsets[t + 1] - offsets[t]
        a = emit[own] * (alpha[offsets[t - 1]: offsets[t - 1] + n] @ model.step if t else model.start)
        scale[own] = s = a.sum(axis=1)
        alpha[own] = a / s[:, None]
    moved = np.zeros((states, states))
    beta = np.ones((offsets[steps] - offsets[steps - 1], states))
    for t in range(steps - 2, -1, -1):
        own, n = slice(offsets[t + 1], offsets[t + 2]), offsets[t + 2] - offsets[t + 1]
        w = emit[own] * (beta / scale[own][:, None])
        alpha[own] *= beta                       # the posterior of the later step
        before = alpha[offsets[t]: offsets[t] + n]
        moved += before.T @ w
        back = np.ones((offsets[t + 1] - offsets[t], states))
        back[:n] = w @ model.step.T
        beta = back
    alpha[: offsets[1]] *= beta
    seen = np.stack([np.bincount(symbols, alpha[:, k], len(model.emit)) for k in range(states)], axis=1)
    return alpha[: offsets[1]].sum(axis=0), moved * model.step, seen, float(np.log(scale).sum())


def log_likelihoods(model: Hmm, codes: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each text by the scaled forward recursion."""
    symbols, offsets, order = _in_step(codes)
    total = np.zeros(len(codes))
    a = None
    for t in range(len(offsets) - 1):
        n = offsets[t + 1] - offsets[t]
        e = model.emit[symbols[offsets[t]: offsets[t + 1]]]
        a = e * (a[:n] @ model.step) if t else e * model.start
        s = a.sum(axis=1)
        a /= s[:, None]
        total[:n] += np.log(s)
    found = np.empty(len(codes))
    found[order] = total
    return found


def _chunks(codes: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for c in codes:
        held.append(c)
        size += len(c)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _baum_welch(shared):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        states, symbols = len(model.start), len(model.emit)
        # rows: the symbols, then one row of starts, then the rows of the steps
        sums = np.zeros((symbols + 1 + states, states))
        likelihood, any_text = 0.0, False
        for codes in _chunks(np.frombuffer(c.as_buffer(), np.uint16) for b in batches for c in b.column(0)):
            start, step, emit, log = expected_counts(model, codes)
            sums[:symbols] += emit
            sums[symbols] += start
            sums[symbols + 1:] += step
            likelihood, any_text = likelihood + log, True
        if any_text:
            used = np.flatnonzero(sums.any(axis=1))
            columns = [pa.array(used, pa.int32()), *(pa.array(sums[used, k]) for k in range(states))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", *(f"s{k}" for k in range(states))])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([likelihood]),
                                              *(pa.array([0.0]) for _ in range(states - 1))],
                                             names=["place", *(f"s{k}" for k in range(states))])

    return counted


def train(encoded: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> tuple[Hmm, list[float]]:
    """Model after ``rounds`` of Baum-Welch over the rows that are not held out, and
    the log likelihood before each round."""
    spark = encoded.sparkSession
    model, history = first_model(vocab.share, states), []
    symbols = len(vocab.share)
    kind = ", ".join(["place int", *(f"s{k} double" for k in range(states))])
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        summed = (encoded.where("NOT held_out").select("codes").mapInArrow(_baum_welch(shared), kind).groupBy("place")
                  .agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)]))
        rows = np.array([tuple(r) for r in summed.collect()]).reshape(-1, states + 1)
        if not len(rows):
            break
        sums = np.zeros((symbols + 1 + states, states))
        at = rows[:, 0].astype(int)
        history.append(float(rows[at == -1, 1].sum()))
        sums[at[at >= 0]] = rows[at >= 0, 1:]
        emit = sums[:symbols]
        emit = (1 - MIXED) * emit / np.maximum(emit.sum(axis=0), 1e-300) + MIXED * vocab.share[:, None]
        start = sums[symbols] + 1e-3
        step = sums[symbols + 1:] + 1e-3
        model = Hmm(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model, history


def _scorer(shared, vocab_shared):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (base, known) = shared.value, vocab_shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                codes = [np.frombuffer(c.as_buffer(), np.uint16) for c in part.column(3)]
                starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])])[:-1]
                joined = np.concatenate(codes)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2),
                     pa.array([len(c) for c in codes], pa.int64()),
                     pa.array(np.add.reduceat(known[joined].astype(np.int64), starts), pa.int64()),
                     pa.array(np.add.reduceat(base[joined], starts)),
                     pa.array(log_likelihoods(model, codes) / np.log(10))],
                    names=["row", "doc_id", "held_out", "n_tokens", "_known", "_base", "_score"])

    return scored


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score. Learns from the rows that are not held out.

    A null text is empty and has one token, its end. A null doc_id is in training.
    Repeated rows are rows of their own with equal scores (each counts in training).
    Other columns are not read; an empty table gives an empty result."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    training = docs.where(~held_out(F.col("doc_id")))
    counts = written(word_counts(training.select("text")), "counts")
    vocab = vocabulary(counts, training.count())
    encoded = encode(docs, vocab)
    model, _ = train(encoded, vocab, states, rounds)

    kind = docs.schema["doc_id"].dataType.simpleString()
    symbols = encoded.select("row", "doc_id", "held_out", "codes").mapInArrow(
        _scorer(spark.sparkContext.broadcast(model), spark.sparkContext.broadcast((vocab.base, vocab.known))),
        f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, _known bigint, _base double, _score double")
    rare = encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    count = F.coalesce("c", F.lit(0))
    by_row = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum("times").alias("_rare"), F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("_rare_known"),
        F.sum(F.col("times") * F.log10(count + F.lit(SMOOTH))).alias("_logs"))
    number, logs = F.coalesce("_rare", F.lit(0)), F.coalesce("_logs", F.lit(0.0))
    return symbols.join(by_row, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("_known") + F.coalesce("_rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("bigint").alias("train_tokens"),
        (F.col("_base") + logs - number * float(np.log10(vocab.denominator))).alias("base_score"),
        (F.col("_score") + logs - number * float(np.log10(vocab.rare))).alias("score"))


def op2_hmm(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"))
