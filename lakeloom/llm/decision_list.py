"""Quality rules as a learned decision list.

Text statistics are SQL expressions over the whole text. Sequential covering learns
ordered rules from labelled statistics: a rule grows on two thirds of the rows by
the threshold condition of best information gain, is pruned on the other third, is
kept only if it is precise there, and its rows are set aside before the next rule
grows. The list is emitted as one conditional expression, ``CASE WHEN rule 1 THEN
false WHEN rule 2 ... ELSE true END``, so applying it costs a projection.

Learning collects at most `MAX_LABELLED` rows of a few numbers (chosen by hash of
the id); covering works on them as bit sets. Everything else covers all rows."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.tables import BLANK, hash_sample, table, words_of

MAX_LABELLED = 20_000
MIN_WORDS = 50
#: Bits for a word position in a packed (hash, position) number.
_POSITION = 31

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bangs", "n_upper", "n_lines",
          "n_distinct_words")
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "bang_share": "n_bangs / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "distinct_words": "n_distinct_words / greatest(n_words, 1)",
    "words": "double(n_words)",
}


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of its whole texts: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_bangs, n_upper, n_lines, n_distinct_words (long).
    Columns of these names are replaced. Null and empty texts count 0 everywhere.

    Words in repeated 3-word windows are found inside the row: window hashes packed
    with positions are sorted as plain numbers, equal neighbours are candidates, and
    candidates are compared by their words, so a hash collision changes nothing."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    n = F.size("_words")
    at = lambda array, i: F.get(F.col(array), i)
    window_hash = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.shiftleft(F.xxhash64(at("_words", i), at("_words", i + 1), at("_words", i + 2)), _POSITION)
        .bitwiseOR(i.cast("bigint")))
    none = F.array().cast("array<bigint>")
    top = lambda x: F.shiftright(x, _POSITION)
    near = lambda x, i: (top(x) == top(at("_hashes", i + 1))) | (top(x) == top(at("_hashes", i - 1)))
    place = lambda x: x.bitwiseAND(F.lit((1 << _POSITION) - 1)).cast("int")
    spelled = F.transform("_near", lambda x: F.struct(
        F.array(at("_words", place(x)), at("_words", place(x) + 1), at("_words", place(x) + 2)).alias("w"),
        place(x).alias("p")))
    same = lambda x, i: (x["w"] == at("_spelled", i + 1)["w"]) | (x["w"] == at("_spelled", i - 1)["w"])
    covered = F.flatten(F.transform(F.filter("_spelled", same), lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{BLANK}]"))
    counted = (
        df.withColumn("_words", words_of(t)).withColumn("_lines", lines)
        .withColumn("_hashes", F.when(n >= 3, F.sort_array(window_hash)).otherwise(none))
        .withColumn("_near", F.filter("_hashes", near))
        .withColumn("_spelled", F.when(F.size("_near") > 0, F.array_sort(spelled)))
        # exploding one struct keeps Catalyst from moving filters on the counts below
        # this point, where they would repeat the array work for every element
        .withColumn("_counts", F.explode(F.array(F.struct(
            n.cast("bigint").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
            F.when(F.size("_near") > 0, F.size(F.array_distinct(covered))).otherwise(0).cast("bigint")
            .alias("n_repeat_words"),
            F.regexp_count(t, F.lit("!")).cast("bigint").alias("n_bangs"),
            F.regexp_count(t, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
            F.size("_lines").cast("bigint").alias("n_lines"),
            F.size(F.array_distinct("_words")).cast("bigint").alias("n_distinct_words"))))))
    return counted.select(*[F.col(f"`{c}`") for c in df.columns if c not in COUNTS],
                          *[F.col(f"_counts.{c}") for c in COUNTS])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool      # feature > threshold, else feature <= threshold
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _conditions(rows: list[dict], steps: int) -> list[tuple[Condition, int]]:
    """Threshold conditions between distinct values, at most about ``steps`` per
    feature, each with the bit set of the rows it holds for."""
    every, found = (1 << len(rows)) - 1, []
    for name in FEATURES:
        order = sorted(range(len(rows)), key=lambda i: rows[i][name])
        below, last = 0, 0
        for rank, i in enumerate(order[:-1]):
            below |= 1 << i
            value, following = rows[i][name], rows[order[rank + 1]][name]
            if following > value and rank + 1 - last >= len(rows) / steps:
                last, threshold = rank + 1, (value + following) / 2
                found.append((Condition(name, False, threshold), below))
                found.append((Condition(name, True, threshold), every & ~below))
    return found


def _gain(p: int, n: int, was_p: int, was_n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(was_p / (was_p + was_n))) if p else 0.0


def learn_rules(rows: list[dict], junk: str = "junk", steps: int = 256, longest: int = 4, precision: float = 0.98,
                least: int = 3, most_rules: int = 24) -> list[Rule]:
    """Ordered rules that tell junk, from rows with the features and a flag. A rule
    below ``precision`` on the pruning rows, or with under ``least`` junk rows there,
    is dropped, and the feature that it began with is not grown from again; the list
    ends when no feature is left."""
    if not rows:
        return []
    conditions = _conditions(rows, steps)
    grow = sum(1 << i for i, r in enumerate(rows) if i % 3)
    bad = sum(1 << i for i, r in enumerate(rows) if r[junk])
    left, rules, spent = (1 << len(rows)) - 1, [], set()
    while len(rules) < most_rules and len(spent) < len(FEATURES):
        rule: list[tuple[Condition, int]] = []
        held = left & grow
        while len(rule) < longest and held & ~bad:
            p, n = (held & bad).bit_count(), (held & ~bad).bit_count()
            scored = [(_gain((held & m & bad).bit_count(), (held & m & ~bad).bit_count(), p, n), k)
                      for k, (c, m) in enumerate(conditions) if rule or c.feature not in spent] if p else []
            best, k = max(scored, key=lambda x: (x[0], -x[1]), default=(0.0, -1))
            if best <= 0:
                break
            rule.append(conditions[k])
            held &= conditions[k][1]
        worth, kept = -1.0, 0
        for length in range(1, len(rule) + 1):
            m = left & ~grow
            for _, mask in rule[:length]:
                m &= mask
            p, n = (m & bad).bit_count(), (m & ~bad).bit_count()
            if p >= least and p >= precision * (p + n) and (p - n) / (p + n) + p * 1e-9 > worth:
                worth, kept = (p - n) / (p + n) + p * 1e-9, length
        if not rule:
            break
        if not kept:
            spent.add(rule[0][0].feature)
            continue
        rules.append(tuple(c for c, _ in rule[:kept]))
        covered = left
        for _, mask in rule[:kept]:
            covered &= mask
        left &= ~covered
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where no rule tells junk, over a frame of `text_statistics`."""
    chain = None
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        chain = F.when(holds, False) if chain is None else chain.when(holds, False)
    return F.lit(True) if chain is None else chain.otherwise(True)


def base_failed() -> Column:
    """The fixed rule before the learned ones, over a frame of `text_statistics`."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_statistics(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> list[dict]:
    """At most ``most`` labelled rows (by hash of the id) that pass the base rule, as
    the features and ``junk``. Ids and qualities that are null are not labels."""
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality")
    chosen = (hash_sample(usable, most, "doc_id", "quality").groupBy("doc_id").agg(F.max("quality").alias("_quality")))
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    values = [F.expr(e).cast("double").alias(name) for name, e in FEATURES.items()]
    rows = text_statistics(found).where(~base_failed()).select("doc_id", (F.col("_quality") == 0).alias("junk"), *values)
    rows = rows.orderBy(F.xxhash64("doc_id"), *FEATURES).limit(most).drop("doc_id")
    return [row.asDict() for row in rows.collect()]


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the statistics, ``base_failed`` and ``kept``. Null and empty
    texts have no words, so they fail the base rule; equal texts get equal verdicts;
    columns of the same names are replaced; an empty table gives an empty one."""
    return text_statistics(docs).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rules = learn_rules(labelled_statistics(docs, table(spark, folder, "labels")))
    return judge(docs, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                     "base_failed", "kept")
