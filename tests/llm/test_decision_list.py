import random
import re
from collections import Counter

from lakeloom.llm import decision_list as d
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs, prose


def counts(text):
    """The fixed counts of one text, read off their definitions."""
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def test_awkward_rows(spark):
    docs = awkward_docs(spark).withColumn("_words", d.F.lit("x"))
    rule = [(d.Condition("symbol_share", True, 0.1),)]
    out = d.judge(docs, rule)
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns.count("n_words") == out.columns.count("kept") == 1
    for r in rows:
        c = counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c, r.text
        assert r.base_failed == failed(c) and r.kept == (not failed(c) and c[2] <= 0.1 * max(c[1], 1))
    assert d.judge(no_docs(spark), rule).collect() == []


def test_hash_collisions_change_nothing(spark, monkeypatch):
    """With all window hashes equal, words still decide."""
    monkeypatch.setattr(d.F, "xxhash64", lambda *c: d.F.lit(7).cast("bigint"))
    rows = [(prose(1, 60),), ("a b c x a b c y a b z",), ("q " * 9,)]
    for r in d.text_statistics(spark.createDataFrame(rows, "text string")).collect():
        assert r.n_repeat_words == counts(r.text)[4]


def test_rules_find_a_planted_concept():
    draw = random.Random(4)
    rows = []
    for _ in range(3000):
        row = {f: draw.random() for f in d.FEATURES}
        row["junk"] = row["symbol_share"] > 0.9 or (row["upper_share"] > 0.8 and row["word_length"] < 0.3)
        rows.append(row)
    rules = d.learn_rules(rows)
    said = [any(all((r[c.feature] > c.threshold) == c.above for c in rule) for rule in rules) for r in rows]
    assert sum(a == r["junk"] for a, r in zip(said, rows)) >= 0.98 * len(rows)
    assert sum(a and not r["junk"] for a, r in zip(said, rows)) <= 0.005 * len(rows)


def test_nothing_to_learn(spark):
    assert d.learn_rules([]) == []
    assert d.learn_rules([{f: 1.0 for f in d.FEATURES} | {"junk": False}] * 10) == []
    labels = spark.createDataFrame([(None, 1), (1, None), (999, 0)], "doc_id bigint, quality int")
    assert d.labelled_statistics(awkward_docs(spark), labels) == []


def test_whole_table_and_held_out_accuracy(spark, sf_dir):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = QUERIES["op5_quality_rules"](spark, sf_dir).collect()
    assert len(out) == len(documents)
    for r in out:
        c = counts(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (*c, failed(c))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    half = d.labelled_statistics(docs, labels.where("doc_id % 2 = 0"))
    other = d.judge(docs, d.learn_rules(half)).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in other) >= 0.97 * len(other)
    assert all(r.kept for r in other if r.quality == 1)
