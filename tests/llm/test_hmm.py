import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import hmm
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs


def paths(model, codes):
    """Probability of a sequence as the sum over all state paths."""
    total = 0.0
    for path in itertools.product(range(len(model.start)), repeat=len(codes)):
        p = model.start[path[0]] * model.emit[codes[0], path[0]]
        for t in range(1, len(codes)):
            p *= model.step[path[t - 1], path[t]] * model.emit[codes[t], path[t]]
        total += p
    return total


def counts_by_paths(model, codes):
    k, s = len(model.start), len(model.emit)
    start, step, emit = np.zeros(k), np.zeros((k, k)), np.zeros((s, k))
    whole = paths(model, codes)
    for path in itertools.product(range(k), repeat=len(codes)):
        p = model.start[path[0]] * model.emit[codes[0], path[0]]
        for t in range(1, len(codes)):
            p *= model.step[path[t - 1], path[t]] * model.emit[codes[t], path[t]]
        start[path[0]] += p / whole
        for t, (c, z) in enumerate(zip(codes, path)):
            emit[c, z] += p / whole
            if t:
                step[path[t - 1], z] += p / whole
    return start, step, emit


def test_recursions_equal_sums_over_all_paths():
    model = hmm.first_model(np.array([0.4, 0.3, 0.2, 0.1]), states=3)
    model = hmm.Hmm(model.start, np.array([[0.6, 0.3, 0.1], [0.2, 0.5, 0.3], [0.1, 0.1, 0.8]]), model.emit)
    texts = [np.array(c, np.uint16) for c in ([0, 1, 2, 3], [3], [1, 1], [2, 0, 3], [0, 3, 1, 2, 2])]
    logs = hmm.log_likelihoods(model, texts)
    assert logs == pytest.approx([math.log(paths(model, t)) for t in texts])
    start, step, emit, log = hmm.expected_counts(model, texts)
    brute = [sum(x) for x in zip(*(counts_by_paths(model, t) for t in texts))]
    assert start == pytest.approx(brute[0]) and step == pytest.approx(brute[1]) and emit == pytest.approx(brute[2])
    assert log == pytest.approx(logs.sum())


def test_base_score_and_counts_by_hand(spark, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 5)
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    words = lambda t: [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                       for w in re.findall("[^\x20\x09-\x0d]+", t or "")] + ["</end>"]
    out_of_training = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not out_of_training(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, out_of_training(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                    round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 6)) for i, t in rows)
    got = hmm.score(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want


def test_one_state_is_the_unigram_model(spark, monkeypatch):
    monkeypatch.setattr(hmm, "FREQUENT", 20)
    monkeypatch.setattr(hmm, "MIXED", 1.0)
    for r in hmm.score(awkward_docs(spark), states=1, rounds=1).collect():
        assert r.score == pytest.approx(r.base_score, rel=1e-6)


def test_empty_table(spark):
    assert hmm.score(no_docs(spark)).collect() == []


def test_states_help_on_held_out_texts(spark, sf_dir):
    got = QUERIES["op2_hmm"](spark, sf_dir).toPandas()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(got) == documents.count()
    held = got[got.held_out]
    assert 0 < len(held) < len(got) / 5
    assert held.score.sum() > held.base_score.sum()
    assert (got.score < 0).all()


@pytest.mark.parametrize("most,above", [(5, 3), (13, 3), (2, 0), (100, 16)])
def test_vocabulary_is_filled_up(spark, monkeypatch, most, above):
    monkeypatch.setattr(hmm, "FREQUENT", most)
    rows = [(f"many{k}".encode(), 10_000 + k) for k in range(3)] + [(f"few{k}".encode(), 2) for k in range(500)]
    counts = spark.createDataFrame(rows if most < 100 else rows[:16], "word binary, c bigint")
    words = hmm.vocabulary(counts, 7).words
    assert len(words) == len(set(words)) == min(most, counts.count())
    assert set(words) >= {w for w, _ in rows[:above]} and hmm.vocabulary(counts, 7).words == words
    assert most > 2 or words == (b"many2", b"many1")
