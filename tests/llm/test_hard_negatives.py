import math

import numpy as np
import pytest

from lakeloom.llm import hard_negatives as hn
from lakeloom.llm.queries import QUERIES


def brute(rows):
    """Rows of the contract, all pairs compared with Python's integers."""
    good = []
    for at, (i, e, label) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        good.append((at, i, label, [math.floor(256 * x) for x in e]))
    out = []
    last = lambda i: (i is None, i or 0)
    for at, i, label, v in good:
        if i is None or i % 50:
            continue
        other = [(sum(a * b for a, b in zip(v, w)), last(j), k, j, m) for k, j, m, w in good if k != at and len(w) == len(v)]
        best = sorted((x for x in other if x[4] == label), key=lambda x: (-x[0], *x[1:3]))[:5]
        for p in best:
            found = sorted((x for x in other if x[4] != label and 50 * p[0] <= 100 * x[0] <= 95 * p[0]),
                           key=lambda x: (-x[0], *x[1:3]))[:3]
            out += [(i, p[3], r + 1, x[3], p[0], x[0]) for r, x in enumerate(found)]
    return sorted(out, key=str)


SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, leaf string, score string"


def mined(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return sorted(map(tuple, hn.mine(frame, **more).collect()), key=str)


def as_floats(rows):
    return [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e], n) for i, e, n in rows]


def test_awkward_rows(spark):
    v, w = [1.0, 2.0, 0.5], [0.7, 1.5, 0.1]
    rows = [(0, v, 9), (0, v, 9), (50, w, 0), (50, None, 0), (100, [1.0, None, 2.0], 0), (150, [float("nan"), 1.0, 1.0], 0),
            (200, [float("inf"), 1.0, 1.0], 0), (250, v, None), (300, [], 0), (350, [], 1), (351, [], 0), (400, [1.0, 2.0], 0),
            (401, [1.0, 2.1], 0), (402, [0.9, 1.6], 1), (None, v, 0), (None, w, 1), (450, [0.0, 0.0, 0.0], 3), (451, [-1.0, -2.0, 0.0], 3),
            (452, [0.6, 1.1, 0.2], 4), (453, [0.6, 1.1, 0.2], 4), (454, [0.6, 1.1, 0.2], 5), (7, w, 9), (14, w, 9)]
    assert mined(spark, rows) == brute(as_floats(rows))
    assert mined(spark, []) == []


@pytest.mark.parametrize("sample, leaf", [(4, 2), (200, 10), (4096, 512)])
def test_any_tree_finds_everything(spark, sample, leaf):
    draw = np.random.RandomState(3)
    centres = draw.normal(size=(10, 8))
    rows = []
    for i in range(600):
        label = int(draw.randint(10))
        rows.append((i * 5, (centres[label] + draw.normal(size=8) * draw.choice([0.3, 1.5])).round(1).tolist(), label))
    hot = (centres[3] * 1.1).tolist()
    rows += [(10_000 + i, hot, 3) for i in range(150)] + [(20_000 + i, hot, 4) for i in range(40)]
    assert mined(spark, rows, sample=sample, leaf=leaf) == brute(as_floats(rows))


def test_blocks_of_a_hot_leaf(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    draw = np.random.RandomState(5)
    rows = [(i * 10, (np.array([1, 2, 3, 4.0]) + draw.normal(size=4) * 0.2).tolist(), i % 3) for i in range(200)]
    assert mined(spark, rows, leaf=10**9) == brute(as_floats(rows))


def test_leaves_are_left_out():
    draw = np.random.RandomState(1)
    x = np.concatenate([draw.normal(size=(200, 4)) * 0.1 + c for c in np.eye(4) * 20])
    tree = hn.Tree(float((x * x).sum(axis=1).max()))
    lifted = tree.lift(x)
    tree.grow(lifted, 1.0, 100)
    tree.low = [np.full((len(p),) * 2, np.inf) for p, _ in tree.nodes]
    tree.high = [-low for low in tree.low]

    def seen(node, away, child):
        for j in np.unique(child):
            tree.low[node][:, j] = np.minimum(tree.low[node][:, j], away[child == j].min(axis=0))
            tree.high[node][:, j] = np.maximum(tree.high[node][:, j], away[child == j].max(axis=0))

    leaf = tree.place(lifted, seen)
    scores = x @ x.T
    least = np.sort(scores, axis=1)[:, -5]
    inner, outer = tree.annulus((x * x).sum(axis=1), least, scores.max(axis=1))
    query, reached = tree.reached(tree.lift_query(x), inner, outer)
    pairs = set(zip(query.tolist(), reached.tolist()))
    assert all((q, leaf[b]) in pairs for q, b in zip(*np.nonzero(scores >= least[:, None])))
    assert len(pairs) < 0.5 * len(x) * tree.leaves


def test_whole_table(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, folder).collect()), key=str) == brute(rows)
