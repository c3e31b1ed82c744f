import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakeloom.llm import pivots
from lakeloom.llm.queries import QUERIES


def brute(rows):
    """(vec_id, n_links, component) of each row, all pairs compared."""
    good = [i for i, (v, e, l) in enumerate(rows) if v is not None and l is not None and e
            and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    root, links = list(range(len(rows))), Counter()

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    by = defaultdict(list)
    for i in good:
        by[rows[i][2], len(rows[i][1])].append(i)
    for ids in by.values():
        m = np.array([rows[i][1] for i in ids], np.float64)
        m /= np.linalg.norm(m, axis=1)[:, None]
        close = m @ m.T >= 0.98
        np.fill_diagonal(close, False)
        for a, b in zip(*np.nonzero(close)):
            links[ids[a]] += 1
            root[top(ids[a])] = top(ids[b])
    low = {}
    for i in good:
        low[top(i)] = min(low.get(top(i), rows[i][0]), rows[i][0])
    return Counter((rows[i][0], links[i], low.get(top(i), rows[i][0]) if i in set(good) else rows[i][0])
                   for i in range(len(rows)))


def as_rows(out):
    return Counter((r.vec_id, r.n_links, r.component_id) for r in out)


SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, component string, `class` string"


def test_awkward_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0),
            (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 2.0], 0), (9, [float("nan"), 1.0, 1.0], 0),
            (10, [float("inf"), 1.0, 1.0], 0), (11, [], 0), (12, [1.0, 2.0], 0), (None, v, 0), (13, [-1.0, -2.0, -3.0], 0),
            (14, [1e-30, 2e-30, 3e-30], 0), (15, [1.0, 2.0, 3.4], 0), (12, [5.0, -2.0], 0)]
    out = pivots.near_duplicates(spark.createDataFrame([r + ("x",) * 3 for r in rows], SCHEMA)).collect()
    assert as_rows(out) == brute([(a, None if b is None else [None if x is None else np.float32(x).item() for x in b], c)
                                  for a, b, c in rows])
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert pivots.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_list_in_blocks_is_whole(spark, monkeypatch):
    draw = np.random.RandomState(2)
    centre = draw.normal(size=16)
    rows = [(i, (centre + draw.normal(size=16) * 0.08).astype(np.float32).tolist(), 1) for i in range(150)]
    rows += [(1000 + i, draw.normal(size=16).astype(np.float32).tolist(), 1) for i in range(150)]
    monkeypatch.setattr(pivots.near_links, "__defaults__", (20,))
    got, want = as_rows(pivots.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"))
                        .collect()), brute(rows)
    assert sum(n * k for (_, n, _), k in got.items()) >= 0.99 * sum(n * k for (_, n, _), k in want.items())
    assert {(v, c) for v, _, c in got} == {(v, c) for v, _, c in want}


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, folder):
    path = f"/root/testdata/{folder}"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    want = brute(rows)
    got = as_rows(QUERIES["op7_pivots"](spark, path).collect())
    found, there = (sum(n * k for (_, n, _), k in x.items()) for x in (got, want))
    assert len(rows) == sum(got.values()) and 0.99 * there <= found <= there
