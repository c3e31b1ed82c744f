import random
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import circulant
from lakeloom.llm.components import components
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs, prose


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def brute(rows):
    """(doc_id, set size, component) of each row, all pairs compared. Rows of one id are
    one document."""
    root = {i: i for i, _ in rows if i is not None}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingle_set(t)) for i, t in rows]
    holders: dict = {}
    for n, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders.setdefault(x, []).append(n)
    for n, (i, s) in enumerate(sets):
        if i is None:
            continue
        for m, shared in Counter(m for x in s for m in holders[x] if m < n).items():
            if 100 * shared >= 75 * (len(s) + len(sets[m][1]) - shared):
                a, b = top(i), top(sets[m][0])
                root[max(a, b)] = min(a, b)
    return Counter((i, len(s), None if i is None else top(i)) for i, s in sets)


def as_rows(out):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in out)


def test_signature_is_two_permutations_with_shifts():
    scatter, shifted = circulant._permutations()
    n, width = circulant.UNIVERSE, circulant.BANDS * circulant.ROWS
    second = shifted[:, 0]
    assert sorted(scatter[:: n // 64].tolist()) == sorted(set(scatter[:: n // 64].tolist()))
    assert np.bincount(scatter).max() == 1 and np.bincount(second).max() == 1
    found = circulant.shingles(prose(5, 3000), circulant.WordHashes())
    places = [int(scatter[int(x) % n]) for x in found]
    want = [min(int(second[(p + k) % n]) for p in places) for k in range(width)]
    assert circulant.signature(found).tolist() == want


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = circulant.near_duplicates(docs).collect()
    assert as_rows(out) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    left = circulant.drop_near_duplicates(docs)
    gone = {r.doc_id for r in out if not r.kept}
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i, _ in rows if i not in gone)
    assert left.columns == docs.columns
    assert circulant.near_duplicates(no_docs(spark)).collect() == []


def test_chains_and_hot_groups(spark, monkeypatch):
    """Chains in which neighbours link and the ends do not, a group of near copies larger
    than a block, and documents that share a passage without being copies."""
    monkeypatch.setattr(circulant, "BLOCK", 8)
    monkeypatch.setattr(circulant, "STAR", 10)
    draw = random.Random(6)
    base = prose(77, 120).split()
    rows = []
    for chain in range(12):
        words = prose(chain, 100).split()
        for step in range(8):
            rows.append(" ".join(words))
            words = words[9:] + [f"w{draw.randint(0, 10**6)}" for _ in range(9)]
    for _ in range(60):
        words = list(base)
        for _ in range(2):
            words[draw.randrange(len(words))] = f"v{draw.randint(0, 10**6)}"
        rows.append(" ".join(words))
    passage = prose(99, 60)
    rows += [passage + " " + prose(1000 + k, 60) for k in range(30)] + [prose(5, 4), prose(5, 4)]
    draw.shuffle(rows)
    data = list(enumerate(rows))
    out = circulant.near_duplicates(spark.createDataFrame(data, "doc_id bigint, text string")).collect()
    assert as_rows(out) == brute(data)


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert as_rows(QUERIES["op9_minhash"](spark, sf_dir).collect()) == brute(rows)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9)],
                                   [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(39, 130)]])
def test_components(spark, edges):
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert {(r.node, r.component) for r in got} == {(n, c) for n, c in root.items() if n not in loops}
    assert len(got) == len({r.node for r in got})
