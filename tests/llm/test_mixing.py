import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest

from lakeloom.llm import mixing
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs, prose


def dealt(sizes, weights, share=1.5, ceiling=2.0):
    """Deal by weight, stop the full ones, deal the rest again."""
    target, full = dict.fromkeys(sizes, 0.0), set()
    rest = share * sum(sizes.values())
    while True:
        still = [s for s in sizes if s not in full]
        whole = sum(weights[s] for s in still)
        left = rest - sum(ceiling * sizes[s] for s in full)
        over = {s for s in still if left * weights[s] / whole >= ceiling * sizes[s]}
        for s in still:
            target[s] = left * weights[s] / whole
        full |= over
        if not over or len(full) == len(sizes):
            return {s: ceiling * sizes[s] if s in full else target[s] for s in sizes}


def brute(rows):
    """(doc_id, text, source) -> (doc_id, size, source size, target, copies)."""
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    key = lambda i, t: hashlib.md5(f"17|{'' if i is None else i}|{t or ''}".encode()).hexdigest()
    by = defaultdict(list)
    for i, t, s in rows:
        by[s].append((key(i, t), size(t), i))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    totals = {s: sum(x[1] for x in by[s]) for s in names}
    target = dealt(totals, weights)
    out = Counter()
    for s in names:
        epochs = int(target[s] // totals[s]) if totals[s] else 0
        rest, before = target[s] - epochs * totals[s], 0
        for k in sorted({x[0] for x in by[s]}):
            tied = sum(x[1] for x in by[s] if x[0] == k)
            more = rest > 0 and before + tied / 2 <= rest
            before += tied
            for _, n, i in (x for x in by[s] if x[0] == k):
                out[i, n, totals[s], round(target[s], 6), epochs + more] += 1
    return out


def decided(rows):
    return Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.copies) for r in rows)


def test_awkward_rows_and_mix(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = brute(rows)
    sized = mixing.sized_rows(docs)
    cuts = mixing.cut_points(sized)
    joined = mixing._joined(sized.withColumnRenamed("key", "_key"), cuts)
    got = Counter((r.doc_id, r.size, r._source_size, round(r._target, 6), r._copies) for r in joined.collect())
    assert got == want
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter(
        {i: sum(k[4] * n for k, n in want.items() if k[0] == i) for i in {k[0] for k in want}})
    assert mixing.mix(no_docs(spark)).collect() == []


@pytest.mark.parametrize("digits", [1, 3])
def test_hot_source_hits_its_budget(spark, digits):
    rows = [(i, prose(i, 5 + i % 40), "big" if i % 3 else f"s{i % 7}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sized = mixing.sized_rows(frame)
    cuts = mixing.cut_points(sized, digits=digits)
    joined = mixing._joined(sized.withColumnRenamed("key", "_key"), cuts).collect()
    assert Counter((r.doc_id, r.size, r._source_size, round(r._target, 6), r._copies) for r in joined) == brute(rows)
    for s in {r.source for r in joined}:
        own = [r for r in joined if r.source == s]
        assert abs(sum(r.size * r._copies for r in own) - own[0]._target) <= max(r.size for r in own)


def test_whole_table(spark, sf_dir):
    rows = QUERIES["op3_mixing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    assert decided(rows) == brute([tuple(r) for r in docs])
    assert decided(rows) == decided(QUERIES["op3_mixing"](spark, sf_dir).collect())
    assert all(r.taken <= 2 * r.size for r in rows) and math.isclose(sum({r.source_size: r.target for r in rows}.values()),
                                                                  1.5 * sum(r.size for r in rows))
