import math
import random
from collections import Counter

import numpy as np
import pytest

from lakeloom.llm import lattice
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs


def all_cuts(text, weight):
    """Every way to cut ``text`` into pieces, with its weight."""
    if not text:
        yield (), 1.0
    for n in range(1, len(text) + 1):
        if text[:n] in weight:
            i, w = weight[text[:n]]
            for rest, more in all_cuts(text[n:], weight):
                yield (i, *rest), math.exp(w) * more


def test_shares_of_cuts_are_those_of_the_lattice():
    weight = {" ": (0, 0.2), "a": (1, 0.5), "b": (2, 0.3), " a": (3, 0.4), "ab": (4, 0.2), "ba": (5, 0.6), "aba": (6, 0.1)}
    weight = {text: (i, math.log(w)) for text, (i, w) in weight.items()}
    pieces = lattice.Pieces(weight, list(range(100, 356)), [])
    net = lattice.Lattices(pieces)
    n = 40_000
    ends = np.full(n, net[" abab"])
    ids, count = lattice.sample(net, ends, np.arange(n).astype(np.uint64) * np.uint64(7919), np.zeros(n, np.uint64))
    at = np.cumsum(count) - count
    seen = Counter(tuple(ids[a:a + c].tolist()) for a, c in zip(at, count))
    cuts = dict(all_cuts(" abab", weight))
    whole = sum(cuts.values())
    assert set(seen) <= set(cuts)
    for cut, w in cuts.items():
        p = w / whole
        assert abs(seen[cut] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


def test_long_chunks_do_not_underflow():
    net = lattice.Lattices(lattice.load_pieces())
    text = "".join(random.Random(3).choice("abcdeéß漢▁") for _ in range(5000))
    out = lattice._sampled([text], np.array([5], np.uint64), net).to_pylist()[0]
    assert b"".join(net.pieces.spelled[i] for i in out)[1:].decode() == text


def test_what_was_met_again_is_kept_and_draws_the_same(monkeypatch):
    texts = [f"often 漢é\x01 seen word{k} \U0001f600{k}" for k in range(40)]
    keys = np.arange(40).astype(np.uint64)
    whole, net = (lattice.Lattices(lattice.load_pieces()) for _ in range(2))
    want = lattice._sampled(texts, keys, whole).to_pylist()
    filtered, add = [], net.add
    net.add = lambda chunks: (filtered.extend(chunks), add(chunks))
    got = []
    for k in range(40):
        if k in (5, 20, 21):
            net.shrink()
        got += lattice._sampled([texts[k]], keys[k:k + 1], net).to_pylist()
    assert got == want
    assert filtered.count(" often") == filtered.count(" 漢é\x01") == 1 and " word1" not in net and " often" in net
    assert len(net.piece) < len(whole.piece) and (np.diff(net.first) > 0).all()
    monkeypatch.setattr(lattice, "EDGES", 4)
    net.shrink()
    assert not net and not len(net.piece)


def test_pieces_do_not_depend_on_partitions_and_come_back(spark):
    docs = awkward_docs(spark).withColumnRenamed("label", "ids")
    once = lattice.decode(lattice.encode(docs.repartition(1)))
    again = lattice.encode(docs.repartition(7))
    rows = once.collect()
    assert all(r.decoded == r.text for r in rows)
    assert all((r.ids is None) == (r.text is None) and (r.text != "" or r.ids == []) for r in rows)
    key = lambda r: str((r.doc_id, r.text, r.ids))
    assert sorted(map(key, rows)) == sorted(map(key, again.collect()))
    other = lattice.encode(docs, seed=1).collect()
    assert sorted(map(key, other)) != sorted(map(key, rows))


def test_empty_table(spark):
    out = lattice.decode(lattice.encode(no_docs(spark)))
    assert out.collect() == [] and "ids" in out.columns


def test_whole_table_is_lossless(spark, sf_dir):
    out = QUERIES["op4_sentencepiece"](spark, sf_dir).toPandas()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(out) == documents.count() and out.lossless.all()
    assert out.n_pieces.min() >= 1


@pytest.mark.parametrize("text", ["", " ", "  a", "a\n\n b ", "▁▁", "tab\tnul\x00"])
def test_round_trip(text):
    net = lattice.Lattices(lattice.load_pieces())
    ids = lattice._sampled([text], np.array([1], np.uint64), net).to_pylist()[0]
    assert b"".join(net.pieces.spelled[i] for i in ids)[1:].decode() == text
