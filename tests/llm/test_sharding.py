from collections import Counter

import pytest

from lakeloom.llm import sharding
from tests.llm.cases import awkward_docs, no_docs


def test_shares_are_even_and_weighted():
    names = [f"s{i}" for i in range(7)]
    held = Counter(sharding.fill_slots(names, 1009))
    assert set(held) == set(range(7)) and max(held.values()) - min(held.values()) <= 1
    weighted = Counter(sharding.fill_slots(["a", "b"], 1009, [3, 1]))
    assert abs(weighted[0] - 3 * weighted[1]) <= 3


def test_few_keys_move_when_a_shard_leaves():
    names = [f"s{i}" for i in range(10)]
    before = [names[i] for i in sharding.fill_slots(names, 10007)]
    after = [names[1:][i] for i in sharding.fill_slots(names[1:], 10007)]
    moved = sum(a != b for a, b in zip(before, after))
    gone = sum(a == "s0" for a in before)
    assert gone <= moved < 1.6 * gone


@pytest.mark.parametrize("shards,slots", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_bad_parameters(shards, slots):
    with pytest.raises(ValueError):
        sharding.fill_slots(shards, slots)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    out = sharding.place(docs, "doc_id", ["a", "b", "c"], 101)
    rows = out.collect()
    assert len(rows) == docs.count() and out.columns[:2] == ["slot", "shard"] and out.columns.count("shard") == 1
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r.doc_id, (r.slot, r.shard)) == (r.slot, r.shard) and 0 <= r.slot < 101
    assert sharding.place(no_docs(spark), "doc_id", ["a"], 7).collect() == []


def test_written_shards_are_whole(spark, tmp_path):
    placed = sharding.place(awkward_docs(spark).select("doc_id", "text"), "doc_id", ["a", "b", "c"], 101)
    sharding.write_shards(placed, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    key = lambda r: str((r.doc_id, r.text, r.shard))
    assert sorted(map(key, back.collect())) == sorted(map(key, placed.collect()))
