from collections import Counter

import pytest

import corpus_pipeline
from lakeloom.llm import lattice
from lakeloom.llm.tables import table, written
from tests.llm import test_circulant, test_decision_list, test_mixing
from tests.llm.cases import awkward_texts, prose


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = written(stage(spark, docs, sf_dir), name)
        rows = after.collect()
        if name != "sentence_pieces":
            assert after.columns == docs.columns
        if name == "quality_rules":
            want = {r.doc_id for r in before if not test_decision_list.failed(test_decision_list.counts(r.text))}
            kept = {r.doc_id for r in rows}
            assert kept <= want and all(i in kept for i in want if labels.get(i) == 1)
            assert not any(labels.get(i) == 0 for i in kept)
        elif name == "near_duplicates":
            found = test_circulant.brute([(r.doc_id, r.text) for r in before])
            assert Counter(r.doc_id for r in rows) == Counter({i: n for (i, _, c), n in found.items() if i == c})
        elif name == "mix_sources":
            want = Counter()
            for (i, _, _, _, copies), n in test_mixing.brute([(r.doc_id, r.text, r.source) for r in before]).items():
                want[i] += copies * n
            assert Counter(r.doc_id for r in rows) == +want
        else:
            text = {r.doc_id: r.text for r in before}
            back = lattice.decode(after).collect()
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before)
            assert all(r.decoded == text[r.doc_id] and r.n_pieces == len(r.ids) for r in back)
        docs = after
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter(r.doc_id for r in docs.collect())


CLASH = ("_source _source_size _target _epochs _last_key _key _copy _copies _document document number own nameless first n col "
         "n_words kept base_failed _words _counts component_id _gone node ids _ids n_pieces size label").split()


def clashing(spark, id_type="bigint"):
    """Awkward texts with null, repeated and unique ids and with columns of the names that
    the operators use; the columns tell the rows apart. ``mark`` is the number of the row."""
    texts = [*awkward_texts(), prose(1, 80), prose(1, 80), prose(1, 80) + " end", prose(7, 90), prose(7, 90)]
    ids = [None if k % 5 == 0 else 100 - k // 2 for k in range(len(texts))]
    as_id = (lambda i: i) if id_type == "bigint" else (lambda i: None if i is None else f"id-{i}")
    rows = [(as_id(i), t, "en", ["a", None, "b"][k % 3], k, *[f"{c}{k}" for c in CLASH]) for k, (i, t) in enumerate(zip(ids, texts))]
    names = ", ".join(f"`{c}` string" for c in CLASH)
    return spark.createDataFrame(rows, f"doc_id {id_type}, text string, lang string, source string, mark int, {names}")


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_quality_stage_keeps_rows_as_they_are(spark, sf_dir):
    docs = clashing(spark)
    got = stage("quality_rules")(spark, docs, sf_dir)
    want = [r for r in docs.collect() if not test_decision_list.failed(test_decision_list.counts(r.text))]
    assert got.columns == docs.columns and len(want) > 3
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want), key=str)


@pytest.mark.parametrize("id_type", ["bigint", "string"])
def test_duplicates_stage_keeps_one_row_of_each_group(spark, sf_dir, id_type):
    docs = clashing(spark, id_type)
    rows = docs.collect()
    groups = {}
    for number, _, component in test_circulant.brute([(r.mark, r.text) for r in rows]):
        groups.setdefault(component, []).append(rows[number])
    out = stage("near_duplicates")(spark, docs, sf_dir)
    got = {r.mark: r for r in out.collect()}
    assert out.columns == docs.columns and out.count() == len(got) == len(groups) < len(rows)
    assert all(r == rows[mark] for mark, r in got.items())
    for group in groups.values():
        kept = [r for r in group if r.mark in got]
        named = [r.doc_id for r in group if r.doc_id is not None]
        assert len(kept) == 1 and kept[0].doc_id == min(named, default=None)


def test_mixing_stage_keeps_rows_as_they_are(spark, sf_dir):
    docs = clashing(spark)
    rows = {r.mark: r for r in docs.collect()}
    out = stage("mix_sources")(spark, docs, sf_dir)
    got = Counter(tuple(r) for r in out.collect())
    assert out.columns == docs.columns and set(got) <= {tuple(r) for r in rows.values()}
    want = test_mixing.brute([(r.doc_id, r.text, r.source) for r in rows.values()])
    by_id = Counter()
    for (i, _, _, _, n), k in want.items():
        by_id[i] += n * k
    assert Counter({i: sum(n for r, n in got.items() if r[0] == i) for i in {r[0] for r in got}}) == +by_id


def test_pieces_stage_and_empty_tables(spark, sf_dir):
    docs = clashing(spark)
    text = Counter(r.text for r in docs.collect())
    out = lattice.decode(stage("sentence_pieces")(spark, docs, sf_dir)).collect()
    assert Counter(r.decoded for r in out) == text
    for name, run in corpus_pipeline.STAGES:
        assert run(spark, docs.limit(0), sf_dir).collect() == []
