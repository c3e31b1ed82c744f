import math
import zlib

import pytest

from lakeloom.llm import toxicity
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, awkward_texts, no_docs, prose

BAD = ["scum", "moron", "pathetic"]


def labelled(spark, n=240):
    """Every third text holds a bad word; 'scum line' is harmless and only in clean ones."""
    rows = []
    for i in range(n):
        text = prose(i, 40)
        if i % 3 == 0:
            text = text.replace(" ", f" {BAD[i // 3 % 3]} ", 2)
        elif i % 12 == 1:
            text += " scum line"
        rows.append((text, int(i % 3 == 0)))
    return spark.createDataFrame(rows, "text string, toxic int").repartition(3)


@pytest.mark.parametrize("text", ["you IDIOT!", "you 1d10t.", "you ІDІОТ", "you ｉｄｉｏｔ", "you id​iot", "you ídïöt", "you idi0t", "you id|ot", "you id!ot"])
def test_folding(text):
    assert toxicity.fold(text) == " you idiot "


def test_folding_of_nothing():
    assert [toxicity.fold(t) for t in (None, "", " \n ", "12 34 !!", "5%")] == [" "] * 5
    assert toxicity.fold("well-l0ved  $tupid\nTHE!!") == " weii ioved stupid the "


def test_matcher_against_a_plain_search():
    model = toxicity.Model({" idiot": 2.0, " idiotic": 3.0, " scum ": 1.0}, [" scum iine ", " my idiot "])
    matcher = toxicity.Matcher(model)
    folded = toxicity.fold("idiots idiotic scum scumble scum line my idiot the scum")

    def plain():
        for at in range(len(folded)):
            found = [(len(e), w) for e, w in model.weights.items() if folded.startswith(e, at)]
            inside = any(folded.startswith(p, k) and k <= at < k + len(p) - 1
                         for p in model.phrases for k in range(max(0, at - 40), at + 1))
            if found and not inside:
                yield at, max(found)[1]

    assert sorted(matcher.hits(folded)) == sorted(plain())
    assert toxicity.Matcher(toxicity.Model({})).hits(folded) == []


def test_learned_lexicon_and_phrases(spark):
    model = toxicity.learn(labelled(spark), phrases=["Moron Lake"])
    assert set(model.weights) == {" scum", " moron", " pathetic"}
    assert " scum iine " in model.phrases and " moron iake " in model.phrases
    texts = {"plain": prose(900, 40), "bad": "you m0r0n " + prose(901, 30), "spared": prose(902, 40) + " scum line",
             "own": "moron lake " + prose(903, 30), "long": (prose(904, 60) + " moron moron ") * 300}
    got = {r.k: r for r in toxicity.score(spark.createDataFrame(list(texts.items()), "k string, text string"), model).collect()}
    assert {k: r.predicted for k, r in got.items()} == {"plain": 0, "bad": 1, "spared": 0, "own": 0, "long": 1}
    assert got["long"].n_entries == 600 and got["spared"].n_entries == 0
    # the score from its definition
    matched = {" scum": " scum", " moron": " moron"}
    for k, n in (("bad", 1), ("long", 600)):
        total, words = n * model.weights[matched[" moron"]], len(toxicity.fold(texts[k]).split())
        z = sum(a * b for a, b in zip(model.line, (1, math.sqrt(total / (words + 10)), math.log1p(total), math.log1p(words))))
        assert got[k].score == pytest.approx(1 / (1 + math.exp(-z)))


def test_same_model_whatever_the_order(spark):
    rows = labelled(spark)
    one, two = toxicity.learn(rows.repartition(1)), toxicity.learn(rows.repartition(7, "text"))
    assert one.weights == two.weights and one.phrases == two.phrases and one.line == pytest.approx(two.line)


def test_awkward_rows(spark):
    model = toxicity.Model({" one": 2.0}, [], (-2.0, 5.0, 1.0, 0.0))
    docs = awkward_docs(spark)
    out = toxicity.score(docs.withColumnRenamed("key", "score"), model)
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 < r.score < 1 for r in rows)
    assert set(out.columns) == {*docs.columns, "score", "predicted", "weight", "n_entries"} - {"key"}
    none = [r.score for r in rows if not r.text or not r.text.strip()]
    assert len(none) >= 4 and len(set(none)) == 1
    assert {r.weight for r in rows if r.text == "one"} == {2.0} and all(r._key == "x" for r in rows)
    assert toxicity.score(no_docs(spark), model).collect() == []


def test_labels_of_every_kind(spark):
    texts = awkward_texts()
    docs = spark.createDataFrame([(i % 9, t, "x") for i, t in enumerate(texts)] + [(None, "a", "x")], "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (2, None), (3, 7), (None, 1), (99, 1)], "doc_id bigint, toxic int")
    sample = toxicity.labelled_sample(docs, labels)
    assert sorted((r.text or "", r.toxic) for r in sample.collect()) == sorted(
        [(t or "", 1 if i % 9 == 0 else 0) for i, t in enumerate(texts) if i % 9 in (0, 1)])
    model = toxicity.learn(sample)
    assert model.weights == {} and toxicity.learn(sample.limit(0)).weights == {}


def test_nothing_but_text_is_an_input(spark, tmp_path):
    """Held-out labels, ids, sources and languages changed: the scores stay."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    docs.withColumns({c: docs["text"].substr(1, 3) for c in ("lang", "source")}).write.parquet(f"{tmp_path}/documents.parquet")
    held = labels.rdd.map(lambda r: (r.doc_id, r.quality, 1 - r.toxic if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.toxic))
    spark.createDataFrame(held, labels.schema).write.parquet(f"{tmp_path}/labels.parquet")
    one, two = (sorted(map(tuple, QUERIES["op11_toxicity"](spark, p).collect())) for p in (folder, str(tmp_path)))
    assert one == two


def test_held_out_accuracy(spark):
    folder = "/root/testdata/check_s"
    out = QUERIES["op11_toxicity"](spark, folder)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    right = sum(t == p == 1 for t, p in held)
    assert right >= 0.98 * sum(t for t, _ in held) and right >= 0.98 * sum(p for _, p in held)
