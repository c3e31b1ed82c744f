import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import wordpiece as w
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs


def greedy(word, pieces):
    """Longest piece first, built; -1 if the word cannot be cut."""
    rest, n = w.START + word, 0
    while rest:
        k = next((k for k in range(len(rest), 0, -1) if rest[:k] in pieces), 0)
        if not k:
            return -1
        rest, n = rest[k:], n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=5), max_size=20), st.lists(st.text("abcd", max_size=12), max_size=10))
def test_automaton_counts_as_the_greedy_cut_does(pieces, words):
    vocabulary = {(w.START if i % 2 else "") + p for i, p in enumerate(pieces)} | {w.START}
    automaton = w.Automaton(sorted(vocabulary))
    for word in words:
        assert automaton.count(word) == greedy(word, vocabulary)


def test_given_vocabulary():
    pieces = w.load_pieces()
    automaton, vocabulary = w.Automaton(pieces), set(pieces)
    draw = random.Random(1)
    for _ in range(2000):
        word = "".join(draw.choice("etaoinshrdluéñ漢☃ßThe.,") for _ in range(draw.randint(1, 30)))
        assert automaton.count(word) == greedy(word, vocabulary)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    vocabulary = set(w.load_pieces())
    rows = w.token_counts(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        n = [greedy(x, vocabulary) for x in re.findall("[^\x20\x09-\x0d]+", r.text or "")]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(n), sum(map(abs, n)), n.count(-1))
    assert w.token_counts(no_docs(spark)).collect() == []


def test_whole_table(spark, sf_dir, monkeypatch):
    vocabulary, known = set(w.load_pieces()), {}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = re.findall("[^\x20\x09-\x0d]+", texts[r.doc_id])
        n = [known[x] if x in known else known.setdefault(x, greedy(x, vocabulary)) for x in words]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(n), sum(map(abs, n)), n.count(-1))


def test_forgotten_words_are_counted_again(spark, monkeypatch):
    monkeypatch.setattr(w, "WORDS_KEPT", 2)
    lengths = w.WordLengths(w.Automaton([" ab", "c", " "]))
    assert [lengths[x] for x in (b"ab", b"abc", b"c", b"ab", b"x", b"abc")] == [1, 2, 2, 1, -1, 2]
