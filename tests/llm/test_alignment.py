import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lakeloom.llm import alignment
from lakeloom.llm.queries import QUERIES
from tests.llm.cases import awkward_docs, no_docs, prose


def whole_text_tokens(texts):
    """(ids, byte ends) of A and B per text, each text encoded whole by the libraries."""
    a = Tokenizer.from_file(alignment.VOCABULARY_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.VOCABULARY_B)
    letters = {c: bytes([n]) for c, n in alignment._byte_letters().items()}
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        x = a.encode(" " + text, add_special_tokens=False)
        y = b.encode(text)
        bytes_a = [b"".join(letters[c] for c in a.id_to_token(i)) for i in x.ids]
        pieces = [b.id_to_piece(i) for i in y]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, pieces)]
        want = (" " + text).encode()
        good = b"".join(bytes_a) == want and b"".join(bytes_b) == want
        out.append((x.ids, np.cumsum([len(t) for t in bytes_a]).tolist(), y,
                    np.cumsum([len(t) for t in bytes_b]).tolist()) if good else None)
    return out


def brute(ids, texts):
    """Rows of the contract: groups by common ends, links by comparing ranges."""
    tokens = whole_text_tokens(texts)
    linked, held = [], defaultdict(int)
    for t in tokens:
        pairs = Counter()
        if t:
            ids_a, ends_a, ids_b, ends_b = t
            at = 0
            for i, (x, end) in enumerate(zip(ids_a, ends_a)):
                start = ends_a[i - 1] if i else 0
                while ends_b[at] <= start:
                    at += 1
                k = at
                while k < len(ids_b) and (ends_b[k - 1] if k else 0) < end:
                    pairs[x, ids_b[k]] += 1
                    k += 1
        linked.append(pairs)
        for p in pairs:
            held[p] += 1
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for doc, t, pairs in zip(ids, tokens, linked):
        if not t:
            rows.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        ids_a, ends_a, ids_b, ends_b = t
        cuts = sorted(set(ends_a) & set(ends_b))
        place_a, place_b = {e: i + 1 for i, e in enumerate(ends_a)}, {e: i + 1 for i, e in enumerate(ends_b)}
        groups, i, j = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, ids_a[i:place_a[c]])) + "|" + ",".join(map(str, ids_b[j:place_b[c]])))
            i, j = place_a[c], place_b[c]
        rows.append((doc, len(ids_a), len(ids_b), len(cuts), sum(pairs.values()),
                     sum(k for p, k in pairs.items() if held[p] == most[p[0]]),
                     sum(k * held[p] for p, k in pairs.items()),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return Counter(rows)


ODD = ["\nx", " \nx\n", "a  b   c ", "<s> </s> <unk> <|endoftext|> x", "a▁b", "x\x00y\x00 \x00", "　x  y \nz   q",
       "tab\tand\r\nline\n\n\nend\n", "don't we'll  I'm 12 345,678", "日本語 テキスト ﬁ Ⅷ 😀👍🏽 ", " ", "\n", "  ", "<0x41> 😀", "é é"]


def test_awkward_texts(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = alignment.align(docs)
    assert Counter(map(tuple, out.collect())) == brute(*zip(*rows))
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert alignment.align(no_docs(spark)).collect() == []


@pytest.mark.parametrize("frequent", [0, 40, alignment.FREQUENT])
def test_odd_characters_with_few_or_many_frequent_links(spark, frequent):
    texts = ODD + [prose(i, 40) + o for i, o in enumerate(ODD)] * 2 + [prose(1, 30) + "\n" + prose(2, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = Counter(map(tuple, alignment.align(docs, frequent=frequent).collect()))
    assert got == brute(range(len(texts)), texts)


def test_chunks_are_cut_where_both_tokenizers_cut():
    assert alignment.chunks_of("a b\nc") == [" a", " b", "\nc"]
    assert alignment.chunks_of(" \na  b ") == ["  \na", "  b", " "]
    for text in ODD:
        assert "".join(alignment.chunks_of(text)) == " " + text


def test_small_cache_changes_nothing(spark, monkeypatch):
    texts = [prose(i % 7, 60) for i in range(30)]
    tok = alignment.Tokenizers(alignment.read_vocabularies())
    whole, small = alignment.Chunks(tok), alignment.Chunks(tok)
    want = alignment._align_block(whole, texts)
    monkeypatch.setattr(alignment, "KEPT_BYTES", 10)
    parts = [alignment._align_block(small, texts[i:i + 3]) for i in range(0, 30, 3)]
    for k, column in enumerate(want):
        assert column.to_pylist() == [x for p in parts for x in p[k].to_pylist()]


def test_coalescing_by_hand():
    a, b = np.array([2, 5, 6, 9]), np.array([1, 2, 6, 7, 9])
    group_a, group_b, one, two = alignment.coalesce(np.array([0, 2, 5, 6]), a, np.array([0, 1, 2, 6, 7]), b)
    assert group_a.tolist() == [0, 1, 1, 2] and group_b.tolist() == [0, 0, 1, 2, 2]
    assert list(zip(one.tolist(), two.tolist())) == [(0, 0), (0, 1), (1, 2), (2, 2), (3, 3), (3, 4)]


def test_spans_give_the_text_back(spark):
    texts = ODD + [None, "", prose(3, 50)]
    tok = alignment.Tokenizers(alignment.read_vocabularies())
    for r in alignment.spans(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect():
        text = texts[r.doc_id]
        if not r.ids_a:
            assert not text or "▁" in text
            continue
        raw = (" " + text).encode()
        for ids, group, known in ((r.ids_a, r.group_a, tok.bytes_a), (r.ids_b, r.group_b, tok.bytes_b)):
            for g, (x, y) in enumerate(zip([0, *r.group_ends], r.group_ends)):
                assert b"".join(known[i] for i, h in zip(ids, group) if h == g) == raw[x:y]


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert Counter(map(tuple, QUERIES["op13_alignment"](spark, folder).collect())) == brute(*zip(*rows))
