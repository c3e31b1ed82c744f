import html
import re

import pytest

from lakeloom.llm import template_html as t
from lakeloom.llm.queries import QUERIES


def plain(source):
    """Text of the one article of a page of the tables, read by regular expressions."""
    inner = re.search(r"(?s)<article>(.*)</article>", source)
    cut = re.sub(r"(?s)</?(?:p|h1|br|div|li|ul)\b[^>]*>", " \n", inner[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", cut)).split())


def text_of(source, template=frozenset()):
    return t.main_text(t.parse(source), template)


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_pages_of_the_tables(spark, folder):
    out = QUERIES["op8_template_html"](spark, f"/root/testdata/{folder}").collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"/root/testdata/{folder}/pages.parquet").collect()}
    assert len(out) == len(pages)
    assert [r.page_id for r in out if r.text != plain(pages[r.page_id].html)] == []
    assert all(r.n_chars == len(r.text) and r.url == pages[r.page_id].url for r in out)
    assert max(r.n_slots for r in out) > 1


@pytest.mark.parametrize("source,text", [
    ("", ""), ("  \n ", ""), ("just words &amp; more", "just words & more"), ("<p>a<b>b</b> c<br>d</p><p>e", "ab c d e"),
    ("<article><p>one &lt; two &copy 3</p><script>if (a < b) '</p>'</script></article>", "one < two © 3"),
    ("<nav>menu</nav><main><p>x</p><aside>y</aside></main><footer>f</footer>", "x"),
    ("<body class='with-sidebar'><div class='cookie-notice'>c</div><article class=post><h1>T</h1><p>b</p>"
     "<div id=comments><p>nice</p></div></article>", "T b"),
    ("<article><p>a <!-- <p>no</p> --> b<p>c<form><p>name</form>d</article>", "a b c d"),
    ("<ul><li><a href=/>home</a><li><a href=/x>x</a></ul><p>text", "text"),
    ("<article><p hidden>h</p><p style='display: none'>i</p><p role=alert>j</p>k<img alt='>'>l", "kl"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<article>a < b <3 & c</article", "a < b <3 & c"),
    ('<article><p title="a>b">x</p><p title="open>y</p>', "x y"), ("<p>" * 3000 + "deep", "deep"),
    ("<div>" * 3000 + "deep" + "</div>" * 10, "deep")])
def test_single_pages(source, text):
    assert text_of(source) == text


SCHEMA = "page_id bigint, url string, html string, text string, host string, tokens string"


def test_template_text_is_dropped_and_copies_keep_theirs(spark):
    body = "<html><body><article><p>Share this page</p><p>{}</p><p>{}</p></article></body></html>"
    rows = [(i, f"http://A.org:80/{i}", body.format(f"long story number {i} about things", f"end {i}")) for i in range(30)]
    rows += [(100 + i, f"http://copies.org/{i}", body.format("the same story", "again")) for i in range(30)]
    rows += [(200 + i, f"http://few.org/{i}", body.format(f"story {i}", f"end {i}")) for i in range(3)]
    rows += [(300, None, None), (301, "http://a.org/x", None), (None, None, "<p>x"), (301, "http://a.org/x", None)]
    frame = spark.createDataFrame([r + ("x",) * 3 for r in rows], SCHEMA)
    got = {(r.page_id, r.text) for r in t.extract(frame).collect()}
    assert (3, "long story number 3 about things end 3") in got
    assert (105, "Share this page the same story again") in got and (201, "Share this page story 1 end 1") in got
    assert {(300, ""), (301, ""), (None, "x")} <= got
    assert t.extract(frame).count() == len(rows)
    assert t.extract(frame.limit(0)).collect() == []


def test_equal_vectors_make_classes(spark):
    page = "<ul>{}</ul><p>{}</p>"
    rows = [(i, f"http://h.org/{i}", page.format("<li>" * (1 + i % 3), f"text {i}"), None, None, None) for i in range(24)]
    row = t.templates(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    name = lambda *paths: {t._token(p) for p in paths}
    assert set(row.tokens) == name("/ul", "/ul>", "/p", "/p>") and set(row.nested) == name("/ul/li", "/ul/li>")


def test_one_odd_page_leaves_the_template(spark):
    body = "<html><body><nav><p>Menu</p></nav><article><p>Share this page</p><p>{}</p><ul>{}</ul></article></body></html>"
    items = lambda i: f"<li class=r>Reply</li><li>item {i}</li>" * (1 + i % 3)
    rows = [(i, f"http://h.org/{i}", body.format(f"long story number {i} about things", items(i))) for i in range(40)]
    rows += [(99, "http://h.org/x", "<p>gone"), (98, "http://h.org/y", body.replace("Share this page", "").format("other", ""))]
    got = {r.page_id: r for r in t.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3].text == "long story number 3 about things item 3" and got[98].text == "other" and got[99].text == "gone" and got[99].n_slots == 1
    assert got[3].n_slots > got[99].n_slots


def test_classes_count_in_their_order_only():
    template = t.Template([(True, [1, 2, -3]), (False, [4, -5])])
    page = lambda *tokens: t.Page(list(tokens))
    assert template.on(page(1, 4, -5, 9, 4, -5, 2, -3)) == (frozenset({0, 1, 2, 4, 5, 6, 7}), 3)
    assert template.on(page(-3, 1, -5, 4, 2)) == (frozenset({1, 4}), 2)
    assert template.on(page(7)) == (frozenset(), 0)


def test_template_text_is_dropped_however_short_the_story(spark):
    long = "a notice that all pages of this host repeat " * 20
    body = f"<html><body><article><p>{long}</p><p>{{}}</p></article></body></html>"
    rows = [(i, f"http://h.org/{i}", body.format(f"s{i}" if i % 2 else f"story {i} " * 300)) for i in range(30)]
    rows += [(100 + i, f"http://copies.org/{i}", body.format("same" if i % 4 else f"other {i}")) for i in range(30)]
    got = {r.page_id: r.text for r in t.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "s3" and got[2].split() == ["story", "2"] * 300
    assert got[101].split() == [*long.split(), "same"] and got[100].split() == [*long.split(), "other", "0"]


@pytest.mark.parametrize("source,text", [
    ("<article class='post tag-search'><p>a story</p></article><div class=ad>x</div>", "a story"),
    ("<body><div class='category-social'><article><p>a b c</p></article></div><p>d</p>", "a b c"),
    ("<div class='notice-board-story'><p>a long story</p></div><div class=notice>x</div>", "a long story"),
    ("<article><div class='post-header'><h1>T</h1><p>lead</p></div><p>b</p></article>", "T lead b")])
def test_names_do_not_take_the_story(source, text):
    assert text_of(source) == text


def test_names_need_the_template(spark):
    body = ("<html><body><article><p>{}</p><section id='{}'><p>some work {}</p></section>"
            "<div class=comments><p>nice {}</p></div></article></body></html>")
    rows = [(i, f"http://h.org/{i}", body.format(f"a long story {i} about this and that", "related-work" if i == 3 else f"s{i}", i, i))
            for i in range(30)]
    got = {r.page_id: r.text for r in t.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "a long story 3 about this and that some work 3"
