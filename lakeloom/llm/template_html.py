"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: start and end tags, told apart by their path, and
text blocks, told apart by path and content. The occurrence vector of a token counts
it in each page of its host. Tokens with equal vectors form an equivalence class;
classes that occur in at least ``FREQUENT`` of the pages, and in a number of them,
make the template: classes whose tokens a page has once are its root, classes with
other vectors (menus, lists, repeated cells) are nested in the root's slots. Texts
without a tag of their vector are copied content, unless ``ALONE`` of the pages have them.

Vectors are never gathered: a task adds up, per host and token, pages, occurrences
and two sums of count times page hash; Spark adds these up, and equal sums tell equal
vectors (two 31-bit hashes per page). What passes a shuffle is one row per host,
token and task, not one per token of a page, so a host with most pages is no hot key.

A page is then cut by its host's template into slots. A class must come in its order
on the page, each time it comes; what is out of order is no template there. That tags
nest needs no check, as a token's path names what it is in. Text blocks that are
template tokens, of the root or of a nested class, are dropped on all pages of the host,
unless it is a host of copies: at least ``FREQUENT`` of its pages have the same article
blocks, so no text of a template can be told from theirs. Which of the slots are the article is told by tags: those under
menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments are
dropped by the kind of their enclosing tokens. A class or id name only makes an element
a suspect; it is dropped if it is in the template and holds no more than half of the
page's words, and never for the name of an article or main element. Then the article's slots are joined in
page order. A host with fewer than ``MIN_PAGES`` pages has no template; its pages are
cut by their own tags alone."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.tables import table, written

MIN_PAGES = 10         # of a host, for a template
FREQUENT = 0.5         # share of a host's pages that a class must occur in
LEAST_TOKENS = 2       # of a class
ALONE = 0.9            # share of a host's pages for texts without a tag of the same vector
FLUSH = 200_000        # tokens summed in a task before it emits them
BROADCAST_BYTES = 32 << 20

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attributes2>[^>]*+)>
    |<[a-zA-Z/!?][^>]*+(?:>|\Z)""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")

# fixed values: elements of HTML by kind
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template iframe noembed noframes xmp".split())
_BLOCK = set("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    search section select summary table tbody td textarea tfoot th thead title tr ul video""".split())
_CLOSES_P = _BLOCK - set("br html head body title td th tr tbody thead tfoot caption option".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}, "p": {"td", "th", "table", "body", "html", "article", "section",
                                                              "div", "li", "main", "blockquote"}}
# fixed values: what is no part of an article, by element, role, and word of class or id
_APART = set("""nav header footer aside form script style noscript template iframe object svg canvas button select
    textarea dialog menu head title search""".split())
_APART_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_APART_NAMES = set("""ad ads advert adverts advertisement advertisements advertising adsense banner banners breadcrumb
    breadcrumbs comment comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu
    modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion
    promoted recommended related respond replies reply search share sharing sidebar signup skip social sponsor
    sponsored subscribe subscription toolbar widget widgets""".split())
_APART_OUTSIDE = {"header", "aside"}  # set apart unless they are inside an article


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user and port; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


@dataclass
class _Element:
    name: str
    path: str
    apart: bool
    article: bool
    main: bool
    link: bool
    suspects: tuple[int, ...] = ()


@dataclass
class Page:
    """``tokens`` in page order, those of text below zero; ``blocks``: (place in tokens, text, in an article, in
    the main element, all in links, places of the suspects it is in: elements named
    like something apart) of the text that is not set apart."""

    tokens: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str, bool, bool, bool, tuple[int, ...]]] = field(default_factory=list)


def _token(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def _set_apart(name: str, attributes: dict[str, str]) -> bool:
    if name in _APART or attributes.get("role", "").lower() in _APART_ROLES:
        return True
    if name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I))


def _suspect(name: str, named: str, in_article: bool) -> bool:
    """Whether a class or id names an element like what is no part of an article."""
    if name in ("html", "body", "main", "article"):
        return False
    parts = {part.lower() for part in _NAME_PARTS.findall(named)}
    return bool(parts & _APART_NAMES) or not in_article and bool(parts & _APART_OUTSIDE)


def parse(source: str) -> Page:
    """Tokens and text blocks of a page; every text is a page, tags may be missing."""
    page, stack = Page(), [_Element("", "", False, False, False, False)]
    text: list[str] = []
    linked = [True]

    def flush() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            joined, top = " ".join(words), stack[-1]
            page.tokens.append(-_token(f"{top.path}|{joined}"))
            page.blocks.append((len(page.tokens) - 1, joined, top.article, top.main, linked[0], top.suspects))
        text.clear()
        linked[0] = True

    def say(piece: str) -> None:
        if piece and not stack[-1].apart:
            text.append(piece)
            if piece.strip() and not stack[-1].link:
                linked[0] = False

    def close(down_to: int) -> None:
        if any(e.name in _BLOCK for e in stack[down_to:]):
            flush()
        for e in reversed(stack[down_to:]):
            page.tokens.append(_token(e.path + ">"))
        del stack[down_to:]

    def innermost(names: set[str], scope: set[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                return i
            if stack[i].name in scope:
                return 0
        return 0

    at = 0
    while at < len(source):
        m = _TAG.search(source, at)
        if not m:
            say(source[at:])
            break
        say(source[at: m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            open_at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if open_at:
                close(open_at)
            elif name in _BLOCK:
                flush()
            continue
        written_in = m["attributes"] if m["name"] else m["attributes2"]
        found = {a.lower(): html.unescape(b or c or d) for a, b, c, d in _ATTRIBUTE.findall(written_in)} if written_in.strip() else {}
        if name in _CLOSES_P and (p := innermost({"p"}, _SCOPE["p"])):
            close(p)
        if name in _CLOSED_BY and (p := innermost(_CLOSED_BY[name], _SCOPE[name])):
            close(p)
        if name in _BLOCK:
            flush()
        up = stack[-1]
        label = ".".join([name, *sorted(found.get("class", "").split())])
        path = f"{up.path}/{label}"
        page.tokens.append(_token(path))
        if name in _VOID:
            continue
        apart = up.apart or _set_apart(name, found)
        suspects = up.suspects
        if not apart and _suspect(name, found.get("class", ""), up.article):
            suspects += (len(page.tokens) - 1,)
        elif not apart and _suspect(name, found.get("id", ""), up.article):
            page.tokens.append(_token(f"{path}#{found['id']}"))  # a path has no ids
            suspects += (len(page.tokens) - 1,)
        e = _Element(name, path, apart, up.article or name == "article", up.main or name == "main", up.link or name == "a",
                     suspects)
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            at = end.start() if end else len(source)
        stack.append(e)
    flush()
    close(1)
    return page


def _cleared(page: Page, template: frozenset[int] | None) -> list[tuple[int, str, bool, bool, bool, tuple[int, ...]]]:
    """Blocks without those in suspects that stay so: not those with most of the page's
    words and, on a host with a template, not those that the template does not have."""
    if not any(b[5] for b in page.blocks):
        return page.blocks
    words: dict[int, int] = {}
    total = 0
    for b in page.blocks:
        n = len(b[1].split())
        total += n
        for place in b[5]:
            words[place] = words.get(place, 0) + n
    apart = {place for place, n in words.items() if 2 * n <= total and (template is None or place in template)}
    return [b for b in page.blocks if not apart.intersection(b[5])]


def _chosen(blocks: list) -> list:
    return [b for b in blocks if b[2]] or [b for b in blocks if b[3]] or [b for b in blocks if not b[4]] or blocks


def main_text(page: Page, template: frozenset[int] | None = None, copies: bool = False) -> str:
    """The article's blocks: inside article elements, else inside main, else all that is
    not a list of links; without blocks at ``template``, the template's places in the page,
    unless the host is one of ``copies``. Without a template names alone are believed."""
    dropped = template if template and not copies else ()
    return " ".join(b[1] for b in _chosen(_cleared(page, template or None)) if b[0] not in dropped)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token: pages, occurrences, the two sums that stand for the
    occurrence vector, and the sum of the token's places in its pages. Token 0 stands for
    a page with any token; a token that occurs 0 times stands for the pages' article blocks."""
    sums: dict[tuple[str, int], list[int]] = {}

    def rows() -> pa.RecordBatch:
        hosts, tokens = [k[0] for k in sums], [k[1] for k in sums]
        columns = [pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(5)]
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(tokens, pa.int64()), *columns],
                                          names=["host", "token", "pages", "times", "one", "two", "place"])

    for batch in batches:
        for host, page_hash, source in zip(*(c.to_pylist() for c in batch.columns)):
            one, two = page_hash & 0x7FFFFFFF, page_hash >> 32 & 0x7FFFFFFF
            page = parse(source)
            found = page.tokens
            counts: dict[int, int] = {0: 1} if found else {}
            places: dict[int, int] = {}
            for place, token in enumerate(found):
                counts[token] = counts.get(token, 0) + 1
                places[token] = places.get(token, 0) + place
            if whole := " ".join(b[1] for b in _chosen(_cleared(page, None))):
                counts[-_token(f"page|{whole}")] = 0
            for token, n in counts.items():
                s = sums.get((host, token))
                if s is None:
                    sums[host, token] = [1, n, n * one, n * two, places.get(token, 0)]
                else:
                    s[0] += 1
                    s[1] += n
                    s[2] += n * one
                    s[3] += n * two
                    s[4] += places.get(token, 0)
            if len(sums) >= FLUSH:
                yield rows()
    yield rows()


def _prepared(pages: DataFrame) -> DataFrame:
    return pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("_hash"),
                        F.coalesce("html", F.lit("")).alias("html"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens, nested, classes, copies) of the hosts with a template: the tokens of its
    root classes, those of the classes nested in them, and all classes, each with its
    tokens in the order of their mean places (the order on every page, if there is one); whether it is a host of copies."""
    tokens = (_prepared(pages).mapInArrow(_summed, "host string, token bigint, pages bigint, times bigint, one bigint, "
                                                   "two bigint, place bigint")
              .groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("pages", "times", "one", "two", "place")]))
    tokens = written(tokens, "tokens")
    hosts = tokens.where(F.col("token") == 0).where(F.col("pages") >= MIN_PAGES).select("host", F.col("pages").alias("_all"))
    copies = (tokens.where("times = 0").where(F.col("pages") >= FREQUENT * MIN_PAGES).groupBy(F.col("host").alias("_of"))
              .agg(F.max("pages").alias("_same")))
    frequent = (tokens.where((F.col("token") != 0) & (F.col("times") > 0)).where(F.col("pages") >= FREQUENT * MIN_PAGES).join(hosts, "host")
                .where(F.col("pages") >= FREQUENT * F.col("_all")))
    root = F.col("times") == F.col("pages")
    placed = F.array_sort(F.collect_list(F.struct((F.col("place") / F.col("times")).alias("place"), "token")))
    classes = (frequent.groupBy("host", "_all", "pages", "times", "one", "two").agg(placed.alias("_placed"))
               .withColumn("tokens", F.transform("_placed", lambda t: t["token"]))
               .where((F.size("tokens") >= LEAST_TOKENS) & (F.array_max("tokens") > 0)
                      | root & (F.col("pages") >= ALONE * F.col("_all"))))
    either = lambda is_root: F.flatten(F.collect_list(F.when(is_root, F.col("tokens"))))
    found = classes.groupBy("host", "_all").agg(either(root).alias("tokens"), either(~root).alias("nested"),
                                                F.collect_list(F.struct(root.alias("root"), "tokens")).alias("classes"))
    same = F.coalesce(F.col("_same") >= FREQUENT * F.col("_all"), F.lit(False))
    return found.join(copies, F.col("host") == F.col("_of"), "left").select(
        "host", "tokens", "nested", "classes", same.alias("copies"))


class Template:
    """The classes of a host: (whether of the root, tokens in order)."""

    def __init__(self, classes: Iterable[tuple[bool, list[int]]] = ()):
        self.classes = list(classes)
        self.tokens = {t: (k, i) for k, (_, tokens) in enumerate(self.classes) for i, t in enumerate(tokens)}

    def on(self, page: Page) -> tuple[frozenset[int], int]:
        """Places in the page of the tokens that come in the order of their class, and
        how many of them are of the root."""
        met: dict[int, list[tuple[int, int]]] = {}
        for place, token in enumerate(page.tokens):
            if token in self.tokens:
                k, i = self.tokens[token]
                met.setdefault(k, []).append((i, place))
        found, of_root = set(), 0
        for k, came in met.items():
            in_root, tokens = self.classes[k]
            if in_root:
                came = _in_order(came)
                of_root += len(came)
            elif any(i != n % len(tokens) for n, (i, _) in enumerate(came)):
                continue
            found.update(place for _, place in came)
        return frozenset(found), of_root


def _in_order(came: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of (place in the class, place in the page) that rises in both."""
    if all(a[0] < b[0] for a, b in pairwise(came)):
        return came
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (i, _) in enumerate(came):
        at = bisect_left(ends, i)
        before.append(last[at - 1] if at else -1)
        ends[at:at + 1], last[at:at + 1] = [i], [n]
    kept, n = [], last[-1]
    while n >= 0:
        kept.append(came[n])
        n = before[n]
    return kept[::-1]


def _extracted(at: int, keep: int):
    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Template] = {}
        for batch in batches:
            texts, slots = [], []
            hosts = batch.column(at + 1).to_pylist()
            for i, source in enumerate(batch.column(at)):
                if hosts[i] not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[hosts[i]] = Template((c["root"], c["tokens"]) for c in batch.column(at + 2)[i].as_py() or ())
                page = parse(source.as_py())
                places, of_root = known[hosts[i]].on(page)
                texts.append(main_text(page, places, bool(batch.column(at + 3)[i].as_py())))
                slots.append(of_root + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], pa.array(texts, pa.string()), pa.array(slots, pa.int64())],
                                             names=[*batch.schema.names[:keep], "text", "n_slots"])

    return extracted


def extract(pages: DataFrame, columns: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): ``columns``, text, n_slots
    (slots that the template's root cuts the page into), n_chars (code points).

    A null or empty html gives an empty text; a page without url is of the host of all
    such pages; repeated rows are pages of their own with equal texts; other columns are
    not read; an empty table gives no rows. The templates are broadcast if together
    they are within ``BROADCAST_BYTES``, and joined by host beyond that."""
    found = written(templates(pages).select("host", "classes", "copies"), "templates")
    held = F.aggregate("classes", F.lit(64), lambda n, c: n + 8 * F.size(c["tokens"]) + 32)
    size = found.agg(F.coalesce(F.sum(held), F.lit(0))).first()[0]
    wanted = found.select(F.col("host").alias("_host"), "classes", "copies")
    rows = pages.select(*columns, host_of(F.col("url")).alias("_of"), F.coalesce("html", F.lit("")).alias("_html"))
    joined = rows.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, F.col("_of") == F.col("_host"), "left")
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in columns)
    return (joined.select(*columns, "_html", "_of", "classes", "copies")
            .mapInArrow(_extracted(len(columns), len(columns)), f"{kinds}, text string, n_slots bigint")
            .withColumn("n_chars", F.length("text").cast("bigint")))


def op8_template_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars", "n_slots")
