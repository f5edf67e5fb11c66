"""Main text of web pages by removing the templates of their sites.

A page is parsed once into blocks of text and a list of elements outside the main content
(``article``, ``main`` or ``role=main``; where a page has none, the whole body). Every such element
is a subtree with a hash of its tags and text, and so is every run of text between two of its
elements. Spark counts the subtrees of every host over its pages of different content, and those
that recur on many of them are deleted with all they hold:

* beside a main content, those on ``SHARE_BESIDE`` of the host's pages, marked or not;
* on pages without one, where what recurs may be a passage, those on ``LEAST_SHARE`` of them;
* on ``LEAST_PAGES`` pages at least.

What is left of menus, headers, footers, sidebars, notices, adverts, forms and reader comments is
known by its tag, by its role, or by a class or id that is one of ``MARKS`` as a whole; headings and
the main content itself are never judged by their id. All other text stays, beside the main content
too. Subtrees of the main content are not deleted for recurring, since articles share passages; only
marked ones are.

Text keeps every block of what remains, in page order. White space in a block becomes one space;
``br`` is white space. Malformed markup never fails: what follows ``<!`` and is no comment ends at
the next ``>``, a comment or tag that the page does not finish is dropped. Depth costs nothing: an
element keeps its parent, not its ancestors. Null and empty html give the empty text. A null url is a
host of its own name, the empty one. Columns that the operator makes replace columns of the same
names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rosterflow.llm import arrays
from rosterflow.llm.url_filter import host_of
from rosterflow.operators.joins import small_side
from rosterflow.session import materialise

#: A subtree recurs if so large a share of the pages of different content of one host have it,
LEAST_SHARE = 0.5
#: or this share, where it stands beside a main content: sites have several menus and adverts in turn,
SHARE_BESIDE = 0.01
#: and so many pages at least: two pages that share a passage do not tell it from a template.
LEAST_PAGES = 3

#: Elements by what they are in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style noscript template iframe object svg canvas audio video math".split())
FURNITURE = frozenset("nav aside form button select textarea dialog menu footer".split())
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Classes, ids and roles that mark what is not the article, each as a whole.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot ad-banner ad-container ad-slot advert-box banner sponsor sponsored promo promotion"
    " nav navbar nav-bar main-nav site-nav navigation menu breadcrumb breadcrumbs sidebar side-bar aside footer site-footer site-header masthead"
    " cookie cookies cookie-banner cookie-notice cookie-consent consent gdpr notice notices alert popup modal newsletter newsletter-signup subscribe signup"
    " login login-form search search-form comment comments comment-list commentlist comments-area user-comments disqus respond replies"
    " share share-buttons sharing social social-links related related-posts related-articles recommended widget form toolbar pagination pager skip"
    " complementary contentinfo".split()
)
#: Start tags that end an open paragraph, and open elements that a start tag of the same group ends.
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table tr tbody thead tfoot article main section div body".split())
_START = re.compile(r"<[A-Za-z/!?]")


class _Element:
    __slots__ = ("guarded", "hash", "marked", "number", "tag", "unseen")

    def __init__(self, tag: str, marked: bool, unseen: bool, guarded: bool, number: int):
        self.tag, self.marked, self.unseen, self.guarded, self.number = tag, marked, unseen, guarded, number
        self.hash = xxhash.xxh3_64(tag)


class Page(HTMLParser):
    """Blocks of a page, and the elements outside the main content: a hash and a parent each.

    ``inside[i]`` is the element that holds block ``i``, -1 in the main content; an element's
    parent comes before it, -1 for none.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = [_Element("", False, False, False, -1)]
        self.depths: dict[str, list[int]] = {}  # of the open elements, by tag and by kind
        self.blocks: list[str] = []
        self.inside: list[int] = []
        self.marked: list[bool] = []
        self.hashes: list[int] = []
        self.parents: list[int] = []
        self.main = False
        self.text: list[str] = []
        self.feed(html)
        if _START.match(self.rawdata):  # a tag or comment without an end
            self.rawdata = ""
        self.close()
        self._close_to(1)
        self._flush()

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        return self.rawdata.find(">", i + 2) + 1 or -1

    def _element(self, value: int, parent: int) -> int:
        self.hashes.append(value - (1 << 64) if value >> 63 else value)
        self.parents.append(parent)
        return len(self.hashes) - 1

    def _flush(self) -> None:
        words = " ".join("".join(self.text).split())
        self.text = []
        element = self.open[-1]
        if not words or element.unseen or (element.marked and element.guarded):
            return
        self.blocks.append(words)
        self.marked.append(element.marked)
        run = xxhash.xxh3_64_intdigest(f"{element.tag}\0{words}".encode("utf-8", "replace"))
        self.inside.append(-1 if element.guarded else self._element(run, element.number))

    def _deepest(self, *names: str) -> int:
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def _kinds(self, tag: str) -> list[str]:
        return [tag, *(["*block"] if tag in BLOCKS else []), *(["*scope"] if tag in _SCOPES else [])]

    def _end(self) -> None:
        element, parent = self.open[-1], self.open[-2]
        if element.tag in BLOCKS or (element.marked, element.unseen) != (parent.marked, parent.unseen):
            self._flush()
        self.open.pop()
        for kind in self._kinds(element.tag):
            self.depths[kind].pop()
        value = element.hash.intdigest()
        parent.hash.update(value.to_bytes(8, "little"))
        if element.number >= 0:
            self.hashes[element.number] = value - (1 << 64) if value >> 63 else value

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._end()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._flush()
            paragraph = self._deepest("p")  # a block ends an open paragraph
            if paragraph > self._deepest("*scope"):
                self._close_to(paragraph)
        if tag in _SIBLINGS:
            sibling = self._deepest(*_SIBLINGS[tag])
            others = [s for s in _SCOPES if s not in _SIBLINGS[tag]]
            if sibling > self._deepest(*others):
                self._close_to(sibling)
        if tag in VOID:
            self.text.append(" ")
            return
        parent = self.open[-1]
        named = {k: (v or "").lower().split() for k, v in attrs if k in ("class", "id", "role")}
        if tag in HEADINGS or tag in MAIN:
            named.pop("id", None)
        marked = any(w in MARKS for words in named.values() for w in words)
        main = "main" in named.get("role", ()) or (tag in MAIN and not marked)
        main = main and not parent.marked and not parent.unseen
        self.main = self.main or main
        guarded = parent.guarded or main
        furniture = tag in FURNITURE or (tag == "header" and not parent.guarded) or (marked and tag not in ("html", "body"))
        number = -1 if guarded or tag in ("html", "body", *UNSEEN) else self._element(0, parent.number)
        element = _Element(tag, not main and (parent.marked or furniture), parent.unseen or tag in UNSEEN, guarded, number)
        if (element.marked, element.unseen) != (parent.marked, parent.unseen):
            self._flush()
        for kind in self._kinds(tag):
            self.depths.setdefault(kind, []).append(len(self.open))
        self.open.append(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash of an element that is not void means nothing

    def handle_endtag(self, tag: str) -> None:
        if tag in ("br", "hr"):
            self.text.append(" ")
            return
        depth = self._deepest(tag)
        if depth and (tag in BLOCKS or self._deepest("*block") < depth):  # a stray inline end tag does not end a block
            self._close_to(depth)

    def handle_data(self, data: str) -> None:
        element = self.open[-1]
        if not element.unseen:
            self.text.append(data)
        if not element.guarded:
            element.hash.update(" ".join(data.split()).encode("utf-8", "replace"))


PARSED = {"blocks": "array<string>", "inside": "array<int>", "marked": "array<boolean>", "subtrees": "array<long>", "parents": "array<int>", "beside": "boolean", "content": "long"}


def _lists(values: list[list], kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array([x for v in values for x in v], kind))


def _parsed(column: pa.Array) -> list[pa.Array]:
    pages = [Page((v or b"").decode("utf-8", "replace")) for v in column.cast(pa.binary()).to_pylist()]
    own = ["\n".join(t for t, marked in zip(p.blocks, p.marked, strict=True) if not marked) for p in pages]
    content = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) for t in own], np.uint64).view(np.int64)
    return [
        _lists([p.blocks for p in pages], pa.string()),
        _lists([p.inside for p in pages], pa.int32()),
        _lists([p.marked for p in pages], pa.bool_()),
        _lists([p.hashes for p in pages], pa.int64()),
        _lists([p.parents for p in pages], pa.int32()),
        pa.array([p.main for p in pages], pa.bool_()),
        pa.array(content),
    ]


def recurring(parsed: DataFrame, least_pages: int, least_share: float, share_beside: float) -> DataFrame:
    """``host`` with ``common``, the subtrees to be deleted on its pages without a main content, and ``beside``, those on
    its pages with one.

    Of pages of one content only the first counts. Every subtree is on a share of the pages, so
    that a host's lists hold no more than its pages' mean number of subtrees, divided by that share.
    """
    firsts = parsed.groupBy("host", "content").agg(F.min("page_number").alias("page_number"))
    firsts = materialise(firsts, "host-contents")
    hosts = firsts.groupBy("host").agg(F.count("*").alias("of"))
    seen = parsed.join(firsts.select("page_number"), "page_number", "left_semi").select("host", F.explode(F.array_distinct("subtrees")).alias("subtree"))
    counted = seen.groupBy("host", "subtree").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    shared = counted.join(small_side(materialise(hosts, "host-pages")), "host")
    shared = shared.filter(F.col("pages") >= F.col("of") * min(least_share, share_beside))

    def where(share: float) -> Column:
        return F.collect_list(F.when(F.col("pages") >= F.col("of") * share, F.col("subtree")))

    return shared.groupBy("host").agg(where(least_share).alias("common"), where(share_beside).alias("at_side"))


def _kept(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        blocks, inside, marked, subtrees, parents, removed = (batch.column(c).to_pylist() for c in ("blocks", "inside", "marked", "subtrees", "parents", "removed"))
        texts, templates, marks = [], [], []
        for row in range(batch.num_rows):
            wanted, gone = set(removed[row] or ()), []
            for value, parent in zip(subtrees[row], parents[row], strict=True):
                gone.append(value in wanted or (parent >= 0 and gone[parent]))
            out = [at >= 0 and gone[at] for at in inside[row]]
            texts.append("\n\n".join(t for t, deleted, mark in zip(blocks[row], out, marked[row], strict=True) if not deleted and not mark))
            templates.append(sum(out))
            marks.append(sum(mark and not deleted for deleted, mark in zip(out, marked[row], strict=True)))
        added = [pa.array(texts, pa.string()), pa.array(templates, pa.int64()), pa.array(marks, pa.int64())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *added], [*names, "text", "n_template", "n_marked"])


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, share_beside: float = SHARE_BESIDE) -> DataFrame:
    """All columns of ``pages`` but ``html``, ``text``, ``n_chars``, and the numbers of blocks deleted:
    ``n_template`` for recurring on the host, ``n_marked`` for their marks alone.

    Pages are parsed once and staged; only hashes are shuffled. A page is told by a number of
    its own, so that page ids may repeat or be null.
    """
    given = pages.drop("text", "n_chars", "n_template", "n_marked", "host", "page_number", "common", "at_side", "removed", *PARSED)
    parsed = arrays.with_columns(given, _parsed, PARSED, column="html", keep=tuple(c for c in given.columns if c != "html"))
    parsed = parsed.withColumn("host", host_of(F.col("url"))).withColumn("page_number", F.monotonically_increasing_id())
    parsed = materialise(parsed, "parsed-pages")
    templates = small_side(materialise(recurring(parsed, least_pages, least_share, share_beside), "page-templates"))
    deleted = F.when(F.col("beside"), F.col("at_side")).otherwise(F.col("common"))
    found = parsed.join(templates, "host", "left").withColumn("removed", F.array_intersect("subtrees", deleted)).drop("common", "at_side")
    columns = [c for c in given.columns if c != "html"]
    schema = StructType([*given.select(*columns).schema, *StructType.fromDDL("text string, n_template long, n_marked long")])
    wanted = found.select(*columns, "blocks", "inside", "marked", "subtrees", "parents", "removed")
    return wanted.mapInArrow(lambda batches: _kept(batches, columns), schema).withColumn("n_chars", F.length("text").cast("long"))
