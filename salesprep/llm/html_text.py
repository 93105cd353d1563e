"""Main text of web pages, without what a site repeats on its pages.

A first pass parses every page into its element tree and hashes the subtrees of
block elements that hold text (name, attributes but links, text, children), but for those
that markup says are no article (navigation, headers outside the article, footers, sidebars, notices,
adverts, forms, comments, scripts). Spark counts per host beside how many different main contents a subtree
stands. A page's contents are the text blocks of its article (without article elements: of the page) that have
``CONTENT_SHARE`` of the longest one's length or more. Beside a subtree stand the two longest of them outside of it; where
there is none, the longest block of all. The longest ones and the second ones are counted apart, the greater count
holds, so that no page counts twice. So copies of one article count once whatever short adverts they
have, and long notices do not hide the articles.

A subtree beside ``LEAST_PAGES`` contents is the site's template, whatever share of the host has
it. Within article elements, where a quotation may recur, it must also stand
beside ``LEAST_SHARE`` of all contents of the host. Each page's own templates are joined to
it by its content. A second pass deletes them and what markup says is no article, and
returns the text of the article elements, or of the main element, or of the body.

Inside a block white space becomes one space; blocks are joined in page order by
one space. Nothing else is dropped: long texts stay whole.

A page's host is what stands between ``://`` and the next ``/``, ``?`` or ``#``. Counting
has the subtree in its key and is combined before the shuffle, so a host with a
third of all pages is no hot key. What is joined to a page is bounded by its own elements, however
many templates a host has. Pages of one host whose 64-bit content hashes are equal get the templates of both, which
are templates of that host in any case.

Defined cases: a null or empty html has empty text; without ``://`` or with a null url the
host is empty, and such pages form one host; repeated rows stay; unclosed and
stray tags are mended as browsers do in simple cases; a page that is cut off ends where it ends; of blocks of equal
length the first counts as the longest; pages without text count nowhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesprep.llm.shared import longs, slices, stage
from salesprep.llm.url_filter import split_url
from salesprep.staging import scope

LEAST_PAGES = 10
LEAST_SHARE = 0.3
#: A block of this share of the page's longest one is content.
CONTENT_SHARE = 0.25
#: Stands for the page itself among its subtrees.
PAGE = 0

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("script style noscript template head title nav footer aside form button select textarea input iframe object embed svg canvas audio video dialog menu".split())
CLOSED_BY_BLOCK = frozenset("p".split())
ITEMS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table select".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

#: Words of class and id names that mark what is no article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription paywall login signin signup register nav navbar navigation menu menus breadcrumb breadcrumbs "
    "sidebar sidebars aside widget widgets related recommended recommendations share sharing social toolbar footer foot header masthead topbar "
    "comment comments comentarios kommentare commentaires disqus reply replies respond pagination pager copyright legal disclaimer".split()
)
#: Words that say nothing of what an element holds.
NEUTRAL = frozenset("area bar block box button buttons container inner item items link links list outer panel section wrap wrapper".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        self.name, self.attrs = name, attrs
        self.children: list[Node | str] = []


class Tree(HTMLParser):
    """Element tree of a page; ``self.top`` is its root."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = Node("", [])
        self.open = [self.top]

    def end_open(self, names: set[str] | frozenset[str], stop: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name in names:
                del self.open[i:]
                return
            if self.open[i].name in stop:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ITEMS:
            self.end_open(ITEMS[tag], LISTS)
        elif tag not in INLINE and tag not in VOID:
            self.end_open(CLOSED_BY_BLOCK, frozenset(("table", "button", "object")))
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open[-1].children.append(Node(tag, attrs))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    # what is left in the parser's buffer at the end is an unfinished tag or reference
    tree.close()
    return tree.top


def walk(top: Node) -> list[Node]:
    """Nodes in an order in which children come before their parents."""
    order, todo = [], [top]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, Node)]
    return order[::-1]


def hashed(top: Node) -> dict[int, int]:
    """A 64-bit hash of each element subtree that holds text, by the node's identity."""
    found: dict[int, int] = {}
    for node in walk(top):
        digest = hashlib.blake2b(repr((node.name, sorted((k, v or "") for k, v in node.attrs if k not in ("href", "src")))).encode("utf-8", "replace"), digest_size=8)
        text = False
        for c in node.children:
            if isinstance(c, str):
                if words := " ".join(c.split()):
                    digest.update(b"t" + words.encode("utf-8", "replace"))
                    text = True
            elif id(c) in found:
                digest.update(b"e" + found[id(c)].to_bytes(8, "big", signed=True))
                text = True
        if text:
            found[id(node)] = int.from_bytes(digest.digest(), "big", signed=True)
    return found


def named_as_mark(value: str, in_article: bool) -> bool:
    """Whether a class or id names what is no article.

    Inside an article a word may be part of its subject (``legal-news``), so there all words of a name must say so.
    """
    for name in value.split():
        words = {w.lower() for w in WORDS.findall(name)} - NEUTRAL
        if words and (words <= MARKS if in_article else not MARKS.isdisjoint(words)):
            return True
    return False


def marked(node: Node, in_article: bool) -> bool:
    """Whether markup says that an element is no part of an article."""
    if node.name in DROPPED or node.name == "header" and not in_article:
        return True
    for key, value in node.attrs:
        if not value:
            if key == "hidden":
                return True
        elif key in ("class", "id"):
            if node.name not in ("body", "html", "article", "main") and named_as_mark(value, in_article):
                return True
        elif (key == "role" and value.lower() in ROLES) or (key == "aria-hidden" and value.lower() == "true") or key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
    return False


def key_of(digest: int, inside: bool) -> int:
    """A subtree's hash whose last bit says whether it stands in an article (or is one)."""
    return digest & ~1 | inside


def is_cut(node: Node, inside: bool, cut: set[int], hashes: dict[int, int]) -> bool:
    digest = hashes.get(id(node))
    return digest is not None and key_of(digest, inside) in cut


def blocks(node: Node, cut: set[int], hashes: dict[int, int]) -> str:
    """Text of an element without deleted parts; white space and block edges are one space."""
    parts: list[str] = []
    todo: list[tuple[Node | str, bool] | None] = [(node, node.name == "article")]
    while todo:
        item = todo.pop()
        if item is None:
            parts.append(" ")
            continue
        child, in_article = item
        if isinstance(child, str):
            parts.append(child)
            continue
        inside = in_article or child.name == "article"
        if child is not node and (marked(child, in_article) or is_cut(child, inside, cut, hashes)):
            parts.append(" " if child.name not in INLINE else "")
            continue
        if child.name not in INLINE:
            parts.append(" ")
            todo.append(None)
        todo += [(c, inside) for c in reversed(child.children)]
    return " ".join("".join(parts).split())


def articles(top: Node, cut: set[int], hashes: dict[int, int]) -> list[Node]:
    """The outermost article elements, else the main elements, else the whole page; none in deleted parts."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo: list[tuple[Node, bool]] = [(top, False)]
    while todo:
        node, within = todo.pop()
        inside = within or node.name == "article"
        if node is not top and (marked(node, within) or is_cut(node, inside, cut, hashes)):
            continue
        if node.name in found and not (node.name == "article" and within):
            found[node.name].append(node)
        todo += [(c, inside) for c in reversed(node.children) if isinstance(c, Node)]
    return found["article"] or found["main"][:1] or [top]


def main_text(html: str, templates: set[int]) -> str:
    top = parse(html)
    hashes = hashed(top) if templates else {}
    return " ".join(t for a in articles(top, templates, hashes) if (t := blocks(a, templates, hashes)))


@dataclass
class Block:
    """An unmarked block element: the place after its last descendant in page order, and its own text without inner blocks."""

    node: Node
    inside: bool
    end: int = 0
    own: list[str] = field(default_factory=list)
    text: str = ""


def page_blocks(top: Node) -> list[Block]:
    """The page and its unmarked block elements, in page order."""
    found = [Block(top, False)]
    todo: list[tuple[Node | str, int, bool] | int] = [(c, 0, False) for c in reversed(top.children)]
    while todo:
        item = todo.pop()
        if isinstance(item, int):
            found[item].end = len(found)
            continue
        child, owner, in_article = item
        if isinstance(child, str):
            found[owner].own.append(child)
            continue
        if marked(child, in_article):
            continue
        inside = in_article or child.name == "article"
        if child.name not in INLINE and child.children:
            owner = len(found)
            found.append(Block(child, inside))
            todo.append(owner)
        todo += [(c, owner, inside) for c in reversed(child.children)]
    found[0].end = len(found)
    for block in found:
        block.text = " ".join("".join(block.own).split())
    return found


def longest_two(blocks: list[tuple[int, int]]) -> list[tuple[int, int]]:
    return sorted(blocks, key=lambda b: (-b[0], b[1]))[:2]


def beside(top: Node) -> Iterator[tuple[int, int, int]]:
    """Key of each subtree, rank and hash of a content beside it; ``PAGE`` with the page's longest block."""
    found = page_blocks(top)
    in_article = any(b.inside and b.text for b in found)
    sizes = [len(b.text) if b.inside or not in_article else 0 for b in found]
    if not (most := max(sizes)):
        return
    # the longest two contents before and from each place on, as (length, place)
    sizes = [n if n >= CONTENT_SHARE * most else 0 for n in sizes]
    before, after = [[]], [[]]
    for i, n in enumerate(sizes):
        before.append(longest_two([*before[-1], (n, i)]) if n else before[-1])
    for i in range(len(sizes) - 1, -1, -1):
        after.append(longest_two([*after[-1], (sizes[i], i)]) if sizes[i] else after[-1])
    after.reverse()
    contents: dict[int, int] = {}

    def content(place: int) -> int:
        if place not in contents:
            contents[place] = xxhash.xxh64_intdigest(found[place].text.encode("utf-8", "replace")) - (1 << 63)
        return contents[place]

    yield PAGE, 0, content(after[0][0][1])
    hashes = hashed(top)
    for i, block in enumerate(found[1:], 1):
        if (digest := hashes.get(id(block.node))) is None:
            continue
        key = key_of(digest, block.inside)
        others = longest_two(before[i] + after[block.end]) or after[0][:1]
        # shares of the host's contents are taken of one content a page
        for rank, (_, place) in enumerate(others[:1] if block.inside else others):
            yield key, rank, content(place)


def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, page, and what stands ``beside`` every subtree of a page, each once."""
    for batch in slices(batches, 4 << 20):
        owners, found = [], []
        for i, html in enumerate(batch["t"].to_pylist()):
            one = set(beside(parse(html or "")))
            found += one
            owners += [i] * len(one)
        at = pa.array(owners, pa.int64())
        columns = [longs(x) for x in np.array(found, np.int64).reshape(-1, 3).T]
        yield pa.RecordBatch.from_arrays([batch["host"].take(at), batch["page"].take(at), *columns], names=["host", "page", "subtree", "rank", "content"])


def templates(found: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """host and subtree of every template, of rows host, subtree, rank and content."""
    kinds = found.select("host", "subtree", "rank", "content").distinct().groupBy("host", "subtree", "rank").count()
    counts = kinds.groupBy("host", "subtree").agg(F.max("count").alias("count")).where(F.col("count") >= least_pages)
    counts = stage(counts, "html-subtrees")
    totals = counts.where(F.col("subtree") == PAGE).select("host", F.col("count").alias("contents"))
    often = counts.where(F.col("subtree") != PAGE).join(totals, "host", "left")
    anywhere = F.col("subtree").bitwiseAND(F.lit(1)) == 0
    return often.where(anywhere | (F.col("count") >= F.col("contents") * least_share)).select("host", "subtree")


def page_templates(pages: DataFrame) -> DataFrame:
    """host, page and the templates on it, of pages with columns host, page and t; only pages that have some."""
    with scope(pages.sparkSession) as own:
        found = stage(pages.select("host", "page", "t").mapInArrow(subtrees, "host string, page long, subtree long, rank long, content long"), "html-found")
        held = found.join(templates(found), ["host", "subtree"], "left_semi")
        lists = stage(held.groupBy("host", "page").agg(F.collect_set("subtree").alias("subtrees")), "html-templates")
        own.keep(lists)
    return lists


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    source = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("t"))
    source = source.select("page_id", "url", split_url("url")[0], F.xxhash64("t").alias("page"), "t")
    joined = source.join(page_templates(source), ["host", "page"], "left").select("page_id", "url", "t", "subtrees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4 << 20):
            texts = [main_text(t or "", set(cut or ())) for t, cut in zip(batch["t"].to_pylist(), batch["subtrees"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64(), size=len(texts))], names=["page_id", "url", "text", "n_chars"])

    fields = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return joined.mapInArrow(run, f"page_id {fields['page_id']}, url string, text string, n_chars long")
