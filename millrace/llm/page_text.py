"""Main text of web pages by removal of site templates.

Each page is parsed into a tree whose element subtrees are hashed.  Spark counts, per
host, the distinct pages that hold a subtree; a subtree on at least ``LEAST_PAGES`` and
``LEAST_SHARE`` of them belongs to the site's template and is deleted wherever it stands
on that host.  A host therefore has at most ``1 / LEAST_SHARE`` times as many template
subtrees as an average page has subtrees, however many pages it has.

Inside an article only subtrees that are mostly links may be template, since articles
quote the same passages; elsewhere any may.  Elements whose tag, role or class says that
they are menus, headers, footers, sidebars, notices, adverts, forms or reader comments go
as well.  A class or id says so only as a whole name, or as one made of such words and
words for places and boxes: ``site-header``, but not ``no-sidebar`` or ``related-work``.
Forms and marked elements that hold more than half of the page's text outside links stay;
adverts, comments and the like stay only if they hold all of it.  The text is that of the article elements, or of the main element, or of
what remains of the body.

Defined results: a null or empty page has an empty text; markup may be broken or cut
off; a null URL is a host of its own; equal pages count once; repeated rows are all
returned; an empty table gives no rows; columns other than the three named are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_map, written

LEAST_PAGES = 5
LEAST_SHARE = 0.2
LINK_DENSITY = 0.5

# Names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s "
    "samp small span strike strong sub sup time tt u var".split()
)
UNSEEN = set("head script style noscript template svg iframe object canvas math audio video".split())
FURNITURE = set("nav header footer aside form menu dialog button select textarea fieldset".split())
ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disqus dropdown footer gdpr header login masthead "
    "menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup "
    "promo promotion related share sharing sidebar signup skip social sponsor sponsored subscribe "
    "toolbar widget".split()
)
# Marks that are no part of an article, even if most of the page's text stands there.
SURE = set(
    "ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus gdpr nav navbar pager pagination".split()
)
# Words that make no other name of a mark: site-header, ad-slot, comment-list.
PLACES = set(
    "area bar block bottom box btn button buttons container global icons inner left links list main "
    "page placeholder posts primary right secondary section site slot top unit wrap wrapper".split()
)
CONTROLS = set("a nav button select textarea".split())
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
LANDMARKS = {"article", "main"}


class Node:
    __slots__ = ("attrs", "chars", "digest", "holds_landmark", "kids", "links", "prose", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.kids: list[Node | str] = []
        self.digest = b""
        self.chars = self.links = self.prose = 0
        self.holds_landmark = False

    def marks(self) -> set[str]:
        """The marks that are whole classes or ids, or with words of places make them up."""
        found: set[str] = set()
        for name in f"{self.attrs.get('class', '')} {self.attrs.get('id', '')}".lower().split():
            words = set(re.split(r"[^a-z]+", name)) - {""}
            if words <= MARKS | PLACES:
                found |= words & MARKS
        return found

    def boilerplate(self, in_article: bool, prose: int) -> bool:
        """Whether tag, role or class says that this is no part of an article.

        ``prose`` is the length of the page's text outside links.
        """
        if self.tag in UNSEEN or "hidden" in self.attrs:
            return True
        if self.holds_landmark or self.tag in ("html", "body", "main"):
            return False
        if self.tag == "header" and in_article:
            return False
        role = self.attrs.get("role", "").lower()
        if self.tag in FURNITURE - {"form", "fieldset"} or role in ROLES - {"form", "search"}:
            return True
        marks = self.marks()
        if marks & SURE:
            return self.prose < prose or not prose
        if marks or self.tag in ("form", "fieldset") or role in ("form", "search"):
            return 2 * self.prose <= prose
        return False


class Tree(HTMLParser):
    """The tree of a page, however broken its markup is."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]
        # Where in ``open`` the elements of each tag are, the innermost last.
        self.places: dict[str, list[int]] = {}
        tail = html.rfind("<")
        if re.fullmatch(r"<[A-Za-z/!?][^>]*", html[tail:] if tail >= 0 else "", re.DOTALL):
            html = html[:tail]  # a tag that the page's end cuts off
        self.feed(html)
        self.close()
        while len(self.open) > 1:
            self._pop()
        self._sum_up(self.root)

    def _sum_up(self, node: Node) -> None:
        hashed = xxhash.xxh3_64(node.tag)
        for kid in node.kids:
            if isinstance(kid, str):
                text = " ".join(kid.split())
                node.chars += len(text)
                node.prose += len(text)
                hashed.update(b"\0" + text.encode("utf-8", "replace"))
            else:
                node.chars += kid.chars
                node.links += kid.links
                node.prose += kid.prose
                node.holds_landmark |= kid.holds_landmark or kid.tag in LANDMARKS
                hashed.update(b"\1" + kid.digest)
        if node.tag == "a":
            node.links = node.chars
        if node.tag in UNSEEN or node.tag in CONTROLS or "hidden" in node.attrs:
            node.prose = 0
        node.digest = hashed.digest()

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def _pop(self) -> None:
        node = self.open.pop()
        self.places[node.tag].pop()
        self._sum_up(node)

    def _innermost(self, tags: set[str]) -> int:
        """How deep the innermost open element of these tags is; 0 if there is none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def _pop_to(self, tags: set[str], borders: set[str]) -> None:
        """Close the innermost open element of these tags, unless a border is further in."""
        depth = self._innermost(tags)
        if depth and depth >= self._innermost(borders):
            while len(self.open) > depth:
                self._pop()

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in CLOSED_BY:
            self._pop_to(*CLOSED_BY[tag])
        elif tag not in INLINE and tag not in VOID:
            self._pop_to({"p"}, LANDMARKS | {"td", "th", "li", "div", "section", "body"})
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].kids.append(node)
        if tag in VOID:
            self._sum_up(node)
        else:
            self._push(node)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in INLINE:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        self._pop_to({tag}, LANDMARKS | {"body"} if tag in INLINE or tag == "p" else set())

    def handle_data(self, data: str) -> None:
        self.open[-1].kids.append(data)


def _walk(root: Node, enter) -> Iterator[tuple[Node | str, bool]]:
    """Nodes and texts in page order, each node again when it is left (True)."""
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        item, left = stack.pop()
        if isinstance(item, str) or left:
            yield item, left
        elif enter(item):
            yield item, False
            stack.append((item, True))
            stack.extend((kid, False) for kid in reversed(item.kids))


def _articles(root: Node) -> list[Node]:
    """The outermost article elements, or else main elements, that aren't boilerplate."""
    for tag in ("article", "main"):
        found: list[Node] = []

        def enter(node: Node, tag=tag, found=found) -> bool:
            if node.boilerplate(False, root.prose):
                return False
            if node.tag == tag or tag == "main" and node.attrs.get("role") == "main":
                found.append(node)
                return False
            return True

        for _ in _walk(root, enter):
            pass
        if found:
            return found
    return []


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def candidates(html: str) -> list[int]:
    """Hashes of the page's subtrees that may be template."""
    root = Tree(html).root
    articles = {id(a) for a in _articles(root)}
    found: set[int] = set()
    inside = 0

    def enter(node: Node) -> bool:
        return node.tag not in UNSEEN

    for item, left in _walk(root, enter):
        if isinstance(item, str):
            continue
        if id(item) in articles:
            inside += -1 if left else 1
        elif not left and item.chars and not item.holds_landmark and item.tag not in ("", "html", "body"):
            linked = item.links >= LINK_DENSITY * item.chars
            if not inside or linked and item.tag not in INLINE:
                found.add(_number(item.digest))
    return sorted(found)


def main_text(html: str, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The article's text: blocks in page order, without boilerplate and templates."""
    root = Tree(html).root
    articles = _articles(root)
    blocks: list[str] = []
    current: list[str] = []

    def end_block() -> None:
        if words := "".join(current).split():
            blocks.append(" ".join(words))
        current.clear()

    for top in articles or [root]:

        def enter(node: Node, top=top) -> bool:
            if node is top:
                return True
            gone = node.boilerplate(bool(articles), root.prose)
            if _number(node.digest) in templates and not node.holds_landmark:
                linked = node.links >= LINK_DENSITY * node.chars and node.tag not in INLINE
                gone = gone or linked or not articles
            if gone and node.tag not in INLINE | UNSEEN:
                end_block()
            return not gone

        for item, _ in _walk(top, enter):
            if isinstance(item, str):
                current.append(item)
            elif item.tag not in INLINE and item.tag != "wbr":
                end_block()
        end_block()
    return " ".join(blocks)


def host_of(url: Column) -> Column:
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.coalesce(F.regexp_extract(url, pattern, 1), F.lit("")))


def site_templates(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE
) -> DataFrame:
    """host and the hashes of its template subtrees, from pages with host and html."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_of = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([xxhash.xxh3_64_intdigest(h.encode()) - (1 << 63) for h in pages_of], pa.int64()),
                    pa.array([candidates(h) for h in pages_of], pa.list_(pa.int64())),
                ],
                names=["host", "page", "hashes"],
            )

    rows = pages.select("host", F.coalesce("html", F.lit("")).alias("html"))
    distinct = written(
        rows.transform(arrow_map, hashed, "host STRING, page BIGINT, hashes ARRAY<BIGINT>")
        .groupBy("host", "page")
        .agg(F.first("hashes").alias("hashes")),
        "page-subtrees",
    )
    totals = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    frequent = (
        distinct.select("host", F.explode("hashes").alias("hash"))
        .groupBy("host", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_pages)
    )
    return (
        frequent.join(totals, "host")
        .filter(F.col("n") >= least_share * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("hash").alias("templates"))
    )


def extracted(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_pages: int = LEAST_PAGES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                main_text(h or "", frozenset(t or ()))
                for h, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).alias("url"),
        F.col(html).alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    templates = written(site_templates(rows, least_pages, least_share), "site-templates")
    return (
        rows.join(templates, "host", "left")
        .select("page_id", "url", "html", "templates")
        .transform(arrow_map, texts, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
    )
