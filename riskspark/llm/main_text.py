"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text; each has a root-to-leaf path of block elements (with their first class or id). Per path the
text outside links and the punctuation are added up and divided by the number of its blocks: text ratio and punctuation ratio.
Both are smoothed along the page with a Gaussian and fused into one score (the root of their product, less the share of link
text). Paths whose score reaches the mean less `strictness` standard deviations, weighted by text, are content paths.

The content node is the article (or else `main`) that holds most of the text of the content paths, all of them where none does,
or on pages without either the deepest container with `share` of that text. Below it every block counts, short lines and
headings included, but for parts that hold no content path and are mostly links or, on pages without an article, mere
containers. A heading right before the content node belongs to it.

Left out whatever their score, as they are no article by definition: scripts, styles, templates, navigation, forms and their
controls, page headers (a header inside an article belongs to it), footers, asides, dialogs, hidden elements, and elements whose
class, id or role names an advert, menu, sidebar, notice, banner, share bar, related list or reader comment. Where every article
lies in such an element, the mark around it does not count.

Parsing follows the HTML rules that matter for text: raw text elements end only at their own end tag, comments and
declarations vanish, end tags of p, li, td and the like may be missing, stray end tags are ignored, a cut-off tag at the end is
dropped, character references are decoded in text. Inline elements do not break a block; `br` is white space.

Scale: a page is judged by itself inside an Arrow task; there is no shuffle and nothing to broadcast. Memory is that of one batch.
Nulls and empty tables: a null html is an empty page with an empty text; null url and page_id pass through; repeated rows
give equal rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
REMOVED = frozenset(
    "head script style template noscript nav fieldset button select textarea input option datalist footer aside dialog iframe object embed applet svg canvas math audio video map noembed noframes title menu xmp".split()
)
#: Start tags that end an open element of these names, unless one of the scopes lies between.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("tr", "td", "th"),
    "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"),
    "thead": ("tbody", "thead", "tfoot", "tr", "td", "th"),
    "tfoot": ("tbody", "thead", "tfoot", "tr", "td", "th"),
    "option": ("option",),
    "body": ("head",),
}
SCOPES = frozenset("ul ol dl table body html article section main div".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body article main section div center td".split())
#: What may stand in a head.
IN_HEAD = frozenset("title meta link style script base noscript template".split())
#: Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored banner promo promotion cta aside rail sidebar nav navbar navigation menu toc "
    "breadcrumb breadcrumbs masthead topbar footer cookie cookies consent gdpr notice notices notification alert toast popup modal overlay subscribe "
    "subscription newsletter signup login share sharing social related recommended recommendations comment comments commentlist disqus respond reply "
    "replies pagination pager toolbar copyright disclaimer search complementary contentinfo widget widgets outbrain taboola paywall".split()
)
#: Before a mark these say what an element goes with, not what it is; before `header` these say that it is the article's.
WITH = frozenset("has with no without".split())
OF_ARTICLE = frozenset("article post entry story content section".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>\"']|$)", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\.")
STOPS = re.compile(r"[.,;:!?…、。，！？]")


def names_side_matter(words: list[str], in_article: bool) -> bool:
    """Whether the words of class, id and role, with a `.` between the three, mark what is not the article."""
    for at, word in enumerate(words):
        before = words[at - 1] if at else "."
        if (word in MARKS or before + word in MARKS) and before not in WITH:
            return True
        if word == "header" and not in_article and before not in OF_ARTICLE | WITH:
            return True
    return False


class Node:
    """An element: number of its path, whether it is left out (`gone`) or named a side matter (`marked`), first and last block."""

    __slots__ = ("first", "gone", "in_article", "last", "marked", "name", "path", "up")

    def __init__(self, name: str, up: Node | None, path: int, gone: bool, marked: bool, first: int):
        self.name, self.up, self.path, self.gone, self.marked, self.first, self.last = name, up, path, gone, marked, first, -1
        self.in_article = name in ("article", "main") or (up is not None and up.in_article)


class Page:
    """Blocks of a page: text, characters in links and the element each is in. `nodes` are the elements around blocks."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.linked: list[int] = []
        self.owners: list[Node] = []
        self.nodes: list[Node] = []
        self.parts: list[str] = []
        self.link, self.in_links = 0, 0
        self.paths: dict[tuple[int, str], int] = {}
        self.top = Node("", None, 0, False, False, 0)
        self.open: list[Node] = [self.top]
        self.read(source)

    def close_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.texts.append(text)
                self.linked.append(min(self.in_links, len(text)))
                self.owners.append(self.open[-1])
            self.parts, self.in_links = [], 0

    def text(self, raw: str) -> None:
        if self.open[-1].name == "head" and raw.strip():
            self.leave(len(self.open) - 1)
        if self.open[-1].gone:
            return
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.link:
            self.in_links += len(text.strip())

    def enter(self, name: str, attributes: str) -> None:
        up = self.open[-1]
        label, gone, marked = name, up.gone or name in REMOVED, name == "form"
        if name == "header" and not up.in_article:
            gone = True
        if attributes and name not in ("html", "body"):
            named: dict[str, str] = {}
            for found in ATTRIBUTE.finditer(attributes):
                named.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
            gone = gone or "hidden" in named or named.get("aria-hidden", "").lower() == "true" or UNSEEN.search(named.get("style", "")) is not None
            words = [w.lower() for w in PART.findall(" . ".join(named.get(key, "") for key in ("class", "id", "role")))]
            marked = marked or (name != "main" and names_side_matter(words, up.in_article))
            first = (named.get("class", "").split() or [named.get("id", "")])[0]
            label = f"{name}.{first}" if first else name
        path = self.paths.setdefault((up.path, label), len(self.paths) + 1)
        node = Node(name, up, path, gone, marked, len(self.texts))
        self.open.append(node)
        self.nodes.append(node)

    def leave(self, place: int) -> None:
        for node in self.open[place:]:
            node.last = len(self.texts)
        del self.open[place:]

    def end(self, names: tuple[str, ...], scopes: frozenset[str]) -> bool:
        """Closes the innermost open element of these names, if no scope lies between; whether it did."""
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].name in names:
                self.leave(place)
                return True
            if self.open[place].name in scopes:
                return False
        return False

    def read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            found = TOKEN.search(source, at)
            if found is None:
                self.text(source[at:])
                break
            if found.start() > at:
                self.text(source[at : found.start()])
            at = found.end()
            name = found[2]
            if name is None:
                if found[0].startswith("<![CDATA["):
                    self.text(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            if found[4] != ">":
                break  # the page ends inside a tag
            name = name.lower()
            if found[1]:
                self.end_tag(name)
                continue
            if self.open[-1].name == "head" and name not in IN_HEAD:
                self.leave(len(self.open) - 1)
            if name in INLINE:
                if name == "a":
                    self.link = 1
                elif name == "br":
                    self.parts.append(" ")
                if name not in VOID and found[3]:
                    self.enter(name, found[3])
                    if not self.open[-1].gone or self.open[-2].gone:
                        self.open.pop()
                        self.nodes.pop()
                continue
            self.close_block()
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                at = close.end() if close else size
                continue
            if name in VOID:
                continue
            if name not in ENDS or name == "body":
                self.end(("p",), SCOPES)
            if name in ENDS:
                while self.end(ENDS[name], SCOPES):
                    pass
            self.link = 0
            self.enter(name, found[3])
        self.close_block()
        self.leave(0)

    def end_tag(self, name: str) -> None:
        if name == "a":
            self.link = 0
        if name in INLINE:
            if name == "br":
                self.parts.append(" ")
            elif any(n.name == name for n in self.open):  # one that is not shown
                self.end((name,), SCOPES)
            return
        self.close_block()
        names = tuple(HEADINGS) if name in HEADINGS else (name,)
        self.end(names, frozenset() if name in ("table", "body", "html") else frozenset(("table",)) if name in SCOPES else frozenset(("table", "article", "main", "body")))


def smooth(values: np.ndarray, width: float) -> np.ndarray:
    """Gaussian mean along the page; the weights at the edges are made to add up to one."""
    if len(values) < 2:
        return values
    reach = min(int(3 * width), len(values) - 1)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / width) ** 2)
    return np.convolve(values, kernel)[reach:-reach] / np.convolve(np.ones(len(values)), kernel)[reach:-reach]


def path_scores(paths: list[int], texts: list[str], linked: list[int], width: float) -> dict[int, float]:
    """Fused score of each path: smoothed text ratio times smoothed punctuation ratio, less the share of link text."""
    number = {path: i for i, path in enumerate(dict.fromkeys(paths))}
    own = np.array([number[path] for path in paths])
    sizes, links = np.array([len(t) for t in texts], float), np.array(linked, float)
    stops = np.array([len(STOPS.findall(t)) for t in texts], float)
    count = np.bincount(own)
    ratio = np.bincount(own, sizes - links) / count
    marks = np.bincount(own, stops) / count
    share = np.bincount(own, links) / np.bincount(own, sizes)
    fused = np.sqrt(smooth(ratio[own], width) * (1 + smooth(marks[own], width))) * (1 - share[own])
    return dict(zip(number, np.bincount(own, fused * sizes) / np.bincount(own, sizes), strict=True))


def unmarked(nodes: list[Node], size: int) -> np.ndarray:
    """Which of `size` blocks lie in no marked element."""
    change = np.zeros(size + 1, np.int64)
    for node in nodes:
        if node.marked:
            change[node.first] += 1
            change[node.last] -= 1
    return np.cumsum(change)[:-1] == 0


def articles(page: Page) -> tuple[list[Node], np.ndarray]:
    """The innermost articles, or else mains, with a block of their own that is kept, and which blocks are kept."""
    keep = unmarked(page.nodes, len(page.texts))
    holders = [n for n in page.nodes if n.name in ("article", "main") and n.last > n.first and not n.marked]
    if holders and not any(keep[n.first : n.last].any() for n in holders):
        for node in holders:
            while (node := node.up) is not None:
                node.marked = False
        keep = unmarked(page.nodes, len(page.texts))
    holders = [n for n in holders if keep[n.first : n.last].any()]
    chosen = [n for n in holders if n.name == "article"] or holders
    inner, reached = [], len(page.texts) + 1
    for node in reversed(chosen):  # an inner one comes after the ones around it and begins before they end
        if node.last <= reached:
            inner.append(node)
            reached = node.first
    return inner[::-1], keep


def child_towards(node: Node, top: Node) -> Node:
    """The child of `top` that holds `node`; `top` itself where that is `node`."""
    while node is not top and node.up is not top and node.up is not None:
        node = node.up
    return node


def main_blocks(source: str, strictness: float = 0.5, share: float = 0.9, width: float = 1.0) -> list[str]:
    """The blocks of the main text of a page, in page order."""
    page = Page(source)
    if not page.texts:
        return []
    found, keep = articles(page)
    left = np.flatnonzero(keep).tolist()
    if found:
        left = [i for i in left if any(n.first <= i < n.last for n in found)]
    if not left:
        return []
    paths = {i: page.owners[i].path for i in left}
    scores = path_scores([paths[i] for i in left], [page.texts[i] for i in left], [page.linked[i] for i in left], width)
    sizes = np.array([len(page.texts[i]) for i in left], float)
    values = np.array([scores[paths[i]] for i in left])
    mean = float(np.average(values, weights=sizes))
    least = mean - strictness * float(np.sqrt(np.average((values - mean) ** 2, weights=sizes)))
    content = np.zeros(len(page.texts))
    content[left] = np.where(values >= least - 1e-9, sizes, 0)
    total = np.append(0, np.cumsum(content))

    def held(node: Node) -> float:
        return total[node.last] - total[node.first]

    if found:
        largest = max(found, key=held)
        tops = [largest] if held(largest) >= 0.5 * total[-1] else [n for n in found if held(n)]
    else:
        top = page.top
        for node in page.nodes:  # inner elements come after the ones around them
            if node.name in CONTAINERS and top.first <= node.first and node.last <= top.last and held(node) >= share * total[-1]:
                top = node
        tops = [top]
    return [page.texts[i] for i in sorted({i for top in tops for i in below_top(page, top, left, content, keep, bool(found))})]


def below_top(page: Page, top: Node, left: list[int], content: np.ndarray, keep: np.ndarray, named: bool) -> list[int]:
    """The blocks of a content node, with the heading right before it."""
    own = [i for i in left if top.first <= i < top.last]
    parts: dict[Node, list[int]] = {}
    for i in own:
        parts.setdefault(child_towards(page.owners[i], top), []).append(i)
    chosen = []
    for part, blocks in parts.items():
        size = sum(len(page.texts[i]) for i in blocks)
        links = sum(page.linked[i] for i in blocks)
        if content[blocks].any() or part.name in HEADINGS or part is top or ((named or part.name not in CONTAINERS) and links <= 0.5 * size):
            chosen += blocks
    if own and not any(page.owners[i].name == "h1" for i in own):
        before = [i for i in range(top.first) if keep[i]]
        if before and page.owners[before[-1]].name in ("h1", "h2"):
            chosen.append(before[-1])
    return chosen


def main_text(pages: DataFrame, strictness: float = 0.5, share: float = 0.9) -> DataFrame:
    """Per row: page_id, url, text (blocks joined by two line feeds; empty if none), n_chars (its code points)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(main_blocks(source, strictness, share)) if source else "" for source in batch.column("html").to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(of, "page_id bigint, url string, text string, n_chars bigint")
