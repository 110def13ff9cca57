"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each at the end of a path of tags from the root. Per path, text length and punctuation
per block are aggregated; both ratios are smoothed over the blocks in page order, fused, and paths above a threshold are
content. <article> and <main> raise a score; a class or id that says something else (advert, comments) lowers it, unless its element
wraps the page: it holds an <article>, <main> or <h1> and more than half of the text, or paragraphs and most of the text. All blocks
on content paths are kept, but nothing beside an <article> or <main> that holds more than half of them. So are, inside the
lowest element around them (raised to those that hold paragraphs or headings beside it, unless it is an article), the short
blocks, lists and headings of every part that holds some, and its title. Left out are other parts (div, section) without any, and what is no text by its
tag, role or style (nav, footer, aside, hidden). A page of nothing but parts that say something else has no text.

Pages are independent, so nothing is shuffled; a page is held by one task, in memory and time linear in its length and depth.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: A comment, a tag with quoted attributes, or another declaration.
TOKEN = re.compile(r"""<!--(?s:.*?)(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)|<[!?][^>]*(?:>|\Z)""")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
MARKS = re.compile(r"[.,;:!?…。，；：！？、]")
HINT_WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
#: Elements that are never part of a text.
DROPPED = RAW | frozenset("svg math canvas object audio video map select option optgroup datalist button input label fieldset legend dialog menu head".split())
BOILERPLATE = frozenset("nav footer aside".split())
#: Elements that stand in a line of text and do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"}}
SCOPE = frozenset("table ul ol dl article section div body html main aside nav".split())
HINTS = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "sidebar aside footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay comment comments disqus reply replies "
    "respond share sharing social related recommended newsletter subscribe signup login search form widget pagination pager copyright legal disclaimer skip hidden".split()
)
#: Words that change nothing beside a hint: site-footer says what footer says, article-header and has-sidebar do not.
NEUTRAL = frozenset(
    "site page main global top bottom left right box bar block area slot unit zone list item items wrapper wrap container inner outer content section panel module "
    "row col column group link links button buttons text posts articles stories primary secondary google sticky fixed mobile desktop".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
ARTICLE = frozenset("article main".split())

#: Elements that are a piece of the text around them and no part of a page of their own.
WITHIN = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 hgroup header li ul ol dl dt dd blockquote pre figure figcaption table caption thead tbody tfoot tr td th center address".split())

PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())

#: Half width of the window that ratios are smoothed over, and the share of the mean score that content has.
SMOOTH, THRESHOLD = 2, 0.5
#: Factor of the score of what stands in <article> or <main>.
BONUS = 2.0
#: Factor of the score of what says by class, id or tag that it is something else, and the share of a page that such an element wraps.
DOUBT, MOST = 0.05, 0.8
LEADS = frozenset("article main h1".split())


class _Node:
    __slots__ = ("tag", "path", "parent", "index", "out", "says", "article", "prose")

    def __init__(self, tag: str, path: int, parent: _Node | None, index: int, out: bool = False, says: bool = False) -> None:
        self.tag, self.path, self.parent, self.index, self.says = tag, path, parent, index, says
        self.out: bool = out or (parent is not None and parent.out)
        self.article: bool = tag in ARTICLE or (parent is not None and parent.article)
        self.prose: bool = tag in PROSE or (tag in INLINE and parent is not None and parent.prose)


def hinted(value: str) -> bool:
    """Whether a class or id has a token made of words for something else, with or without neutral ones."""
    for token in value.split():
        words = {w for w in HINT_WORDS.findall(token) if len(w) > 1}
        if not words.isdisjoint(HINTS) and words <= HINTS | NEUTRAL:
            return True
    return False


def _told(tag: str, attributes: str, parent: _Node) -> tuple[str, bool, bool]:
    """The tag with its class and id for the path, whether it is no text, and whether it says that it is something else."""
    out = tag in DROPPED or tag in BOILERPLATE or (tag == "header" and not parent.article)
    says = tag == "form"
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag, out, says
    mark = tag
    for m in ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id"):
            mark += f".{value}"
            if tag not in ("html", "body", "article", "main"):
                says = says or hinted(value)
        elif name == "role":
            out = out or value in ROLES
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            out = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out = True
    return mark, out, says


def blocks(page: str) -> tuple[list[_Node], list[tuple[_Node, str]]]:
    """Elements in page order, and blocks of text, each with the element it began in; scripts, styles and other raw parts are left out."""
    root = _Node("#root", 0, None, 0)
    nodes, stack = [root], [root]
    paths: dict[tuple[int, str], int] = {}
    still_open: Counter[str] = Counter()
    found: list[tuple[_Node, str]] = []
    parts: list[str] = []
    owner: list[_Node | None] = [None]

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                found.append((owner[0] or root, text))
            parts.clear()
        owner[0] = None

    def text(part: str) -> None:
        if part:
            if owner[0] is None and not part.isspace():
                owner[0] = stack[-1]
            parts.append(part)

    def pop_to(i: int) -> None:
        if any(n.tag not in INLINE for n in stack[i:]):
            flush()
        still_open.subtract(n.tag for n in stack[i:])
        del stack[i:]

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                flush()
            for i in range(len(stack) - 1 if still_open[tag] else 0, 0, -1):
                if stack[i].tag == tag:
                    pop_to(i)
                    break
                # A stray inline end tag does not close blocks.
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            continue
        if tag in CLOSES_P and still_open["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in SAME and any(still_open[t] for t in SAME[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SAME[tag]:
                    pop_to(i)
                elif stack[i].tag in SCOPE:
                    break
        if tag in VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            if not (m[3] or "").rstrip().endswith("/") or tag in ("script", "style"):
                at = end.end() if end else size
            continue
        if tag not in INLINE:
            flush()
        mark, out, says = _told(tag, m[3] or "", stack[-1])
        if not ((m[3] or "").rstrip().endswith("/") and tag in ("svg", "path")):
            path = paths.setdefault((stack[-1].path, mark), len(paths) + 1)
            nodes.append(_Node(tag, path, stack[-1], len(nodes), out, says))
            stack.append(nodes[-1])
            still_open[tag] += 1
    flush()
    return nodes, found


def _upwards(nodes: list[_Node], values: list[int]) -> list[int]:
    """Sums of ``values`` over each element and all inside it."""
    for n in reversed(nodes):
        if n.parent is not None:
            values[n.parent.index] += values[n.index]
    return values


def _doubted(nodes: list[_Node], kept: list[tuple[_Node, str]]) -> list[bool]:
    """Whether an element or one around it says that it is something else and does not wrap the page."""
    doubted = [n.says for n in nodes]
    if any(doubted):
        size, leads, prose = [0] * len(nodes), [int(n.tag in LEADS and not n.out) for n in nodes], [0] * len(nodes)
        for n, t in kept:
            size[n.index] += len(t)
            prose[n.index] += n.prose
        for values in (size, leads, prose):
            _upwards(nodes, values)
        for n in nodes[1:]:
            i = n.index
            wraps = 2 * size[i] > size[0] if leads[i] else prose[i] and size[i] >= MOST * size[0]
            doubted[i] = doubted[n.parent.index] or (n.says and not wraps)
    return doubted


def content(nodes: list[_Node], found: list[tuple[_Node, str]]) -> list[str]:
    """The blocks of the article."""
    kept = [(n, t) for n, t in found if not n.out]
    doubted = _doubted(nodes, kept)
    doubt = np.array([doubted[n.index] for n, _ in kept], bool)
    if doubt.all():
        return []
    paths: dict[int, int] = {}
    ids = np.array([paths.setdefault(n.path, len(paths)) for n, _ in kept])
    length = np.array([len(t) for _, t in kept], float)
    marks = np.array([len(MARKS.findall(t)) for _, t in kept], float)
    count = np.bincount(ids)

    def smooth(x: np.ndarray) -> np.ndarray:
        window = np.ones(2 * SMOOTH + 1)
        return np.convolve(x, window)[SMOOTH : SMOOTH + len(x)] / np.convolve(np.ones(len(x)), window)[SMOOTH : SMOOTH + len(x)]

    # Ratio of a path: characters, and marks, for each of its blocks.
    own_ratio = (np.bincount(ids, length) / count)[ids]
    text_ratio = np.sqrt(own_ratio * smooth(own_ratio))  # a short path between long ones stays below them
    mark_ratio = smooth((np.bincount(ids, marks) / count)[ids])
    fused = text_ratio * (1.0 + mark_ratio) * np.where([n.article for n, _ in kept], BONUS, 1.0) * np.where(doubt, DOUBT, 1.0)
    by_path = np.bincount(ids, fused) / count
    chosen = (by_path >= THRESHOLD * (by_path * np.bincount(ids, length)).sum() / length.sum())[ids]
    # How many chosen blocks each element holds, and the lowest one that holds them all.
    around, share = [0] * len(nodes), [0] * len(nodes)
    for i in np.flatnonzero(chosen):
        n, t = kept[i]
        around[n.index] += 1
        share[n.index] += 0 if doubt[i] else len(t)
    _upwards(nodes, around)
    _upwards(nodes, share)
    top = kept[int(np.argmax(chosen))][0]
    while around[top.index] < around[0] or top.parent is not None and top.tag in WITHIN:
        top = top.parent
    # The part each element belongs to.
    part = [0] * len(nodes)
    for n in nodes[1:]:
        part[n.index] = part[n.parent.index] if n.tag in WITHIN else n.index
    declared = [n for n in nodes if n.tag in ARTICLE and not n.out and not doubted[n.index] and 2 * share[n.index] > share[0]]
    if declared:
        # A declared article is kept to its borders.
        top = declared[-1]
    else:
        # Paragraphs and headings around one dominant part belong to the same text.
        prose = {part[n.index] for n, _ in kept if n.prose and not doubted[n.index]}
        up = top
        while up.parent is not None and up.tag not in ARTICLE:
            up = up.parent
            if up.index in prose:
                top = up
    inside, titled = [False] * len(nodes), [False] * len(nodes)
    for n in nodes:
        inside[n.index] = n is top or (n.parent is not None and inside[n.parent.index])
        titled[n.index] = n.tag == "h1" or (n.tag in INLINE and titled[n.parent.index])

    def belongs(n: _Node) -> bool:
        # Short blocks go with the part they stand in, a title with the text around it.
        if doubted[n.index] or not inside[part[n.index]]:
            return False
        return around[part[n.index]] > 0 or titled[n.index]

    return [t for (n, t), c in zip(kept, chosen, strict=True) if c and (inside[n.index] or not declared) or belongs(n)]


def extract(page: str | None) -> str:
    """Main text: blocks with single spaces inside, joined by one space. Empty for NULL or a page without text."""
    return " ".join(content(*blocks(page))) if page else ""


def with_text(pages: DataFrame, page: str = "html") -> DataFrame:
    """``pages`` without ``page`` plus ``text`` and ``n_chars`` (code points)."""
    kept = [f for f in pages.schema.fields if f.name not in (page, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py()) for h in batch.column(page)]
            found = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], *found], [*[f.name for f in kept], "text", "n_chars"])

    schema = StructType([*kept, StructField("text", StringType()), StructField("n_chars", LongType())])
    return pages.withColumn(page, F.col(page).cast("string")).mapInArrow(run, schema)
