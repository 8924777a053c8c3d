"""Main-text extraction with tag-path ratios.

A page is read as blocks of text. Each piece of text lies on a root-to-leaf
tag path (inline elements included). Text length and punctuation marks are
totalled by path and divided by the path's number of nodes. Length levels off
slowly (by ``LINE`` characters), punctuation at ``MARKS`` marks. A block has the
ratios of its pieces' paths, weighted by length; they are smoothed along the
page and fused by their product. Blocks on paths that reach ``LEVEL`` of the
best are content.

Where a block stands and what its elements are called only moves that level,
and never beyond the best ratio: a name asks for a little more inside the
article, and outside of it, or on a page without one, a named block has to
come up to the article's own text (``ALIKE``) and be a full line (``FULL``). Names of reader comments alone
are final, as comments are prose like the article. Text elements themselves
(paragraphs, headings, list items, ...) have no say by their names.

What the ratios choose is kept wherever it stands. Around it stay the short
lines that the ratios can't judge: what no name speaks against in the article
or main element that holds the content, up to the last block chosen; behind
that only headings, lists, captions and the like that stand with the content,
not what stands in a box of its own. On a page without an article they stay in
the deepest element that holds nearly all of the content, and from there out
as long as an enclosing element adds only content, headings and lines between
its title and the content. At both ends of such an element blocks that are
mostly links are left out.

Elements that never hold article text by their kind (navigation, forms,
scripts, ...) or role, or that are hidden, are left out before the ratios are
taken. A name has no vote where its element holds most of the page's text, no
article stands outside it and little else on the page looks like content.

Reading is linear in the page: a tag that never ends makes quotes meaningless
from there on, and elements know the range of their blocks.

Defined results: null html gives the empty text. Unclosed elements end where
an enclosing one ends or where HTML lets them end; an unclosed comment or
script runs to the end of the page, and so does a last tag that is cut off. A
line break counts as white space.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit

#: A line's characters and marks, the part of the best product that is content, what a name leaves of a product inside the article.
LINE, MARKS, LEVEL, VOTE = 100, 3, 0.3, 0.6
#: The part of the best product that text outside the article, or named text on a page without one, has to reach, and the product itself, that of a full line; votes of a name that is final.
ALIKE, FULL, FINAL = 1.0, 0.6, 8
#: Width of the smoothing over neighbouring blocks; content that the content element holds at least.
SIGMA, COVER = 0.6, 0.9
#: An article is the page's if it holds this part of what stands outside; a name is mute if the rest is under this part of its text.
LEAST_ARTICLE, LEAST_REST = 0.25, 0.1

# Fixed values of the HTML language.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br nobr ruby rt rp rb tt".split())
_ENDS_P = frozenset("address article aside blockquote details dialog div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
_SCOPE = ("ul", "ol", "dl", "table", "body", "html", "article", "div", "section", "main")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
# Elements outside the article by their kind.
_NEVER = frozenset("head nav footer aside form script style noscript iframe object template button select option input textarea svg canvas dialog menu title noembed noframes audio video map".split())
# Names that vote against an element.
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header hidden masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted related reply replies respond share sharing sidebar sidebars skip social sponsor sponsored subscribe subscription tags toolbar widget widgets".split()
)
# Those that are final, as whole names.
_COMMENTS = frozenset("comment comments commentlist comment-list comment-section comment-thread comments-area comments-section comments-wrapper disqus disqus_thread replies reply respond".split())
# Those that vote at the end of a compound name too, unless one of the next opens it.
_LAST = frozenset("adsense advertisement adverts breadcrumb breadcrumbs commentlist comments menu nav navbar navigation newsletter pagination related share sharing sidebar sidebars".split())
_LAYOUT = frozenset("has is no not one two three with without".split())
# Lists, tables and links between a title and the content are no lines of the article.
_LISTED = frozenset("ul ol dl table a".split())
# Elements too small to be the content element; those whose links are prose.
_SMALL = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th ul ol".split())
# Text elements, whose own names say nothing; boxes, which stand apart behind the content.
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th".split())
_BOXES = frozenset("div section span center details".split())
_PROSE = frozenset("p pre blockquote figcaption dd dt h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^\"'>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：¿¡]")
_RIGHTS = re.compile(r"\W*(?:©|\(c\)\s|copyright\b|all rights reserved)", re.I)


@dataclass(slots=True)
class Element:
    """An element with the range of its blocks; parents come before children."""

    tag: str
    number: int
    parent: Element | None
    path: int
    off: bool
    # Votes of the element's own names.
    named: int
    first: int
    last: int = -1
    # Elements on the way from the root to here: h1, headings, those that make no line, votes.
    titles: int = 0
    headings: int = 0
    listed: int = 0
    votes: int = 0
    # The innermost element that is not inline, and whether a link stands inside it around this one.
    home: str = ""
    linked: bool = False


@dataclass(slots=True)
class Block:
    """A run of text between block boundaries; a piece is its element, its characters and its marks."""

    element: Element
    pieces: list[tuple[Element, int, int]] = field(default_factory=list)
    raw: list[str] = field(default_factory=list)
    text: str = ""


def _attributes(raw: str) -> list[tuple[str, str]]:
    return [(name.lower(), next((v for v in values if v), "")) for name, *values in _ATTRIBUTE.findall(raw)] if "=" in raw else []


def _is_off(tag: str, raw: str, attributes: list[tuple[str, str]], inside_article: bool) -> bool:
    """Whether an element is left out by its kind, its role or as hidden."""
    if tag in _NEVER or tag == "header" and not inside_article:
        return True
    if not raw or tag in ("html", "body", "article", "main"):
        return False
    for name, value in attributes:
        value = value.lower()
        if name == "role" and value in _ROLES or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return "hidden" in raw.lower() and bool(_HIDDEN.search(_QUOTED.sub("", raw)))


def _is_named(tag: str, attributes: list[tuple[str, str]]) -> int:
    """Votes of an element's class and id: FINAL for comments, 1 if one is, or opens with, a name of what is no article text; in a class a plain one may also end it."""
    if tag in ("html", "body", "article", "main") or tag in _LEAF:
        return 0
    vote = 0
    for kind, value in attributes:
        if kind not in ("class", "id") or kind == "id" and tag in _HEADINGS:
            continue
        for name in value.lower().split():
            if name in _COMMENTS:
                return FINAL
            words = [w for w in _SPLIT.split(name) if w] or [""]
            if words[0] in _WORDS and (len(words) == 1 or words[0] != "hidden") or kind == "class" and words[-1] in _LAST and words[0] not in _LAYOUT:
                vote = 1
    return vote


class _Reader:
    """Reads one page, forward only; ``blocks`` and ``elements`` are the result."""

    def __init__(self, page: str):
        self.page = page
        self.blocks: list[Block] = []
        self.root = Element("", 0, None, 0, False, 0, 0)
        self.elements = [self.root]
        self.stack = [self.root]
        self.open: dict[str, list[int]] = {}  # places in the stack by tag
        self.outer = [0]  # places in the stack of elements that are not inline
        self.paths: dict[tuple[int, str], int] = {}
        self.current: Block | None = None
        self._read()
        self._end_block()
        while self.stack:
            self.stack.pop().last = len(self.blocks)

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if not raw or top.off:
            return
        if self.current is None:
            self.current = Block(top)
        raw = html.unescape(raw) if "&" in raw else raw
        self.current.raw.append(raw)
        if size := len(" ".join(raw.split())):
            self.current.pieces.append((top, size, len(_PUNCTUATION.findall(raw))))

    def _end_block(self) -> None:
        if self.current is not None and self.current.pieces:
            self.current.text = " ".join("".join(self.current.raw).split())
            self.current.element = self.current.pieces[0][0]
            self.current.raw = []
            self.blocks.append(self.current)
        self.current = None

    def _pop_to(self, place: int) -> None:
        if self.outer[-1] >= place:
            self._end_block()
        while len(self.stack) > place:
            gone = self.stack.pop()
            gone.last = len(self.blocks)
            self.open[gone.tag].pop()
            if self.outer[-1] == len(self.stack):
                self.outer.pop()

    def _top(self, tags: tuple[str, ...]) -> int:
        """Place of the innermost open element of these tags, or -1."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=-1)

    def _end_tag(self, tag: str) -> None:
        if tag == "p" or tag not in _INLINE:
            self._end_block()
        place = self._top((tag,))
        if place >= 0 and not (tag in _INLINE and self._top(("td", "th", "table")) > place):
            self._pop_to(place)

    def _start_tag(self, tag: str, raw: str) -> Element | None:
        """Opens an element; None for one that has no content."""
        if tag == "br":
            self._text(" ")
            return None
        if tag in _VOID:
            if tag == "hr":
                self._end_block()
            return None
        if tag in _ENDS_P and self.stack[self.outer[-1]].tag == "p":
            self._pop_to(self.outer[-1])
        if tag in _SIBLINGS and (place := self._top(_SIBLINGS[tag])) > self._top(_SCOPE):
            self._pop_to(place)
        if tag not in _INLINE and tag not in ("script", "style"):
            self._end_block()
        parent = self.stack[-1]
        attributes = _attributes(raw) if raw else []
        off = parent.off or _is_off(tag, raw, attributes, bool(self.open.get("article") or self.open.get("main")))
        if off and not parent.off and tag in _INLINE:
            self._text(" ")
        named = _is_named(tag, attributes) if not off and attributes and not (self.open.get("pre") or self.open.get("code")) else 0
        if tag in ("svg", "path", "use") and raw.rstrip().endswith("/"):
            return None
        name = next((v for n, v in attributes if n == "class" and v), "")
        path = self.paths.setdefault((parent.path, f"{tag}.{name}" if name else tag), len(self.paths) + 1)
        return Element(
            tag, len(self.elements), parent, path, off, named, len(self.blocks), -1,
            parent.titles + (tag == "h1"), parent.headings + (tag in _HEADINGS), parent.listed + (tag in _LISTED), 0,
            parent.home if tag in _INLINE else tag, tag == "a" or tag in _INLINE and parent.linked,
        )

    def _push(self, element: Element) -> None:
        self.elements.append(element)
        self.open.setdefault(element.tag, []).append(len(self.stack))
        if element.tag not in _INLINE:
            self.outer.append(len(self.stack))
        self.stack.append(element)

    def _read(self) -> None:
        page, at, text_from, pattern = self.page, 0, 0, _TAG
        while (at := page.find("<", at)) >= 0:
            follow = page[at + 1 : at + 3]
            if follow[:1] in ("!", "?") or follow[:1] == "/" and not follow[1:2].isalpha():
                comment = page.startswith("<!--", at)
                end = page.find("-->", at + 2) if comment else page.find(">", at)
                self._text(page[text_from:at])
                text_from = at = len(page) if end < 0 else end + (3 if comment else 1)
                continue
            if not (follow[:1] if follow[:1] != "/" else follow[1:]).isalpha():
                at += 1
                continue
            m = pattern.match(page, at)
            if m is None and pattern is _TAG and page.find(">", at) >= 0:
                pattern = _PLAIN_TAG
                m = pattern.match(page, at)
            if m is None:
                if page.find(">", at) < 0:  # cut off inside a tag
                    self._text(page[text_from:at])
                    return
                at += 1
                continue
            self._text(page[text_from:at])
            text_from = at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._end_tag(tag)
            elif (element := self._start_tag(tag, m[3])) is not None:
                if tag in _RAW:
                    end = _RAW_END[tag].search(page, at)
                    at = page.find(">", end.end()) + 1 if end else 0
                    text_from = at = at or len(page)
                else:
                    self._push(element)
        self._text(page[text_from:])


def _smoothed(values: list[float]) -> list[float]:
    """Gaussian weights over a block and its neighbours."""
    w = math.exp(-1 / (2 * SIGMA * SIGMA))
    n = len(values)
    return [
        (values[i] + w * ((values[i - 1] if i else 0.0) + (values[i + 1] if i + 1 < n else 0.0))) / (1 + w * ((i > 0) + (i + 1 < n)))
        for i in range(n)
    ]


def fused_ratios(found: list[Block]) -> list[float]:
    """The product of both smoothed path ratios for each block, before any vote."""
    totals: dict[int, list[int]] = {}
    for b in found:
        met = set()
        for e, size, marks in b.pieces:
            t = totals.setdefault(e.path, [0, 0, 0])
            t[0] += size
            t[1] += marks
            t[2] += e.path not in met
            met.add(e.path)
    ratio = {p: (1 - math.exp(-size / nodes / LINE), min(1.0, (marks / nodes + 1) / (MARKS + 1))) for p, (size, marks, nodes) in totals.items()}
    length, marks = [], []
    for b in found:
        whole = sum(size for _, size, _ in b.pieces)
        length.append(sum(ratio[e.path][0] * size for e, size, _ in b.pieces) / whole)
        marks.append(sum(ratio[e.path][1] * size for e, size, _ in b.pieces) / whole)
    return [a * b for a, b in zip(_smoothed(length), _smoothed(marks), strict=True)]


def passing(products: list[float], needed: list[float]) -> list[bool]:
    """Which products reach what is needed of the best (over 1: none can), and are those of a full line where ALIKE is needed."""
    best = max((p for p, need in zip(products, needed, strict=True) if need == LEVEL), default=max(products, default=0.0))
    return [need <= 1 and p >= need * best and (p >= FULL or need < ALIKE) for p, need in zip(products, needed, strict=True)]


def _before(values: list[int]) -> list[int]:
    """Sum of the values before each place, and of all."""
    out = [0]
    for v in values:
        out.append(out[-1] + v)
    return out


def _own_article(elements: list[Element], likely: list[int]) -> Element | None:
    """The page's one outermost article, or else its one main element, unless what looks like content stands elsewhere."""
    text = _before(likely)
    for tag in ("article", "main"):
        outer: list[Element] = []
        for e in elements:
            if e.tag == tag and e.last > e.first and not e.off and not (outer and e.first < outer[-1].last):
                outer.append(e)
        if len(outer) == 1:
            inside = text[outer[0].last] - text[outer[0].first]
            return outer[0] if inside >= LEAST_ARTICLE * (text[-1] - inside) else None
    return None


def _count_votes(elements: list[Element], found: list[Block], looks: list[bool]) -> list[int]:
    """Votes by name against each block, after muting those of elements that hold the page's text."""
    sizes = _before([len(b.text) for b in found])
    articles = [e for e in elements if e.tag in ("article", "main") and e.last > e.first]
    span = (min((a.first for a in articles), default=len(found)), max((a.last for a in articles), default=0))

    def count(muted: set[int]) -> list[int]:
        for e in elements[1:]:
            e.votes = e.parent.votes + (e.named if e.number not in muted else 0)
        return [min(e.votes for e, _, _ in b.pieces) for b in found]

    votes = count(set())
    free = _before([len(b.text) if not v and y else 0 for b, v, y in zip(found, votes, looks, strict=True)])
    muted = set()
    for e in elements:
        inside = sizes[e.last] - sizes[e.first]
        if e.named and 2 * inside > sizes[-1] and free[-1] - (free[e.last] - free[e.first]) <= LEAST_REST * inside and e.first <= span[0] and span[1] <= e.last:
            muted.add(e.number)
    return count(muted) if muted else votes


def _climbed(found: list[Block], yes: list[bool], content: Element) -> Element:
    """The highest element around content whose other blocks belong to it too."""
    around = []
    up = content.parent
    while up is not None:
        around.append(up)
        up = up.parent
    around.reverse()
    starts, ends = [e.first for e in around], [-e.last for e in around]
    title = stop = 0
    for i, b in enumerate(found):
        if content.first <= i < content.last:
            continue
        # So many elements around the content hold the block too.
        n = bisect_right(starts, i) if i < content.first else bisect_right(ends, -i - 1)
        shared, own = around[n - 1], b.element
        if own.titles > shared.titles:
            title = max(title, n)
        line = i < content.first and n <= title and own.listed == shared.listed
        if not (yes[i] or line or own.headings > shared.headings):
            stop = max(stop, n)
    return around[stop] if stop < len(around) else content


def _mostly_links(b: Block) -> bool:
    """Whether a block is links, and no paragraph or the like."""
    linked = sum(size for e, size, _ in b.pieces if e.linked)
    return 2 * linked > sum(size for _, size, _ in b.pieces) and b.element.home not in _PROSE


def _of_article(found: list[Block], yes: list[bool], against: list[int], article: Element) -> list[Block]:
    """What the ratios chose anywhere, and the lines of the article that belong to it."""
    last = max(i for i in range(article.first, article.last) if yes[i])
    apart: dict[int, bool] = {}

    def boxed(e: Element) -> bool:
        """Whether a box lies between an element and what it has in common with the last block chosen."""
        way = []
        while e.number not in apart and not e.first <= last < e.last:
            way.append(e)
            e = e.parent
        out = apart.get(e.number, False)
        for step in reversed(way):
            out = out or step.tag in _BOXES
            apart[step.number] = out
        return out

    def belongs(i: int, b: Block) -> bool:
        if yes[i]:
            return True
        if not article.first <= i < article.last or against[i] > 0:
            return False
        return i < last or not (boxed(b.element) or _mostly_links(b))

    return [b for i, b in enumerate(found) if belongs(i, b)]


def content_blocks(page: str) -> list[Block]:
    """The blocks of the article, in page order."""
    reader = _Reader(page)
    found, elements = reader.blocks, reader.elements
    if not found:
        return []
    products = fused_ratios(found)
    looks = passing(products, [LEVEL] * len(found))
    votes = _count_votes(elements, found, looks)
    article = _own_article(elements, [len(b.text) if y and not v else 0 for b, y, v in zip(found, looks, votes, strict=True)])
    if article is None:
        against = [v + bool(_RIGHTS.match(b.text)) for v, b in zip(votes, found, strict=True)]
        needed = [2.0 if v >= FINAL else ALIKE if v else LEVEL for v in against]
    else:
        against = [v - article.votes for v in votes]
        needed = [2.0 if v >= FINAL else LEVEL / VOTE ** max(0, v) if article.first <= i < article.last else ALIKE for i, v in enumerate(against)]
    yes = passing(products, needed)
    text = _before([len(b.text) if y else 0 for b, y in zip(found, yes, strict=True)])
    if article is not None and text[article.last] > text[article.first]:
        return _of_article(found, yes, against, article)
    # Numbers grow with depth along a path, so the last of the holders is the deepest.
    holders = [e for e in elements if text[e.last] - text[e.first] >= COVER * text[-1] and e.tag not in _INLINE and e.tag not in _SMALL]
    content = _climbed(found, yes, holders[-1])
    sure = [i for i in range(content.first, content.last) if yes[i]]

    def belongs(i: int, b: Block) -> bool:
        if yes[i]:
            return True
        if not content.first <= i < content.last or against[i] > content.votes:
            return False
        return sure[0] < i < sure[-1] or not _mostly_links(b)

    return [b for i, b in enumerate(found) if belongs(i, b)]


def main_text(page: str) -> str:
    """The article's blocks, one a line."""
    return "\n".join(b.text for b in content_blocks(page))


def extracted(pages: DataFrame, *, html_column: str = "html") -> tuple[DataFrame, str]:
    """pages with a column of main text; returns the frame and that column's name."""
    name = kit.free_name(pages, "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kit.cut(batch, html_column):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([main_text((t or b"").decode()) for t in texts], pa.string())], [*part.schema.names, name])

    return pages.mapInArrow(work, T.StructType([*pages.schema.fields, T.StructField(name, T.StringType())])), name


def report(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    out, name = extracted(pages.select(page_id, url, html_column), html_column=html_column)
    return out.select(page_id, url, F.col(name).alias("text"), F.char_length(name).cast("long").alias("n_chars"))
