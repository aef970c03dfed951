"""HTML to the text a reader would see, laid out.

A tolerant builder makes a tree of the markup: it closes what the next tag
implies closed, ends the head at the first content, and leaves out end tags
that close nothing.  Rendering drops what is not displayed, collapses spaces
outside preformatted text, sets blocks on their own lines, numbers and indents
lists, and puts table cells in columns.

Both walk with stacks of their own, so the depth of a page does not matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from unicodedata import combining, east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harbor.llm.texts import map_texts, slices

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is text up to their own end tag; that of the last two
#: is still read for character references.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
ESCAPABLE = frozenset(("textarea", "title"))
HIDDEN = frozenset(
    "head title script style template noscript noembed noframes iframe datalist object audio "
    "video canvas meta link base param source track area "
    "desc defs metadata annotation annotation-xml".split()
)
HEAD_ONLY = frozenset("title meta link base style script noscript template".split())

#: Blocks with an empty line around them, and blocks without.
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre xmp listing figure fieldset".split()
)
BLOCKS = SPACED | frozenset(
    "html body div article section nav aside header footer main address center form li dt dd "
    "hgroup figcaption legend details summary dialog hr caption tr option optgroup search".split()
)
_CLOSES_P = BLOCKS - {"html", "body", "caption", "tr", "option", "optgroup", "legend", "summary"}

#: Which open elements a start tag closes, and the elements that end the search.
_LISTS = frozenset(("ul", "ol", "menu", "dir"))
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
IMPLIED: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(("li",)), _LISTS | {"table"}),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table"))),
    "td": (frozenset(("td", "th", "caption", "colgroup")), frozenset(("table",))),
    "th": (frozenset(("td", "th", "caption", "colgroup")), frozenset(("table",))),
    "tr": (frozenset(("tr", "td", "th", "caption", "colgroup")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
} | {
    name: (_SECTIONS | {"tr", "td", "th", "caption", "colgroup"}, frozenset(("table",)))
    for name in _SECTIONS
}
_BARRIERS = frozenset(("table", "td", "th", "caption", "html"))

_TAG = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?][^>]*+(?:>|\Z))"""
    r"""|(?P<end>/?)(?P<name>[A-Za-z][^\s/<>]*+)"""
    # Quotes count only where a value begins; elsewhere they are characters.
    r"""(?P<attrs>(?:[\s/]++|=?[^\s/>=]++"""
    r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+|=)*+)(?:>|\Z))""",
    re.DOTALL,
)
_ATTR = re.compile(r"""(=?[^\s/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"']\S*))?""")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none")
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)")

#: Columns of a table that begin further right than this are not aligned.
FARTHEST_START = 2000


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def number(self, name: str, default: int, least: int, most: int) -> int:
        text = self.attrs.get(name, "").strip()
        return min(max(int(text), least), most) if re.fullmatch(r"-?[0-9]{1,9}", text) else default

    @property
    def shown(self) -> bool:
        attrs = self.attrs
        if self.tag in HIDDEN or "hidden" in attrs:
            return False
        if self.tag == "input" or (self.tag == "dialog" and "open" not in attrs):
            return False
        return not ("style" in attrs and _NOT_SHOWN.search(attrs["style"].lower()))

    def visible(self, around: bool) -> bool:
        """Whether its own text shows; what it does not say holds as around it."""
        said = _VISIBILITY.findall(self.attrs.get("style", "").lower())
        return said[-1] == "visible" if said else around


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value))
    return found


class _Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.open = [self.root]
        # How often each element is open, so that a stray end tag costs nothing.
        self.count: dict[str, int] = {"html": 1}

    def _pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def _close(self, tags: frozenset[str], barriers: frozenset[str]) -> None:
        """Close up to the outermost of ``tags`` inside the nearest barrier."""
        if not any(self.count.get(t) for t in tags):
            return
        depth = None
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                depth = i
            elif tag in barriers:
                break
        if depth is not None:
            while len(self.open) > depth:
                self._pop()

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head" and text.strip():
            self._pop()
        self.open[-1].children.append(text)

    def start(self, tag: str, attrs: dict[str, str]) -> Node | None:
        if tag in ("html", "body") and self.count.get(tag):
            return None
        if self.count.get("head") and tag not in HEAD_ONLY:
            self._close(frozenset(("head",)), frozenset())
        if tag in _CLOSES_P:
            self._close(frozenset(("p",)), _BARRIERS)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1
        return node

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "p" and not self.count.get("p"):
            self.start("p", {})
            self._pop()
        elif tag not in ("html", "body") and self.count.get(tag):
            stop = frozenset() if tag == "table" else _BARRIERS - {tag}
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag == tag:
                    while len(self.open) > i:
                        self._pop()
                    return
                # Cells keep what is outside them open.
                if self.open[i].tag in stop and tag not in _SECTIONS and tag != "tr":
                    return


def build(html: str) -> Node:
    """The tree of a page."""
    builder = _Builder()
    at = 0
    while at < len(html):
        match = _TAG.search(html, at)
        text = html[at : match.start() if match else len(html)]
        if text:
            builder.text(unescape(text))
        if not match:
            break
        at = match.end()
        if not match["name"]:
            continue
        tag = match["name"].lower()
        if match["end"]:
            builder.end(tag)
            continue
        node = builder.start(tag, _attributes(match["attrs"]))
        if tag in RAW and node is not None:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            inner = html[at : close.start() if close else len(html)]
            node.children.append(unescape(inner) if tag in ESCAPABLE else inner)
            builder._pop()
            at = close.end() if close else len(html)
    return builder.root


def width(text: str) -> int:
    """Columns the text takes on a terminal."""
    if text.isascii():
        return len(text)
    return sum(0 if combining(c) else 2 if east_asian_width(c) in "WF" else 1 for c in text)


class _Page:
    """Lines of text under way: the current line, margins, and prefixes of lists."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False  # a space is due before the next word
        self.margin = 0  # empty lines due before the next line
        self.prefixes: list[tuple[str, str]] = []  # of the first and of later lines

    def _prefix(self) -> str:
        text = "".join(first for first, _ in self.prefixes)
        self.prefixes = [(later, later) for _, later in self.prefixes]
        return text

    def _put(self, text: str) -> None:
        if not self.line:
            if self.lines:
                self.lines += [""] * self.margin
            self.margin = 0
            self.line.append(self._prefix())
        self.line.append(text)

    def flow(self, text: str) -> None:
        """Text whose spaces collapse."""
        for i, word in enumerate(_SPACES.split(text)):
            self.gap |= i > 0
            if word:
                self._put(" " + word if self.gap and self.line else word)
                self.gap = False

    def verbatim(self, text: str) -> None:
        """Text whose spaces and line ends stay."""
        for i, part in enumerate(re.split(r"\r\n|\r|\n", text)):
            if i:
                self.new_line(keep=True)
            if part:
                self._put(" " + part if self.gap and self.line else part)
                self.gap = False

    def new_line(self, keep: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
        elif keep and self.lines:
            self.margin += 1
        self.line, self.gap = [], False

    def block(self, margin: int) -> None:
        self.new_line()
        self.margin = max(self.margin, margin)

    def text(self) -> str:
        self.new_line()
        return "\n".join(self.lines)


@dataclass
class _Table:
    rows: list[list[tuple[str, int, int]]] = field(default_factory=list)
    captions: list[str] = field(default_factory=list)

    def _placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """Each row's cells as first column, column behind, and lines of text."""
        placed = []
        spans: list[tuple[int, int, int]] = []  # first column, column behind, last row
        for r, row in enumerate(self.rows):
            spans = sorted(s for s in spans if s[2] >= r)
            column, i, cells, below = 0, 0, [], []
            for text, across, down in row:
                while i < len(spans) and spans[i][0] <= column:
                    column = max(column, spans[i][1])
                    i += 1
                cells.append((column, column + across, text.split("\n")))
                if down > 1:
                    below.append((column, column + across, r + down - 1))
                column += across
            spans += below
            placed.append(cells)
        return placed

    def lines(self) -> list[str]:
        """Cells in columns; a cell over several of them pads the last.

        Only columns in which a cell begins count, however many a cell spans.
        """
        placed = self._placed()
        begun = sorted({first for cells in placed for first, _, _ in cells})
        widths = [0] * len(begun)
        wide = []
        for cells in placed:
            for first, behind, parts in cells:
                span = range(bisect_left(begun, first), bisect_left(begun, behind))
                size = max(map(width, parts))
                if len(span) == 1:
                    widths[span[0]] = max(widths[span[0]], size)
                else:
                    wide.append((span, size))
        for span, size in wide:
            held = sum(widths[c] for c in span) + 2 * (len(span) - 1)
            widths[span[-1]] += max(size - held, 0)
        start, edge = {}, 0
        for column, taken in zip(begun, widths):
            start[column] = edge
            edge += taken + 2
        found = list(self.captions)
        for cells in placed:
            for i in range(max((len(parts) for _, _, parts in cells), default=0)):
                line, at = [], 0
                for first, _, parts in cells:
                    if i < len(parts) and parts[i]:
                        to = start[first]
                        if to > FARTHEST_START:
                            to = at + 2
                        line.append(" " * (to - at) + parts[i])
                        at = to + width(parts[i])
                found.append("".join(line))
        return found


class _Renderer:
    def __init__(self) -> None:
        self.pages = [_Page()]
        self.tables: list[_Table] = []
        self.counters: list[int | None] = []  # of open lists; None for bullets
        self.verbatim = 0

    def enter(self, node: Node) -> None:
        page, tag = self.pages[-1], node.tag
        if tag == "br":
            page.new_line(keep=True)
        elif tag == "table":
            page.block(1)
            self.tables.append(_Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and self.tables:
            self.pages.append(_Page())
        elif tag in BLOCKS:
            page.block(self._margin(tag))
            if tag in _LISTS:
                self.counters.append(node.number("start", 1, -(10**9), 10**9) if tag == "ol" else None)
            elif tag == "li":
                mark = "- "
                if self.counters and self.counters[-1] is not None:
                    number = node.number("value", self.counters[-1], -(10**9), 10**9)
                    mark, self.counters[-1] = f"{number}. ", number + 1
                page.prefixes.append((mark, " " * len(mark)))
            elif tag in ("dd", "blockquote"):
                page.prefixes.append(("  ", "  "))
        if tag in ("pre", "xmp", "listing", "textarea"):
            self.verbatim += 1

    def _margin(self, tag: str) -> int:
        # A list within a list has no empty line around it.
        inner = tag in _LISTS and bool(self.counters)
        return 1 if tag in SPACED and not inner else 0

    def leave(self, node: Node) -> None:
        tag = node.tag
        if tag in ("pre", "xmp", "listing", "textarea"):
            self.verbatim -= 1
        if tag == "table":
            lines = self.tables.pop().lines()
            page = self.pages[-1]
            for line in lines:
                if line:
                    page._put(line)
                page.new_line(keep=True)
            page.block(1)
        elif tag in ("td", "th", "caption") and self.tables:
            text = self.pages.pop().text()
            if tag == "caption":
                self.tables[-1].captions += text.split("\n")
            else:
                if not self.tables[-1].rows:
                    self.tables[-1].rows.append([])
                across = node.number("colspan", 1, 1, 1000)
                self.tables[-1].rows[-1].append((text, across, node.number("rowspan", 1, 1, 1000)))
        elif tag in BLOCKS and not (tag == "tr" and self.tables):
            page = self.pages[-1]
            if tag in _LISTS and self.counters:
                self.counters.pop()
            page.block(self._margin(tag))
            if tag in ("li", "dd", "blockquote") and page.prefixes:
                page.prefixes.pop()

    def text(self, text: str) -> None:
        # Between the cells of a table there is nothing to show text in.
        page = self.pages[-1]
        if self.verbatim:
            page.verbatim(text)
        else:
            page.flow(text)


def render(root: Node) -> str:
    """The visible text of a tree."""
    renderer = _Renderer()
    visible = [True]  # of the elements entered
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        node, left = stack.pop()
        if isinstance(node, str):
            if visible[-1]:
                renderer.text(node)
        elif left:
            visible.pop()
            renderer.leave(node)
        elif node.shown:
            visible.append(node.visible(visible[-1]))
            renderer.enter(node)
            stack.append((node, True))
            children = node.children
            if node.tag == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            stack += [(child, False) for child in reversed(children)]
    return renderer.pages[0].text()


def visible_text(html: str | None) -> str:
    return render(build(html)) if html else ""


def page_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id, text``.

    Null and empty pages have an empty text.  Repeated rows are rendered each,
    other columns are ignored, and an empty table gives an empty result.
    """
    schema = T.StructType(
        [
            T.StructField("page_id", pages.schema["page_id"].dataType),
            T.StructField("text", T.StringType()),
        ]
    )

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [visible_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(texts, pa.string())], names=schema.names
            )

    return map_texts(pages.select("page_id", "html"), rendered, schema)
