"""Visible text of HTML pages, laid out as a reader sees it.

A page is cut into tags and text, a tree is built with the end tags that HTML lets
authors leave out, and the visible part of the tree is rendered: blocks on lines of
their own, paragraphs apart, list items with their marks, preformatted text as it
is, and the cells of a table's columns aligned.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.textbytes import row_groups

# Fixed values of HTML: elements by how they are parsed and shown.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_HIDDEN = frozenset(
    "head script style template title noscript iframe noembed noframes object audio video canvas "
    "svg math datalist".split()
)
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
_BLOCKS = _PARAGRAPHS | frozenset(
    "html body address article aside details div dd dt fieldset figcaption footer form header "
    "hgroup legend li main menu nav section summary tr caption thead tbody tfoot center search".split()
)
# An open element that ends when one of these begins, and what its search stops at.
_IMPLIED = {
    "p": (_BLOCKS - frozenset("html body li dd dt tr caption thead tbody tfoot legend summary".split()), frozenset(["button", "td", "th", "caption", "table"])),
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option", "optgroup"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th", "tr", "thead", "tbody", "tfoot"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "tr", "thead", "tbody", "tfoot"]), frozenset(["table"])),
    "tr": (frozenset(["tr", "thead", "tbody", "tfoot"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "tfoot"]), frozenset(["table"])),
    "tbody": (frozenset(["tbody", "tfoot"]), frozenset(["table"])),
    "caption": (frozenset(["thead", "tbody", "tfoot", "tr", "colgroup"]), frozenset(["table"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
}
# Inline elements whose end tag ends them alone, whatever block began inside.
_FORMATS = frozenset("a b big code em font i nobr s small strike strong tt u".split())
_SECTIONS = frozenset("thead tbody tfoot".split())
# Start tags that leave an open head open; any other, and text, ends it.
_IN_HEAD = frozenset("title meta link script style base noscript noframes template".split())
# By what begins: the open elements that it may end.
_ENDS: dict[str, tuple[str, ...]] = {}
for _open, (_begins, _) in _IMPLIED.items():
    for _tag in _begins:
        _ENDS[_tag] = (*_ENDS.get(_tag, ()), _open)

# An attribute as HTML reads it: a quote begins a value only after "=", and a name may begin with "=".
_WHITE = r"[ \t\n\r\f]"
_VALUE = rf"{_WHITE}*+={_WHITE}*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*+)|)"
_ATTRIBUTE = re.compile(rf"([^ \t\n\r\f/>][^ \t\n\r\f/>=]*+)(?:{_VALUE})?+")
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>\x00]*)"
    rf"(?P<attrs>(?:[ \t\n\r\f/]++|{re.sub(r'[(](?=[^?])', '(?:', _ATTRIBUTE.pattern)})*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
MOST_SPAN = 1000  # columns that one cell covers at most, as in HTML
_GROUP = 1 << 20  # bytes of pages looked at together


class Element:
    """``shown``: whether its own text can be seen; what it holds may say otherwise."""

    __slots__ = ("tag", "attrs", "children", "shown")

    def __init__(self, tag: str, attrs: dict[str, str], within: Element | None = None) -> None:
        self.tag, self.attrs = tag, attrs
        self.children: list[Element | str] = []
        self.shown = within is None or within.shown
        if "style" in attrs:
            for m in _VISIBILITY.finditer(attrs["style"]):
                self.shown = m[1].lower() == "visible"


class _Open:
    """The open elements, and where the last one of each tag is among them."""

    def __init__(self) -> None:
        self.stack = [Element("#root", {})]
        self._places: dict[str, list[int]] = {}

    @property
    def top(self) -> Element:
        return self.stack[-1]

    def last(self, tag: str) -> int:
        """0 if none is open."""
        places = self._places.get(tag)
        return places[-1] if places else 0

    def push(self, element: Element) -> None:
        self._places.setdefault(element.tag, []).append(len(self.stack))
        self.stack.append(element)

    def begin(self, tag: str, attrs: dict[str, str]) -> Element:
        """A new element within the last open one, not open itself."""
        element = Element(tag, attrs, self.top)
        self.top.children.append(element)
        return element

    def cut(self, place: int) -> None:
        while len(self.stack) > place:
            self._places[self.stack.pop().tag].pop()

    def end(self, tag: str) -> None:
        """An end tag; one without an open element, or beyond a table, is passed over."""
        place = self.last(tag)
        if not place or (tag not in ("table", "body", "html") and place < self.last("table")):
            return
        if tag in _FORMATS:
            inner = next((i for i in range(place + 1, len(self.stack)) if self.stack[i].tag in _BLOCKS), 0)
            if inner:
                self._end_around(place, inner)
                return
        self.cut(place)

    def _end_around(self, place: int, inner: int) -> None:
        """Ends an inline element in which a block is open: the block goes on without it."""
        ended, kept = self.stack[place], self.stack[inner:]
        block = kept[0]
        self.stack[inner - 1].children.pop()  # the block, open as it is, is the last one
        self.stack[place - 1].children.append(block)
        if not (_displayed(ended) and ended.shown) and len(kept) == 1:
            around = Element(ended.tag, ended.attrs, ended)
            around.shown, around.children = ended.shown, block.children
            block.children = [around]
        self.cut(place)
        for element in kept:
            self.push(element)


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        value = next((g for g in m.groups()[1:] if g is not None), "")
        out.setdefault(m[1].lower(), html.unescape(value))
    return out


def _imply_ends(open_: _Open, tag: str) -> None:
    """Closes the open elements whose end tag may be missing before ``tag``."""
    for open_tag in _ENDS.get(tag, ()):
        place = open_.last(open_tag)
        if place and place > max(map(open_.last, ("template", *_IMPLIED[open_tag][1]))):
            open_.cut(place)


def _imply_rows(open_: _Open, tag: str) -> None:
    """Opens the row group and the row that may be missing in a table before ``tag``."""
    if tag in ("td", "th", "tr") and open_.top.tag == "table":
        open_.push(open_.begin("tbody", {}))
    if tag in ("td", "th") and open_.top.tag in _SECTIONS:
        open_.push(open_.begin("tr", {}))


def tree(page: str) -> Element:
    """The page's elements; unknown end tags are passed over, open elements end with the page."""
    open_, at = _Open(), 0
    while at < len(page):
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            text = html.unescape(text)
            if open_.top.tag == "head" and text.strip(" \t\n\r\f"):
                open_.end("head")
            open_.top.children.append(text)
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"] and tag != "br":
            open_.end(tag)
            continue
        if open_.top.tag == "head" and tag not in _IN_HEAD:
            open_.end("head")
        if m["end"]:
            open_.begin("br", {})
            continue
        _imply_ends(open_, tag)
        _imply_rows(open_, tag)
        element = open_.begin(tag, _attributes(m["attrs"]) if m["attrs"].strip(" /\n\t") else {})
        if tag in _VOID:
            continue
        if tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            element.children.append(page[at : close.start() if close else len(page)])
            at = close.end() if close else len(page)
        else:
            open_.push(element)
    return open_.stack[0]


def _displayed(element: Element) -> bool:
    """Whether anything of an element is there to be seen."""
    if element.tag in _HIDDEN:
        return False
    attrs = element.attrs
    if element.tag == "dialog" and "open" not in attrs:
        return False
    if not attrs:
        return True
    if "hidden" in attrs or (element.tag == "input" and attrs.get("type", "").lower() == "hidden"):
        return False
    return not ("style" in attrs and _NO_DISPLAY.search(attrs["style"]))


def _width(text: str) -> int:
    """Columns that a text takes in a monospaced font."""
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text
    )


class _Lines:
    """Lines of text; spaces collapse, and gaps between blocks are the widest asked for."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self._line: list[str] = []
        self._space = False
        self._gap = 0

    def text(self, text: str) -> None:
        for i, word in enumerate(_SPACE.split(text)):
            if i:
                self._space = True
            if word:
                self._open()
                if self._space and self._line and not self._line[-1].endswith("\n"):
                    self._line.append(" ")
                self._line.append(word)
                self._space = False

    def _open(self) -> None:
        if self._gap and self.lines:
            self.lines += [""] * (self._gap - 1)
        self._gap = 0

    def end_line(self, gap: int = 1) -> None:
        if self._line:
            self.lines.append("".join(self._line))
            self._line = []
        self._space = False
        self._gap = max(self._gap, gap)

    def line_break(self) -> None:
        self._open()
        self.lines.append("".join(self._line))
        self._line, self._space = [], False

    def block(self, lines: list[str], gap: int) -> None:
        """Finished lines as a block of their own."""
        self.end_line(gap)
        if lines:
            self._open()
            self.lines += lines
            self._gap = gap

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"-?[0-9]{1,6}", text.strip()) else default


# Elements may be nested deeper than Python calls can be. So what renders an element is
# a generator that yields a generator for each element within, and is sent its result.
_Work = Generator["_Work", object, object]


def _result(work: _Work):
    waiting, value = [work], None
    while waiting:
        try:
            inner = waiting[-1].send(value)
        except StopIteration as done:
            waiting.pop()
            value = done.value
        else:
            waiting.append(inner)
            value = None
    return value


def _list_lines(element: Element) -> _Work:
    out: list[str] = []
    number = _number(element.attrs.get("start"), 1)
    loose = _Lines()
    for child in element.children:
        if isinstance(child, Element) and child.tag == "li":
            out += loose.done()
            loose = _Lines()
            if not _displayed(child):
                continue
            if element.tag == "ol":
                number = _number(child.attrs.get("value"), number)
                mark, number = f"{number}. ", number + 1
            else:
                mark = "- "
            lines = yield _child_lines(child)
            if not child.shown:
                out += lines
                continue
            lines = lines or [""]
            out.append((mark + lines[0]).rstrip())
            out += [(" " * len(mark) + line).rstrip() for line in lines[1:]]
        else:
            yield _render(child, loose, element.shown)
    return out + loose.done()


def _rows(element: Element) -> Iterator[Element]:
    for child in element.children:
        if isinstance(child, Element) and _displayed(child):
            if child.tag == "tr":
                yield child
            elif child.tag in _SECTIONS:
                yield from (
                    row
                    for row in child.children
                    if isinstance(row, Element) and row.tag == "tr" and _displayed(row)
                )


def _table_lines(element: Element) -> _Work:
    """The caption and other text first, then rows whose cells begin at common columns."""
    out: list[str] = []
    loose = _Lines()
    for child in element.children:
        if not (isinstance(child, Element) and (child.tag == "tr" or child.tag in _SECTIONS)):
            yield _render(child, loose, element.shown)
        elif child.tag != "tr" and _displayed(child):
            for other in child.children:
                if not (isinstance(other, Element) and other.tag == "tr"):
                    yield _render(other, loose, child.shown)
    out += loose.done()
    grid: list[dict[int, list[str]]] = []
    spans: list[dict[int, int]] = []
    taken: dict[int, int] = {}  # column: further rows that a cell above covers
    for row in _rows(element):
        cells: dict[int, list[str]] = {}
        across: dict[int, int] = {}
        column = 0
        covered = {c for c, n in taken.items() if n > 0}
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        loose = _Lines()
        for cell in row.children:
            if not (isinstance(cell, Element) and cell.tag in ("td", "th")):
                yield _render(cell, loose, row.shown)
                continue
            while column in covered:
                column += 1
            wide = min(max(_number(cell.attrs.get("colspan"), 1), 1), MOST_SPAN)
            if _displayed(cell):
                cells[column] = yield _child_lines(cell)
                across[column] = wide
            down = max(_number(cell.attrs.get("rowspan"), 1), 1) - 1
            if down:
                taken.update(dict.fromkeys(range(column, column + wide), down))
            column += wide
        out += loose.done()
        grid.append(cells)
        spans.append(across)
    begins = _column_begins(grid, spans)
    for cells in grid:
        for i in range(max(map(len, cells.values()), default=0)):
            line = ""
            for column in sorted(cells):
                if i < len(cells[column]) and cells[column][i]:
                    room = begins[column] - _width(line)
                    line += " " * max(room, 2 if line else room) + cells[column][i]
            out.append(line.rstrip())
    return out


def _column_begins(grid: list[dict[int, list[str]]], spans: list[dict[int, int]]) -> dict[int, int]:
    """Where the text of each column begins. Columns in which no cell begins take no room."""
    widths: dict[int, int] = {}
    wide: list[tuple[int, int, int]] = []
    for cells, across in zip(grid, spans):
        for column, lines in cells.items():
            need = max(map(_width, lines), default=0)
            widths[column] = max(widths.get(column, 0), need if across[column] == 1 else 0)
            if across[column] > 1:
                wide.append((across[column], column, need))
    used = sorted(widths)
    # A cell over several columns widens the last of them if they are too narrow for it.
    for across, column, need in sorted(wide):
        own = used[bisect_left(used, column) : bisect_left(used, column + across)]
        missing = need - sum(widths[c] + 2 for c in own) + 2
        if missing > 0 and own[-1] != used[-1]:
            widths[own[-1]] += missing
    begins, at = {}, 0
    for column in used:
        begins[column], at = at, at + widths[column] + 2
    return begins


def _plain(element: Element) -> _Work:
    """An element's text with its own spaces."""
    parts = []
    for child in element.children:
        if isinstance(child, str):
            parts.append(child if element.shown else "")
        elif child.tag == "br":
            parts.append("\n")
        elif _displayed(child):
            parts.append((yield _plain(child)))
    return "".join(parts)


def _options(element: Element) -> _Work:
    """What a list to choose from shows: all of a list box, else what is chosen."""
    options = []
    waiting = list(reversed(element.children))
    while waiting:
        child = waiting.pop()
        if isinstance(child, Element) and _displayed(child):
            if child.tag == "option":
                options.append(child)
            else:
                waiting += reversed(child.children)
    if "multiple" not in element.attrs and _number(element.attrs.get("size"), 1) < 2:
        chosen = [o for o in options if "selected" in o.attrs]
        options = chosen[-1:] or options[:1]
    texts = []
    for option in options:
        text = yield _plain(option)
        texts.append(option.attrs.get("label") or _SPACE.sub(" ", text).strip())
    return " ".join(filter(None, texts))


def _text_lines(text: str) -> list[str]:
    """Lines as they are, but for empty ones around them."""
    lines = [line.rstrip() for line in text.replace("\r\n", "\n").split("\n")]
    while lines and not lines[0]:
        lines.pop(0)
    while lines and not lines[-1]:
        lines.pop()
    return lines


def _render(node: Element | str, out: _Lines, shown: bool = True) -> _Work:
    """Adds a node to ``out``; ``shown`` says whether text right within its parent can be seen."""
    if isinstance(node, str):
        if shown:
            out.text(node)
        return
    if not _displayed(node):
        return
    tag = node.tag
    gap = 2 if tag in _PARAGRAPHS else 1
    if tag == "br":
        out.line_break()
    elif tag in ("ul", "ol", "menu"):
        out.block((yield _list_lines(node)), gap)
    elif tag == "table":
        out.block((yield _table_lines(node)), gap)
    elif tag == "pre":
        out.block(_text_lines((yield _plain(node))), gap)
    elif tag == "textarea":
        out.block(_text_lines(html.unescape("".join(node.children))) if node.shown else [], gap)
    elif tag == "blockquote":
        lines = yield _child_lines(node)
        out.block([("> " + line).rstrip() for line in lines], gap)
    elif tag == "dd":
        lines = yield _child_lines(node)
        out.block([("  " + line).rstrip() for line in lines], gap)
    elif tag == "img":
        out.text(node.attrs.get("alt", "") if node.shown else "")
    elif tag == "input":
        kind = node.attrs.get("type", "").lower()
        pressed = node.shown and kind in ("submit", "button", "reset")
        out.text(node.attrs.get("value", "") if pressed else "")
    elif tag == "select":
        text = yield _options(node)
        out.text(text if node.shown else "")
    else:
        if tag in _BLOCKS or tag == "dialog":
            out.end_line(gap)
        elif tag in ("td", "th"):  # outside of any table
            out.text(" ")
        for child in node.children:
            if not isinstance(child, str):
                yield _render(child, out)
            elif node.shown:
                out.text(child)
        if tag in _BLOCKS or tag == "dialog":
            out.end_line(gap)


def _child_lines(element: Element) -> _Work:
    lines = _Lines()
    for child in element.children:
        yield _render(child, lines, element.shown)
    return lines.done()


def visible_text(page: str) -> str:
    """The page's visible text; lines end without spaces, no blank line begins or ends it."""
    lines = _result(_child_lines(tree(page)))
    first = next((i for i, line in enumerate(lines) if line.strip()), len(lines))
    return "\n".join(line.rstrip() for line in lines[first:])


def page_title(page: str) -> str:
    """The first title element's text, spaces collapsed; empty if there is none."""
    m = re.search(r"<title(?:\s[^>]*)?>(.*?)(?:</title|\Z)", page, re.I | re.S)
    return _SPACE.sub(" ", html.unescape(m[1])).strip() if m else ""


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``title`` and ``text`` in place of ``column``.

    A null page has a null title and text, an empty one empty ones. Broken markup
    never fails: what is not a tag is text. All rows and other columns stay,
    repeated rows too; columns named title or text, in any case, are replaced.
    """
    kept = [f for f in pages.schema if f.name.lower() not in (column.lower(), "title", "text")]
    pages = pages.select(*[f.name for f in kept], F.col(column).alias("html"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_groups(batch, "html", _GROUP):
                raw = part.column("html").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(f.name) for f in kept],
                        pa.array([None if p is None else page_title(p) for p in raw], pa.string()),
                        pa.array([None if p is None else visible_text(p) for p in raw], pa.string()),
                    ],
                    names=[*[f.name for f in kept], "title", "text"],
                )

    return pages.mapInArrow(run, ", ".join([*fields, "title string, text string"]))
