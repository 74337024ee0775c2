"""Visible text of HTML pages, laid out as a browser would.

A tokenizer cuts a page into tags, comments and text; a tree builder adds the tags that
HTML implies; a renderer walks the tree, leaves out what is not displayed, and writes
lines: blocks on lines of their own with blank lines around those that have margins,
list items with markers and indents, preformatted text as it stands, table cells in
aligned columns. Every page is worked on in the task that reads it.

Rows: a null page gives an empty text, as does a page without visible text. Unclosed elements
and comments end with the page; an unfinished tag there is text. Depth is not limited: no step recurses,
tables in tables included. Other columns pass through; an input column named like the output is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Generator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Classes of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
TEXT_ONLY = frozenset("textarea title".split())
UNSEEN = frozenset(
    "head script style template noscript iframe object audio video canvas svg math datalist noembed noframes "
    "area base link meta param source track title".split()
)
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl menu table figure hr fieldset".split()
)
BLOCK = SPACED | frozenset(
    "html body div section article aside main nav header footer address figcaption form li dt dd details summary "
    "dialog legend caption center dir hgroup search option optgroup tr td th thead tbody tfoot".split()
)
ENDS_P = SPACED | frozenset(
    "div section article aside main nav header footer address figcaption form details summary dialog center dir hgroup li dt dd".split()
)
# An opening tag closes open elements of these names, up to a boundary.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th", "caption", "colgroup"), "tbody": ("tr", "td", "th", "thead", "tbody", "caption", "colgroup"),
    "tfoot": ("tr", "td", "th", "thead", "tbody", "caption", "colgroup"), "body": ("head",),
}
STOPS = {
    "li": ("ul", "ol", "menu", "table", "td", "th"), "dt": ("dl", "table"), "dd": ("dl", "table"), "option": ("select",),
    "optgroup": ("select",), "body": (),
}
ROWS = frozenset("thead tbody tfoot".split())

_TAG = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<odd>[!?][^>]*(?:>|\Z))|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)"""
    r"""(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z))""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    name: str
    attrs: dict[str, str] = field(default_factory=dict)
    below: list = field(default_factory=list)  # nodes and strings


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTR.finditer(source):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def parse(page: str) -> Node:
    """The element tree, with implied tags."""
    root = Node("html")
    open_ = _Open(root)
    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            open_[-1].below.append(unescape(page[at:]))
            break
        if m.start() > at:
            open_[-1].below.append(unescape(page[at : m.start()]))
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["end"]:
            _close(open_, name)
            continue
        if name == "html":
            continue
        if name in ENDS_P:
            _imply_end(open_, ("p",), ("table", "td", "th", "button", "caption"))
        if name in CLOSES:
            _imply_end(open_, CLOSES[name], STOPS.get(name, ("table",)))
        if name in ("td", "th") and open_[-1].name in ROWS | {"table"}:
            open_.open(Node("tr"))
        node = Node(name, _attributes(m["attrs"]) if m["attrs"] else {})
        if name in VOID:
            open_[-1].below.append(node)
        elif name in RAW or name in TEXT_ONLY:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            inner = page[at : end.start() if end else n]
            node.below.append(unescape(inner) if name in TEXT_ONLY else inner)
            open_[-1].below.append(node)
            at = end.end() if end else n
        else:
            open_.open(node)
    return root


class _Open(list):
    """Open elements, with a count per name so that most searches need not begin."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.counts: Counter[str] = Counter()

    def open(self, node: Node) -> None:
        self[-1].below.append(node)
        self.append(node)
        self.counts[node.name] += 1

    def cut(self, i: int) -> None:
        for node in self[i:]:
            self.counts[node.name] -= 1
        del self[i:]


def _imply_end(open_: _Open, names: tuple[str, ...], stops: tuple[str, ...]) -> None:
    """Close the outermost open element of ``names`` that no element of ``stops`` shields."""
    if not any(open_.counts[n] for n in names):
        return
    cut = None
    for i in range(len(open_) - 1, 0, -1):
        if open_[i].name in stops:
            break
        if open_[i].name in names:
            cut = i
        elif cut is not None and open_[i].name in BLOCK:
            break
    if cut is not None:
        open_.cut(cut)


def _close(open_: _Open, name: str) -> None:
    if name in ("html", "body"):
        return
    if name == "br":
        open_[-1].below.append(Node("br"))
        return
    for i in range(len(open_) - 1, 0, -1) if open_.counts[name] else ():
        if open_[i].name == name:
            open_.cut(i)
            return
        if open_[i].name in ("td", "th", "table") and name not in ROWS | {"table", "tr", "td", "th"}:
            break  # what was opened outside a cell is not closed inside it
    if name == "p":
        open_[-1].below.append(Node("p"))


def shown(node: Node) -> bool:
    if node.name in UNSEEN or "hidden" in node.attrs:
        return False
    if node.name == "dialog" and "open" not in node.attrs:
        return False
    if node.name == "input":
        return False
    return not _HIDING.search(node.attrs.get("style", ""))


class Writer:
    """Lines of text with pending blank lines, indents and list markers."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = ""
        self.marker = ""

    def _start(self) -> None:
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        lead = self.indent
        if self.marker:
            lead = lead[: len(lead) - len(self.marker)] + self.marker
            self.marker = ""
        if lead:
            self.line.append(lead)
        self.line.append("")

    def text(self, value: str) -> None:
        words = _BLANKS.split(value)
        if not words[0] and len(words) > 1:
            self.space = True
        body = " ".join(w for w in words if w)
        if not body:
            return
        if not self.line:
            self._start()
        elif self.space:
            self.line.append(" ")
        self.line.append(body)
        self.space = not words[-1]

    def literal(self, value: str) -> None:
        for i, part in enumerate(value.replace("\r\n", "\n").split("\n")):
            if i:
                self.newline()
            if part:
                if not self.line:
                    self._start()
                self.line.append(part)
        self.space = False

    def newline(self) -> None:
        if not self.line:
            self._start()
        self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.space = [], False

    def block(self, margin: int = 0) -> None:
        """End the line, if one has begun; ask for blank lines before the next."""
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = False
        self.gap = max(self.gap, margin)

    def finish(self) -> list[str]:
        self.block()
        return self.lines


Layout = Generator["Layout", list[str], list[str]]


def render(root: Node) -> list[str]:
    """Lines of everything visible below ``root``. A layout yields the layouts whose lines it needs;
    those that wait are kept in a list."""
    waiting, lines = [_flow(root)], None
    while waiting:
        try:
            needed = waiting[-1].send(lines)
        except StopIteration as done:
            waiting.pop()
            lines = done.value
        else:
            waiting.append(needed)
            lines = None
    return lines


def _flow(root: Node) -> Layout:
    out = Writer()
    # (node, next child, what to undo) for every open element
    stack: list[list] = [[root, 0, None]]
    numbers: list[int | None] = []
    pre = items = 0
    while stack:
        node, i, undo = stack[-1]
        if i == len(node.below):
            stack.pop()
            if undo:
                undo()
            continue
        stack[-1][1] = i + 1
        child = node.below[i]
        if isinstance(child, str):
            out.literal(child) if pre else out.text(child)
            continue
        name = child.name
        if not shown(child):
            continue
        if node.name == "details" and "open" not in node.attrs and name != "summary":
            continue
        if name == "br":
            out.newline()
            continue
        if name == "table":
            out.block(1)
            for line in (yield _table(child)):
                out.literal(line)
                out.newline()
            out.block(1)
            continue
        margin = 1 if name in SPACED else 0
        if name in ("ul", "ol", "menu", "dl") and items:
            margin = 0  # a list in a list
        before = out.indent
        if name in BLOCK:
            out.block(margin)
        if name == "pre":
            pre += 1
            if child.below and isinstance(child.below[0], str):
                child.below[0] = child.below[0].removeprefix("\n")
        elif name in ("ul", "menu"):
            numbers.append(None)
        elif name == "ol":
            start = child.attrs.get("start", "1")
            numbers.append(int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1)
        elif name == "li":
            items += 1
            mark = "- "
            if numbers and numbers[-1] is not None:
                mark = f"{numbers[-1]}. "
                numbers[-1] += 1
            out.marker += mark
            out.indent += " " * len(mark)
        elif name in ("dd", "blockquote"):
            out.indent += "  "

        def leave(name=name, margin=margin, before=before, owner=node) -> None:
            nonlocal pre, items
            if name in BLOCK:
                out.block(margin)
            if name == "pre":
                pre -= 1
            elif name in ("ul", "ol", "menu"):
                numbers.pop()
            elif name == "li":
                items -= 1
                out.marker = ""
            out.indent = before

        stack.append([child, 0, leave])
    return out.finish()


def _table(table: Node) -> Layout:
    """Caption, then misplaced content, then the rows in aligned columns."""
    caption, stray, rows = Node("div"), Node("div"), []
    queue: list[tuple[Node, Node | None]] = [(table, None)]
    while queue:
        node, _ = queue.pop()
        row = [] if node.name == "tr" else None
        inner = []
        for child in node.below:
            name = "" if isinstance(child, str) else child.name
            if name and not shown(child):
                continue
            if name in ("td", "th") and row is not None:
                row.append(child)
            elif name in ROWS or name == "tr" and row is None:
                inner.append((child, node))
            elif name == "caption":
                caption.below.append(child)
            elif name not in ("colgroup", "col"):
                stray.below.append(child)
        if row:
            rows.append(row)
        queue.extend(reversed(inner))
    grid: list[dict[int, tuple[list[str], int]]] = []
    held: dict[tuple[int, int], bool] = {}
    for r, row in enumerate(rows):
        cells, column = {}, 0
        for cell in row:
            while held.get((r, column)):
                column += 1
            wide, high = (_span(cell, k) for k in ("colspan", "rowspan"))
            cells[column] = ((yield _flow(cell)), wide)
            for below in range(1, min(high, len(rows) - r)):
                held.update({(r + below, column + k): True for k in range(wide)})
            column += wide
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, (lines, wide) in cells.items():
            if wide == 1:
                widths[column] = max([widths.get(column, 0), *map(len, lines)])
    out = (yield _flow(caption)) + (yield _flow(stray))
    for cells in grid:
        for k in range(max([len(lines) for lines, _ in cells.values()], default=0)):
            parts, at = [], 0
            for column in sorted(cells):
                lines, wide = cells[column]
                while at < column:
                    parts.append(" " * widths.get(at, 0))
                    at += 1
                room = sum(widths.get(column + j, 0) for j in range(wide)) + 2 * (wide - 1)
                parts.append((lines[k] if k < len(lines) else "").ljust(room))
                at += wide
            out.append("  ".join(parts).rstrip(" "))
    return out


def _span(cell: Node, name: str) -> int:
    value = cell.attrs.get(name, "1").strip()
    return min(max(int(value), 1), 1000) if re.fullmatch(r"\d{1,6}", value) else 1


def page_text(page: str | None) -> str:
    return "\n".join(render(parse(page))) if page else ""


def extract(df: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """Adds the visible text of every page."""

    @F.arrow_udf("string")
    def texts(pages: pa.Array) -> pa.Array:
        return pa.array([page_text(p) for p in pages.to_pylist()], pa.string())

    return df.withColumn(text_col, texts(F.col(html_col).cast("string")))
