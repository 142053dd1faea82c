"""HTML to text by layout: a tolerant tree builder and a renderer of what is visible.

The builder supplies what authors leave out: elements that end where another
starts (p, li, dt, dd, tr, td, th, option, ...), rows and bodies of tables,
and ends of whatever is open at the end.  The renderer leaves out what a
browser doesn't show (head, scripts, styles, templates, hidden elements,
closed details, descriptions in drawings, options not chosen, comments) and
lays out the rest: blocks on lines of their
own, blank lines around paragraphs and headings, bullets and numbers of
lists, preformatted text as it is, and tables with their cells in aligned
columns.

Cases: a null or empty page gives an empty text; unclosed quotes, tags and
comments end with the page; elements nested deeper than ``MAX_DEPTH`` become
part of the last one allowed, with their text but without what isn't shown
(there, whatever has a visibility of its own counts as hidden); cells are
wrapped at ``CELL_WIDTH`` characters and tables over ``TABLE_WIDTH`` are not
aligned, so that a text stays in proportion to its page; a row or column span
is at most ``MAX_SPAN``; very long pages are parsed in one pass; unknown tags are inline; repeated rows give repeated rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

MAX_DEPTH = 200
CELL_GAP = "  "
CELL_WIDTH = 80    # lines of a cell are wrapped between words at this width
TABLE_WIDTH = 240  # wider tables are not aligned
MAX_SPAN = 1000

# fixed values: names from the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = frozenset("head script style template noscript title iframe object audio video canvas datalist noembed noframes source track param meta link base area map dialog".split())
HIDDEN_IN_DRAWING = frozenset("title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter annotation annotation-xml script style".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table caption ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre table figure hr menu dir".split())
ENDS_P = BLOCK - {"body", "html", "caption", "option", "optgroup", "legend", "dd", "dt", "li"} | {"dd", "dt", "li"}
IMPLIED_END = {  # a start tag -> (open elements it ends, elements beyond which it doesn't look)
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
CELLS = frozenset(("tr", "td", "th"))
SCOPE_WALLS = frozenset("table td th caption html".split())

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible|initial)\b", re.I)
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from ``at`` on and the place after the tag's end."""
    found: dict[str, str] = {}
    n = len(page)
    while at < n:
        if page[at] == ">":
            return found, at + 1
        m = _ATTRIBUTE.match(page, at)
        if not m:
            at += 1
            continue
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), value)
        at = m.end()
    return found, n


def build_tree(page: str) -> Node:
    """The page's elements and texts, with implied elements supplied."""
    root = Node("html")
    open_, counts = [root], {}
    at, n = 0, len(page)

    def open_up(node: Node) -> None:
        open_.append(node)
        counts[node.tag] = counts.get(node.tag, 0) + 1

    def leave(i: int) -> None:
        for x in open_[i:]:
            counts[x.tag] -= 1
        del open_[i:]

    def close(names: set[str], walls: set[str]) -> None:
        while any(counts.get(x) for x in names):
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in names:
                    leave(i)
                    break
                if open_[i].tag in walls:
                    return
            else:
                return

    def push(tag: str, attrs: dict[str, str] | None = None) -> None:
        node, above = Node(tag, attrs), open_[-1]
        if len(open_) < MAX_DEPTH:
            above.children.append(node)
        elif not _shown(node) or _VISIBILITY.search(node.attrs.get("style", "")):
            pass  # what it holds stays with it and is never rendered
        else:
            if tag in BLOCK or tag in CELLS:
                above.children.append(Node("div"))
            node.children = above.children
        open_up(node)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            open_[-1].children.append(html.unescape(page[at:]))
            break
        if lt > at:
            open_[-1].children.append(html.unescape(page[at:lt]))
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if not m:
            open_[-1].children.append("<")
            at = lt + 1
            continue
        tag = m[1].lower()
        attrs, at = _attributes(page, m.end())
        if page[lt + 1] == "/":
            if tag == "p" and not counts.get("p"):
                push("p")
            for i in range(len(open_) - 1, 0, -1) if counts.get(tag) else ():
                if open_[i].tag == tag:
                    leave(i)
                    if i >= MAX_DEPTH and (tag in BLOCK or tag in CELLS):
                        open_[-1].children.append(Node("div"))
                    break
                if open_[i].tag in SCOPE_WALLS and tag not in ("table", "tr", "thead", "tbody", "tfoot", "body", "html"):
                    break
            if tag == "br":
                open_[-1].children.append(Node("br"))
            continue
        if tag in ("html", "body") and tag != "body":
            root.attrs = root.attrs or attrs
            continue
        if tag in ENDS_P:
            close({"p"}, SCOPE_WALLS | {"button", "object"})
        if tag in IMPLIED_END:
            close(*IMPLIED_END[tag])
        if tag in ("td", "th") and not counts.get("tr"):
            push("tr")
        if tag in VOID:
            open_[-1].children.append(Node(tag, attrs))
            continue
        push(tag, attrs)
        if tag in RAW:
            end = n if tag == "plaintext" else (lambda e: e.start() if e else n)(re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at))
            open_[-1].children.append(html.unescape(page[at:end]) if tag in ("textarea", "title") else page[at:end])
            at = end
    return root


def _shown(node: Node) -> bool:
    a = node.attrs
    return not (node.tag in HIDDEN and not (node.tag == "dialog" and "open" in a)) and "hidden" not in a and not _NOT_SHOWN.search(a.get("style", ""))


def _seen(node: Node, above: bool) -> bool:
    """Whether the node's own text is visible; elements inside may say otherwise of theirs."""
    told = _VISIBILITY.findall(node.attrs.get("style", ""))
    return told[-1].lower() in ("visible", "initial") if told else above


class Layout:
    """Lines of text so far; blocks ask for line ends and blank lines, inline text runs on.

    ``seen``: whether text at the present place is visible.
    """

    def __init__(self, seen: bool = True):
        self.seen = seen
        self.lines: list[str] = []
        self.line = ""
        self.blank = False   # a blank line is due before the next text
        self.space = False   # a space is due before the next inline text

    def text(self, value: str, pre: bool) -> None:
        if not self.seen:
            return
        if pre:
            first, *more = value.replace("\r\n", "\n").split("\n")
            self._put(first)
            for x in more:
                self._push()
                self.line = x
            return
        words = _SPACE.split(value)
        if words[0] == "" and len(words) > 1:
            self.space = True
            words = words[1:]
        tail = words[-1] == ""
        body = " ".join(words[:-1] if tail else words)
        if body:
            self._put((" " if self.space and self.line and not self.line.endswith(" ") else "") + body)
            self.space = tail
        elif tail:
            self.space = True

    def _put(self, value: str) -> None:
        if value and not self.line and self.blank and self.lines and self.lines[-1] != "":
            self.lines.append("")
        if value:
            self.blank = False
        self.line += value

    def _push(self) -> None:
        self.lines.append(self.line.rstrip(" "))
        self.line, self.space = "", False

    def end_line(self) -> None:
        if self.line.strip(" "):
            self._push()
        self.line, self.space = "", False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.blank = self.blank or spaced

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Lines of an inner layout, with a prefix."""
        self.end_line()
        for i, x in enumerate(lines):
            self._put((first if not i else rest if x else "") + x)
            self._push()

    def finish(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _inner(node: Node, pre: bool = False, seen: bool = True) -> list[str]:
    layout = Layout(seen)
    for child in node.children:
        _render(child, layout, pre)
    return layout.finish()


def _rows(table: Node, seen: bool) -> list[tuple[Node, bool]]:
    """The table's rows in order and whether their text is visible; parts and rows that aren't shown left out."""
    out = []
    for child in table.children:
        if isinstance(child, Node) and _shown(child):
            if child.tag == "tr":
                out.append((child, _seen(child, seen)))
            elif child.tag in ("thead", "tbody", "tfoot"):
                out += _rows(child, _seen(child, seen))
    return out


def _span(cell: Node, name: str) -> int:
    text = cell.attrs.get(name, "1")
    return min(MAX_SPAN, max(1, int(text))) if re.fullmatch("[0-9]{1,9}", text) else 1


def _wrapped(line: str) -> list[str]:
    """The line in parts of at most CELL_WIDTH characters, cut at spaces; longer words stay whole."""
    out = []
    while len(line) > CELL_WIDTH:
        cut = line.rfind(" ", 1, CELL_WIDTH + 1)
        cut = cut if cut > 0 else line.find(" ", CELL_WIDTH)
        if cut < 0:
            break
        out.append(line[:cut].rstrip(" "))
        line = line[cut + 1 :].lstrip(" ")
    return [*out, line]


def table_lines(table: Node, seen: bool = True) -> list[str]:
    """Cells in columns, each as wide as its widest cell; cells over several columns widen none.

    A cell over several rows keeps its columns free in the rows below.
    """
    grid, taken = [], []  # taken: (first column, column after, rows still held) of cells from above, in order
    for row, row_seen in _rows(table, seen):
        cells, column, held = [], 0, 0
        below = [(a, b, n - 1) for a, b, n in taken if n > 1]
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and _shown(cell):
                while held < len(taken) and taken[held][0] <= column:
                    column = max(column, taken[held][1])
                    held += 1
                span, down = _span(cell, "colspan"), _span(cell, "rowspan")
                lines = [x for line in _inner(cell, seen=_seen(cell, row_seen)) for x in _wrapped(line)]
                cells.append((column, span, lines))
                if down > 1:
                    below.append((column, column + span, down - 1))
                column += span
        taken = sorted(below)
        if cells:
            grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for column, span, lines in cells:
            if span == 1 and lines:
                widths[column] = max([widths.get(column, 0), *(min(len(x), CELL_WIDTH) for x in lines)])
    # columns without text take no place
    filled = sorted(c for c, w in widths.items() if w)
    starts = [0, *accumulate(widths[c] + len(CELL_GAP) for c in filled)]
    total = starts[-1]
    aligned = total <= TABLE_WIDTH
    out = []
    for cells in grid:
        for k in range(max(len(lines) for _, _, lines in cells)):
            line = ""
            for column, _, lines in cells:
                if k < len(lines) and lines[k]:
                    line = line.ljust(starts[bisect_left(filled, column)]) if aligned else line
                    gap = CELL_GAP if line and not line.endswith(CELL_GAP) else ""
                    line += gap + lines[k]
            out.append(line.rstrip(" "))
    return out


def _loose(table: Node, layout: Layout) -> None:
    """What a table holds outside its cells: captions first, stray content as blocks."""
    for child in table.children:
        if isinstance(child, Node):
            if child.tag in ("tr", "thead", "tbody", "tfoot"):
                stray = [x for x in child.children if not (isinstance(x, Node) and x.tag in ("td", "th", "tr"))]
                for x in stray if _shown(child) else ():
                    _render(x, layout, False)
            elif child.tag not in ("colgroup", "col"):
                _render(child, layout, False)
        else:
            _render(child, layout, False)
    layout.end_line()


def _options(select: Node) -> list[tuple[Node, str]]:
    """The options of a list that are shown, with the labels of their groups."""
    out = []
    for child in select.children:
        if isinstance(child, Node) and _shown(child):
            if child.tag == "option":
                out.append((child, ""))
            elif child.tag == "optgroup":
                out += [(x, child.attrs.get("label", "")) for x, _ in _options(child)]
    return out


def _choice(select: Node, layout: Layout) -> None:
    """A closed list shows its chosen option; an open one (multiple, size over 1) all of them, in lines."""
    options, size = _options(select), select.attrs.get("size", "")
    if "multiple" in select.attrs or (size.isdecimal() and int(size[:9]) > 1):
        group = ""
        for option, label in options:
            layout.block(False)
            if label and label != group:
                layout.text(html.unescape(label), False)
                layout.block(False)
            group = label
            _render(option, layout, False)
        layout.block(False)
    elif options:
        chosen = [x for x, _ in options if "selected" in x.attrs] or [options[0][0]]
        for child in chosen[-1].children or [chosen[-1].attrs.get("label", "")]:
            _render(child, layout, False)


def _drawing(node: Node, layout: Layout) -> None:
    """The texts of a drawing or formula, apart from descriptions and definitions."""
    for child in node.children:
        if isinstance(child, str):
            layout.text(child, False)
        elif child.tag == "foreignobject":
            _render(child, layout, False)
        elif child.tag not in HIDDEN_IN_DRAWING and _shown(child):
            above, layout.seen = layout.seen, _seen(child, layout.seen)
            layout.space = layout.space or child.tag == "text"
            _drawing(child, layout)
            layout.space = layout.space or child.tag == "text"
            layout.seen = above


def _render(node: Node | str, layout: Layout, pre: bool) -> None:
    if isinstance(node, str):
        layout.text(node, pre)
    elif _shown(node):
        above, layout.seen = layout.seen, _seen(node, layout.seen)
        _render_element(node, layout, pre)
        layout.seen = above


def _render_element(node: Node, layout: Layout, pre: bool) -> None:
    tag = node.tag
    if tag == "br":
        layout.lines.append(layout.line.rstrip(" ")) if layout.line or layout.lines else None
        layout.line, layout.space = "", False
    elif tag == "img":
        if node.attrs.get("alt"):
            layout.text(html.unescape(node.attrs["alt"]), False)
    elif tag == "input":
        if node.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text", "search") and node.attrs.get("value"):
            layout.text(html.unescape(node.attrs["value"]), False)
    elif tag == "table":
        layout.block(True)
        _loose(node, layout)
        layout.add(table_lines(node, layout.seen))
        layout.block(True)
    elif tag in ("ul", "ol", "menu", "dir"):
        layout.block(True)
        start = node.attrs.get("start", "1")
        number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
        for child in node.children:
            if isinstance(child, Node) and child.tag == "li" and _shown(child):
                mark = f"{number}. " if tag == "ol" else "* "
                number += 1
                lines = _inner(child, pre, _seen(child, layout.seen))
                layout.add(lines or [""], mark, " " * len(mark))
            else:
                _render(child, layout, pre)
        layout.block(True)
    elif tag in ("blockquote", "dd"):
        layout.block(tag == "blockquote")
        layout.add(_inner(node, pre, layout.seen), "  ", "  ")
        layout.block(tag == "blockquote")
    elif tag == "details" and "open" not in node.attrs:
        layout.block(False)
        for child in node.children:
            if isinstance(child, Node) and child.tag == "summary":
                _render(child, layout, pre)
        layout.block(False)
    elif tag == "select":
        _choice(node, layout)
    elif tag in ("svg", "math"):
        _drawing(node, layout)
    elif tag == "textarea":
        lines = [x for child in node.children for x in child.replace("\r\n", "\n").split("\n")] if layout.seen else []
        lines = lines[1:] if lines and not lines[0] else lines
        layout.add(lines) if len(lines) > 1 else layout.text("".join(lines), True)
    elif tag == "hr":
        layout.block(True)
    elif tag == "q":
        layout.text('"', True)
        for child in node.children:
            _render(child, layout, pre)
        layout.text('"', True)
    else:
        block = tag in BLOCK or tag in ("tr", "td", "th")
        if block:
            layout.block(tag in SPACED)
        for child in node.children:
            _render(child, layout, pre or tag == "pre")
        if block:
            layout.block(tag in SPACED)


def page_text(page: str | None) -> str:
    """All text that a browser would show, laid out in lines."""
    if not page:
        return ""
    return "\n".join(_inner(build_tree(page)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_lines of every page."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def render(batches):
        for batch in batches:
            texts = [page_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                names=["page_id", "text", "n_chars", "n_lines"],
            )

    return pages.select("page_id", "html").mapInArrow(render, f"page_id {id_type}, text string, n_chars long, n_lines long")
