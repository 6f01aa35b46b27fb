"""Visible text of web pages, laid out: a tree with implied tags, visibility, blocks, lists, tables.

Tags are read by the standard tokenizer; the tree builder closes what HTML lets authors leave
open. Rendering walks the tree without recursion limits on depth, joins inline text, separates
blocks, numbers list items and pads table cells to the width of their column.
"""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablegauge.llm.common import column, map_texts

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title iframe object audio video canvas datalist".split())
# Inside formulas and drawings: what describes or defines without being shown.
HIDDEN_IN = {
    "math": frozenset({"annotation", "annotation-xml", "mphantom"}),
    "svg": frozenset("metadata title desc defs symbol clippath mask marker pattern lineargradient radialgradient filter".split()),
}
HEAD_ONLY = frozenset("base link meta title style script template noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul caption optgroup option".split()
)
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol pre table ul fieldset menu dir".split())
CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "option", "optgroup"}
# An opening tag closes these open elements, up to the nearest element that holds them.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
# A closing tag does not reach beyond these.
WALLS = frozenset({"table", "td", "th", "caption", "body", "html"})
BLANKS = " \t\n\r\f"


class Node:
    """An element with its children; text children are strings."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag = tag
        self.attrs = attrs or {}
        self.children: list[Node | str] = []


class TreeBuilder(HTMLParser):
    """Builds the tree of a page; unknown, unclosed and misplaced tags never fail."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open: list[Node] = [self.root]

    def _close_up_to(self, tags: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` that lies inside the nearest wall."""
        found = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in walls:
                break
            if self.open[i].tag in tags:
                found = i
        if found is not None:
            del self.open[found:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            # These are always there; a repeated tag adds nothing but what it hides.
            if tag == "body":
                self._close_up_to({"head"}, set())
            return
        if self.open[-1].tag == "head" and tag not in HEAD_ONLY:
            self.open.pop()
        if tag in CLOSES_P:
            self._close_up_to({"p"}, WALLS)
        if tag in CLOSED_BY:
            self._close_up_to(*CLOSED_BY[tag])
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and self.open[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.open.pop()
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(Node("tr"))
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # HTML ignores the slash of an element that is not void; in formulas and drawings it closes.
        self.handle_starttag(tag, attrs)
        if self.open[-1].tag == tag and any(n.tag in HIDDEN_IN for n in self.open):
            self.open.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
            return
        walls = set() if tag in WALLS else WALLS
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in walls:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip(BLANKS):
            self.open.pop()
        self.open[-1].children.append(data)


_NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z]+)", re.I)
_ROWS = frozenset({"tr", "tbody", "thead", "tfoot"})


def _visibility(node: Node) -> str:
    """The visibility an inline style gives the element, empty if it has none of its own."""
    found = _VISIBILITY.findall(node.attrs.get("style", ""))
    value = found[-1].lower() if found else ""
    return {"hidden": "hidden", "collapse": "collapse", "visible": "visible", "initial": "visible"}.get(value, "")


def is_hidden(node: Node, inside: str = "") -> bool:
    """Elements that browsers don't show with all they hold: by name, attribute or inline style.

    ``inside`` is the formula or drawing around. Invisible elements are not among them, as a child can be visible again.
    """
    if node.tag in HIDDEN or node.tag in HIDDEN_IN.get(inside, ()) or "hidden" in node.attrs:
        return True
    if node.tag == "input" or (node.tag == "dialog" and "open" not in node.attrs):
        return True
    if node.tag in _ROWS and _visibility(node) == "collapse":
        return True
    return bool(_NOT_DISPLAYED.search(node.attrs.get("style", "")))


def width(text: str) -> int:
    """Columns a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Block:
    """Lines of text under construction: joins inline blanks, keeps block spacing."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False
        self.gap = False

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *others = data.replace("\r\n", "\n").split("\n")
            self._add(first)
            for line in others:
                self.line(force=True)
                self._add(line)
            return
        words = [w for w in re.split(f"[{BLANKS}]+", data) if w]
        if not words:
            self.blank = self.blank or bool(data)
            return
        if data[0] in BLANKS:
            self.blank = True
        self._add((" " if self.blank and self.parts else "") + " ".join(words))
        self.blank = data[-1] in BLANKS

    def _add(self, text: str) -> None:
        if text:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.parts.append(text)

    def line(self, force: bool = False) -> None:
        """End the line, if it has any text or an empty one is wanted."""
        if self.parts or force:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append("".join(self.parts).rstrip(" "))
        self.parts = []
        self.blank = False

    def space(self) -> None:
        """A blank line before whatever comes next."""
        self.line()
        self.gap = True

    def add_lines(self, lines: list[str]) -> None:
        self.line()
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines += lines

    def done(self) -> list[str]:
        self.line()
        return self.lines


def _span(node: Node) -> int:
    value = node.attrs.get("colspan", "1").strip()
    return min(int(value), 1000) if value.isascii() and value.isdigit() and int(value) else 1


def _rows_spanned(node: Node) -> int:
    """Rows the cell takes, at most those of its row group; 0 stands for all that follow."""
    value = node.attrs.get("rowspan", "1").strip()
    return min(int(value) or 65534, 65534) if value.isascii() and value.isdigit() else 1


class Row:
    """A table row of one row group: columns and rows spanned, and the lines, of each cell."""

    __slots__ = ("cells", "group")

    def __init__(self, group: int):
        self.group = group
        self.cells: list[tuple[int, int, list[str]]] = []


def _placed(rows: list[Row]) -> list[list[tuple[int, list[str]]]]:
    """Rows of (columns spanned, lines), with empty cells where cells of rows above reach down."""
    out: list[list[tuple[int, list[str]]]] = []
    # By column: rows the cell above still takes, and its number.
    above: dict[int, tuple[int, int]] = {}
    group, number = None, 0
    for row in rows:
        if row.group != group:
            group, above = row.group, {}
        cells: list[tuple[int, list[str]]] = []
        after = {c: (left - 1, n) for c, (left, n) in above.items() if left > 1}
        at = 0

        def pass_over(at: int) -> int:
            while at in above:
                end = at + 1
                while end in above and above[end][1] == above[at][1]:
                    end += 1
                cells.append((end - at, []))
                at = end
            return at

        for span, down, lines in row.cells:
            at = pass_over(at)
            cells.append((span, lines))
            if down > 1:
                after |= {c: (down - 1, number) for c in range(at, at + span)}
                number += 1
            at += span
        last = max(above, default=-1)
        while at <= last:
            if at not in above:
                cells.append((1, []))
                at += 1
            at = pass_over(at)
        above = after
        out.append(cells)
    return out


def _table(rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """Rows of (columns spanned, lines of the cell) as aligned lines, cells set apart by `` | ``."""
    widths: list[int] = []
    for row in rows:
        at = 0
        for span, lines in row:
            widths += [0] * (at + span - len(widths))
            if span == 1:
                widths[at] = max([widths[at], *(width(line) for line in lines)])
            at += span
    for row in rows:
        at = 0
        for span, lines in row:
            room = sum(widths[at : at + span]) + 3 * (span - 1)
            need = max([0, *(width(line) for line in lines)])
            if span > 1 and need > room:
                widths[at + span - 1] += need - room
            at += span
    out = []
    for row in rows:
        for i in range(max([0, *(len(lines) for _, lines in row)])):
            at, cells = 0, []
            for span, lines in row:
                room = sum(widths[at : at + span]) + 3 * (span - 1)
                text = lines[i] if i < len(lines) else ""
                cells.append(text + " " * (room - width(text)))
                at += span
            out.append(" | ".join(cells).rstrip(" "))
    return out


_OPEN, _CLOSE = 0, 1


def render(root: Node) -> str:
    """The visible text of a tree, without a limit on its depth."""
    # Frames of what is being laid out: the page, list items and table cells have a block each.
    blocks: list[Block] = [Block()]
    lists: list[list] = []
    tables: list[list[Row]] = []
    groups: list[int] = []
    keep = 0
    # Whether the elements around are visible, and the formula or drawing around.
    shown = [True]
    foreign: list[str] = []
    todo: list[tuple[int, Node | str]] = [(_OPEN, root)]
    while todo:
        step, node = todo.pop()
        block = blocks[-1]
        if isinstance(node, str):
            if shown[-1]:
                block.text(node, keep > 0)
            continue
        tag = node.tag
        if step == _OPEN:
            if is_hidden(node, foreign[-1] if foreign else ""):
                continue
            own = _visibility(node)
            is_shown = own == "visible" if own else shown[-1]
            if tag == "br":
                if is_shown:
                    block.line(force=True)
                continue
            if tag == "img":
                if is_shown and node.attrs.get("alt", "").strip(BLANKS):
                    block.text(node.attrs["alt"], False)
                continue
            if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists):
                block.space()
            elif tag in BLOCKS:
                block.line()
            if tag == "hr":
                continue
            if tag == "pre":
                keep += 1
            elif tag in ("ul", "menu", "dir", "ol"):
                start = node.attrs.get("start", "1").strip()
                lists.append([tag == "ol", int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
            elif tag == "li":
                blocks.append(Block())
            elif tag == "table":
                tables.append([])
                groups.append(0)
            elif tag in ("tbody", "thead", "tfoot") and tables:
                groups[-1] += 1
            elif tag == "tr" and tables:
                tables[-1].append(Row(groups[-1]))
            elif tag in ("td", "th") and tables:
                blocks.append(Block())
            elif tag in ("blockquote", "dd"):
                blocks.append(Block())
            elif tag in HIDDEN_IN:
                foreign.append(tag)
            elif tag == "text" and foreign:
                # Labels of a drawing stand apart.
                block.text(" ", False)
            shown.append(is_shown)
            todo.append((_CLOSE, node))
            todo += [(_OPEN, child) for child in reversed(node.children)]
            continue
        is_shown = shown.pop()
        if tag == "pre":
            keep -= 1
        elif tag in HIDDEN_IN:
            foreign.pop()
        elif tag == "text" and foreign:
            block.text(" ", False)
        elif tag in ("tbody", "thead", "tfoot") and tables:
            groups[-1] += 1
        elif tag in ("ul", "menu", "dir", "ol"):
            lists.pop()
        elif tag in ("blockquote", "dd"):
            lines = blocks.pop().done()
            blocks[-1].add_lines(["  " + line if line else "" for line in lines])
        elif tag == "li":
            lines = blocks.pop().done()
            mark = "* "
            if lists and lists[-1][0]:
                value = node.attrs.get("value", "").strip()
                if re.fullmatch(r"-?[0-9]{1,9}", value):
                    lists[-1][1] = int(value)
                mark = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            pad = " " * len(mark)
            mark = mark if is_shown else pad
            if lines:
                blocks[-1].add_lines([mark + lines[0], *(pad + line if line else "" for line in lines[1:])])
        elif tag in ("td", "th") and tables:
            lines = blocks.pop().done()
            if not tables[-1]:
                tables[-1].append(Row(groups[-1]))
            tables[-1][-1].cells.append((_span(node), _rows_spanned(node), lines))
        elif tag == "table":
            groups.pop()
            blocks[-1].add_lines(_table(_placed(tables.pop())))
        block = blocks[-1]
        if tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists):
            block.space()
        elif tag in BLOCKS and tag not in ("td", "th", "li"):
            block.line()
    return "\n".join(blocks[0].done())


def page_text(html: str) -> str:
    """The visible text of one page; without markup it is the text itself, blanks joined."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def extract(pages: DataFrame, id: str = "page_id", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, text)``: the visible text of every page.

    A null or empty page gives an empty text. Repeated rows are rendered alike, ids stay as
    they are, an empty table gives none. A page is held whole, as one row is; nothing of it is cut.
    """

    def measure(texts: list[bytes | None]) -> dict[str, pa.Array]:
        return {"text": pa.array([page_text((t or b"").decode("utf-8", "replace")) for t in texts], type=pa.string())}

    named = pages.select(column(id), *[column(c) for c in keep], column(html).alias("page source"))
    return map_texts(named, "page source", measure, [T.StructField("text", T.StringType())], [id, *keep])
