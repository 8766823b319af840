"""HTML extraction by layout-aware rendering.

A tree builder closes what HTML implies closed; a renderer then walks the
tree as a text browser would: invisible subtrees are left out, blocks are set
apart, list items get their markers, preformatted text keeps its blanks and
table cells line up in columns. All visible text is emitted.

Both take time in proportion to the page, whatever its markup: the scanner
never goes back, open elements are looked up by tag, and the renderer keeps
its own stack, so nesting has no limit. Only blanks are bounded (constants
below), as aligned output could otherwise grow with the square of the page.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import arrow_map, slices

# Element sets as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes plaintext textarea title".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist title meta link base param source track area".split())
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr"
    " legend li listing main menu nav ol optgroup option p plaintext pre search section summary table ul xmp caption".split()
)
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 hr listing ol plaintext pre table ul xmp menu dir".split())
CLOSES_P = BLOCKS - {"html", "body", "option", "optgroup", "legend", "caption"}
#: A start tag closes the nearest open element of the first set, unless one of the second stands between.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "colgroup", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "colgroup", "caption"}, {"tr", "table"}),
    "tr": ({"tr", "colgroup", "caption"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "colgroup", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "colgroup", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "colgroup", "caption"}, {"table"}),
    "colgroup": ({"tbody", "thead", "tfoot", "colgroup", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
SECTIONS = ("thead", "tbody", "tfoot")
LISTS = ("ul", "ol", "menu", "dir")
KEPT_BLANKS = ("pre", "listing", "xmp", "plaintext", "textarea")
BLOCK_DISPLAYS = ("block", "flex", "grid", "list-item")
TYPED = ("button", "submit", "reset", "text", "search", "email", "url", "tel", "number")

NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: One step inside a tag: its end, or an attribute. Nothing that it has passed is read again.
ATTRIBUTE = re.compile(r"""[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))?+)?)?""")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")

#: Columns of indentation after which nested lists and quotes indent no further.
MAX_INDENT = 40
#: Characters to which a narrower cell is padded at most; a wider one pushes the rest of its own row only.
MAX_PAD = 80
#: Columns up to which a table is aligned, and tables inside tables up to which cells stand side by side.
MAX_COLUMNS, MAX_NESTED = 200, 16


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str, default: str | None = None) -> str | None:
        return self.attributes.get(name, default) if self.attributes else default


class Tree:
    """The open elements: a stack, and the places on it of each tag, so that none is searched for."""

    def __init__(self):
        self.root = Node("#root")
        self.stack = [self.root]
        self.places: dict[str, list[int]] = {}

    def top(self) -> Node:
        return self.stack[-1]

    def add(self, node: Node, stays_open: bool = True) -> None:
        self.stack[-1].children.append(node)
        if stays_open:
            self.places.setdefault(node.tag, []).append(len(self.stack))
            self.stack.append(node)

    def pop(self) -> None:
        self.places[self.stack.pop().tag].pop()

    def nearest(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, names, barriers) -> None:
        """Close the innermost element of `names`, unless one of `barriers` is inside it."""
        place = self.nearest(names)
        if place > 0 and self.nearest(barriers) <= place:
            while len(self.stack) > place:
                self.pop()

    def text(self, piece: str) -> None:
        if piece:
            if self.top().tag == "head" and SPACES.sub("", piece):
                self.pop()  # the body may start unannounced
            self.top().children.append(unescape(piece))

    def start(self, tag: str, attributes: dict[str, str] | None) -> Node:
        if tag in CLOSES_P and self.places.get("p"):
            self.close(("p",), {"table", "td", "th", "button", "li", "dd", "dt"} - ({tag} if tag in ("li", "dd", "dt") else set()))
        if self.top().tag == "head" and tag not in HIDDEN:
            self.pop()
        if tag in CLOSED_BY:
            self.close(*CLOSED_BY[tag])
        if tag in ("td", "th") and self.top().tag in ("table", *SECTIONS):
            self.add(Node("tr"))
        node = Node(tag, attributes)
        self.add(node, stays_open=tag not in VOID and tag not in RAW)
        return node

    def end(self, tag: str) -> None:
        if tag == "br":
            self.add(Node("br"), stays_open=False)
        elif tag in ("tr", "td", "th", "caption", "colgroup", *SECTIONS):
            self.close((tag,), ("table",))
        elif tag == "li":
            self.close((tag,), ("ul", "ol", "menu", "dir", "table", "td", "th"))
        elif tag == "table":
            self.close((tag,), ())
        elif tag not in ("html", "body"):
            self.close((tag,), ("table", "td", "th", "caption"))


def _attributes(html: str, at: int) -> tuple[dict[str, str] | None, int]:
    """Attributes of a tag whose name ends at `at`, and the place after the tag; -1 if the page ends inside it."""
    if html.startswith(">", at):
        return None, at + 1
    found: dict[str, str] = {}
    while True:
        step = ATTRIBUTE.match(html, at)
        at = step.end()
        if step[1]:
            return found, at
        if step[2] is None:
            return found, -1
        value = step[3] or step[4] or step[5] or ""
        found.setdefault(step[2].lower(), unescape(value) if "&" in value else value)


def parse(html: str) -> Node:
    """The tree of a document. Never fails: what starts like a tag that never ends is text."""
    tree = Tree()
    at = 0
    while (sign := html.find("<", at)) >= 0:
        name = NAME.match(html, sign + 1)
        closing = name is None and html.startswith("/", sign + 1)
        if closing:
            name = NAME.match(html, sign + 2)
        if name:
            attributes, after = _attributes(html, name.end()) if html.find(">", name.end()) >= 0 else (None, -1)
            if after < 0:
                break
            tree.text(html[at:sign])
            at, tag = after, name[0].lower()
            if closing:
                tree.end(tag)
                continue
            node = tree.start(tag, attributes)
            if tag in RAW:
                end = RAW_END[tag].search(html, at) if tag != "plaintext" else None
                inside = html[at : end.start() if end else len(html)]
                node.children.append(unescape(inside) if tag in ("textarea", "title") else inside)
                at = (html.find(">", end.end()) + 1 or len(html)) if end else len(html)
        elif closing or html.startswith(("!", "?"), sign + 1):
            tree.text(html[at:sign])
            if html.startswith("<!--", sign):
                end = COMMENT_END.search(html, sign + 2)
                at = end.end() if end else len(html)
            else:
                mark = "]]>" if html.startswith("<![CDATA[", sign) else ">"
                end = html.find(mark, sign)
                at = end + len(mark) if end >= 0 else len(html)
        else:
            tree.text(html[at : sign + 1])
            at = sign + 1
    tree.text(html[at:])
    return tree.root


def _style(node: Node) -> dict[str, str]:
    style = node.get("style")
    return {k.lower(): v.lower() for k, v in STYLE.findall(style)} if style else {}


def _display(node: Node, style: dict[str, str]) -> str:
    """`none`, or the display that the element's style names, or nothing."""
    if node.tag in HIDDEN or node.tag == "input" and (node.get("type") or "").lower() == "hidden":
        return "none"
    if "display" in style:
        return style["display"]
    absent = node.attributes and "hidden" in node.attributes or node.tag == "dialog" and "open" not in (node.attributes or ())
    return "none" if absent else ""


def _shown(style: dict[str, str], inherited: bool) -> bool:
    """Visibility is inherited, and may be switched on again inside a hidden element."""
    value = style.get("visibility")
    return inherited if value is None or value in ("inherit", "unset") else value not in ("hidden", "collapse")


class Page:
    """Lines of text with collapsed margins; `indent` applies to new lines, `marker` once to the next. `solid` counts characters that are no layout."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.indent, self.marker, self.space, self.solid = 0, "", "", False, 0

    def write(self, text: str, keep: bool = False) -> None:
        self.solid += len(text)
        if keep:
            head, *rest = text.replace("\r\n", "\n").split("\n")
            self._put((" " if self.space and self.parts and head else "") + head)
            self.space = False
            for more in rest:
                self.flush(force=True)
                self._put(more)
            return
        text = SPACES.sub(" ", text)
        if text.startswith(" ") and self.parts:
            self.space = True
        core = text.strip(" ")
        if core:
            self._put((" " if self.space and self.parts else "") + core)
            self.space = text.endswith(" ")

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.parts:
            if self.gap and self.lines:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            self.parts.append(self.indent[: max(0, len(self.indent) - len(self.marker))] + self.marker if self.marker else self.indent)
            self.marker = ""
        self.parts.append(text)

    def flush(self, force: bool = False) -> None:
        if self.parts or force:
            self.lines.append("".join(self.parts).rstrip(" "))
        self.parts, self.space = [], False

    def margin(self, size: int) -> None:
        self.flush()
        self.gap = max(self.gap, size)

    def indented(self, by: int) -> str:
        return self.indent + " " * by if len(self.indent) < MAX_INDENT else self.indent


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*[+-]?[0-9]{1,9}\s*", text) else default


# ---- tables ---------------------------------------------------------------------


class Cell:
    """What one cell renders to, and how many columns and rows it takes."""

    def __init__(self, node: Node):
        self.page = Page()
        self.span = max(1, min(1000, _number(node.get("colspan"), 1)))
        self.down = max(1, min(65534, _number(node.get("rowspan"), 1)))
        self.column = 0

    def lines(self) -> list[str]:
        self.page.flush()
        return self.page.lines or [""]


def _place(rows: list[list[Cell]]) -> bool:
    """Give every cell its first column, around cells that reach down; False if that takes too many columns."""
    held: dict[int, int] = {}  # column -> the first row that is free again
    for number, row in enumerate(rows):
        column = 0
        for cell in row:
            while held.get(column, 0) > number:
                column += 1
            if column + cell.span > MAX_COLUMNS and column >= MAX_COLUMNS:
                return False
            cell.column = column
            if cell.down > 1:
                held.update(dict.fromkeys(range(column, min(MAX_COLUMNS, column + cell.span)), number + cell.down))
            column += cell.span
    return True


def _starts(rows: list[list[Cell]]) -> dict[int, int]:
    """Where each column begins in a line. Columns in which no cell begins take no room."""
    used = sorted({cell.column for row in rows for cell in row})
    number = {c: i for i, c in enumerate(used)}
    widths = [0] * len(used)
    wide = []
    for row in rows:
        for cell in row:
            size = min(MAX_PAD, max(map(len, cell.lines())))
            first = number[cell.column]
            last = first
            while last + 1 < len(used) and used[last + 1] < cell.column + cell.span:
                last += 1
            if first == last:
                widths[first] = max(widths[first], size)
            else:
                wide.append((last - first, first, last, size))
    for _, first, last, size in sorted(wide):  # a cell over several columns widens the last of them if need be
        widths[last] += max(0, size - sum(widths[first : last + 1]) - 2 * (last - first))
    starts, at = {}, 0
    for c, width in zip(used, widths, strict=True):
        starts[c] = at
        at += width + 2
    return starts


def _write_table(rows: list[list[Cell]], page: Page) -> None:
    """Rows of cells as lines of text, the i-th lines of a row's cells side by side."""
    starts = _starts(rows) if _place(rows) else {}
    solid = sum(cell.page.solid for row in rows for cell in row)
    if sum(starts.get(row[-1].column, 0) * max(len(c.lines()) for c in row) for row in rows if row) > 8 * solid + 10_000:
        starts = {}  # more blanks than text: cells are set apart, not aligned
    for row in rows:
        out: list[list[str]] = []
        sizes: list[int] = []
        for cell in row:
            for i, line in enumerate(cell.lines()):
                if i == len(out):
                    out.append([])
                    sizes.append(0)
                if not line:
                    continue
                pad = max(2 if sizes[i] else 0, starts.get(cell.column, 0) - sizes[i])
                out[i] += (" " * pad, line)
                sizes[i] += pad + len(line)
        for parts in out:
            line = "".join(parts)
            if line.strip():
                page.write(line, keep=True)
                page.flush()
    page.solid += solid


# ---- the walk ---------------------------------------------------------------------


class Renderer:
    """Walks the tree with a stack of its own: entries are nodes with their state, or calls to make when all above them are done."""

    def __init__(self):
        self.work: list = []

    def run(self, root: Node, page: Page) -> None:
        self._push(root.children, page, False, True, 0)
        while self.work:
            entry = self.work.pop()
            if callable(entry):
                entry()
            elif isinstance(entry[0], str):
                if entry[3]:
                    entry[1].write(entry[0], keep=entry[2])
            else:
                self._enter(*entry)

    def _push(self, children: list, page: Page, pre: bool, shown: bool, nested: int, counter: list | None = None) -> None:
        self.work.extend((child, page, pre, shown, nested, counter) for child in reversed(children))

    def _enter(self, node: Node, page: Page, pre: bool, shown: bool, nested: int, counter: list | None) -> None:
        style = _style(node) if node.attributes else {}
        display = _display(node, style)
        if display == "none":
            return
        shown, tag = _shown(style, shown), node.tag
        if tag == "br":
            if shown:
                page.flush(force=True)
        elif tag == "input":
            if shown and (node.get("type") or "text").lower() in TYPED:
                page.write(node.get("value") or "")
        elif tag == "li" and counter is not None:
            self._item(node, page, pre, shown, nested, counter)
        elif tag == "table":
            self._table(node, page, shown, nested)
        elif tag in BLOCKS and display != "inline" or tag in ("tr", "td", "th", *SECTIONS) or display in BLOCK_DISPLAYS:
            self._block(node, page, pre, shown, nested)
        else:
            if tag == "q" and shown:
                page.write('"')
                self.work.append(lambda: page.write('"'))
            self._push(node.children, page, pre or tag == "textarea", shown, nested)

    def _block(self, node: Node, page: Page, pre: bool, shown: bool, nested: int) -> None:
        tag, outer = node.tag, page.indent
        margin = 1 if tag in SPACED and not (tag in LISTS and page.indent) else 0
        page.margin(margin)

        def leave():
            page.indent = outer
            page.margin(margin)

        self.work.append(leave)
        counter = [_number(node.get("start"), 1), tag == "ol"] if tag in LISTS else None
        if tag in ("blockquote", "dd"):
            page.indent = page.indented(4)
        self._push(node.children, page, pre or tag in KEPT_BLANKS, shown, nested, counter)

    def _item(self, node: Node, page: Page, pre: bool, shown: bool, nested: int, counter: list) -> None:
        """A list item: a bullet, or a number that obeys start and value; nested text is indented under it."""
        counter[0] = _number(node.get("value"), counter[0])
        outer = page.indent
        page.flush()
        mark = f"{counter[0]}. " if counter[1] else "- "
        page.indent, page.marker = page.indented(len(mark)), mark if shown else ""
        counter[0] += 1

        def leave():
            page.flush()
            page.indent, page.marker = outer, ""

        self.work.append(leave)
        self._push(node.children, page, pre, shown, nested)

    def _table(self, node: Node, page: Page, shown: bool, nested: int) -> None:
        """Lay out the cells as a grid; what is in no cell comes before it."""
        page.margin(1)
        stray, rows = self._rows(node, shown)
        todo: list = []
        for child, visible, apart in stray:
            todo.append((child, page, False, visible, nested, None))
            todo += [page.flush] if apart else []
        grid: list[list[Cell]] = []
        for row in rows:
            grid.append([])
            for cell, visible in row:
                if nested < MAX_NESTED:
                    grid[-1].append(Cell(cell))
                    todo += [(child, grid[-1][-1].page, False, visible, nested + 1, None) for child in cell.children]
                else:
                    todo += [(child, page, False, visible, nested, None) for child in cell.children] + [lambda: page.write(" ")]
            todo += [page.flush] if nested >= MAX_NESTED else []

        def leave():
            page.flush()
            _write_table(grid, page)
            page.margin(1)

        self.work.append(leave)
        self.work.extend(reversed(todo))

    def _rows(self, table: Node, shown: bool) -> tuple[list, list]:
        """What is in no cell, as (node, shown, on a line of its own), and the cells of each row, as (node, shown)."""
        stray, rows, late = [], [], []
        waiting = [(child, shown) for child in reversed(table.children)]
        while waiting:
            child, visible = waiting.pop()
            tag = child.tag if isinstance(child, Node) else ""
            holds_rows = tag in SECTIONS or tag == "form" and any(isinstance(x, Node) and x.tag in ("tr", *SECTIONS) for x in child.children)
            if tag != "tr" and not holds_rows:
                stray.append((child, visible, True))
                continue
            style = _style(child)
            if _display(child, style) == "none":
                continue
            visible = _shown(style, visible)
            if holds_rows:
                waiting += [(x, visible) for x in reversed(child.children)]
                continue
            rows.append([])
            for cell in child.children:
                if not isinstance(cell, Node) or cell.tag not in ("td", "th"):
                    late.append((cell, visible, False))
                elif _display(cell, style := _style(cell)) != "none":
                    rows[-1].append((cell, _shown(style, visible)))
        return stray + late, rows


def render(html: str) -> str:
    """All visible text of a page, laid out in lines."""
    page = Page()
    Renderer().run(parse(html), page)
    page.flush()
    return "\n".join(page.lines).strip("\n")


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, text): the rendering of every row's page.

    A null or empty page gives an empty text. Markup is never an error, at
    any depth, and takes time in proportion to its length; a page is rendered
    whole by one task, in memory of some fifty times its size at worst. Rows
    that repeat an id are rendered each for itself, an empty table gives no
    rows, and other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))

    def run(batches):
        for part in slices(batches, "html"):
            texts = [render(x) if x else "" for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    found = arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, text string")
    return found.withColumnRenamed("id", id_col)
