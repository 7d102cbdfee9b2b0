"""Visible text of HTML pages, laid out: blocks apart, lists marked and indented, table cells aligned.

A page becomes a tree (tags that HTML implies are supplied, hidden parts left out), and the tree becomes lines.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The HTML standard's element groups.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style template title noembed noframes datalist iframe object canvas".split())
RAW = set("script style textarea title noframes noembed iframe".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
BLOCK = SPACED | set("html body div section article header footer nav aside main address form fieldset li dt dd tr caption thead tbody tfoot figcaption hr details summary legend option center".split())
CLOSED_BY = {  # an open element, and the tags whose start ends it
    "p": SPACED | set("div section article header footer nav aside main address form fieldset hr details center li dt dd figcaption".split()),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "head": {"body"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"}, "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "tr": {"tr", "tbody", "tfoot", "thead"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "caption": {"tr", "tbody", "thead", "tfoot"},
}
FENCES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "thead": {"table"}, "tbody": {"table"}, "caption": {"table"}, "option": {"select"}}
LISTS, CELLS = ("table", "ul", "ol", "dl"), ("table", "td", "th")
# End tags that reach out of a table cell.
ENDS_CELLS = set("table tr tbody thead tfoot div html body".split())
# For a start tag that ends open elements: those, and the elements at which looking for them stops.
MATTERS = {tag: {t for t, by in CLOSED_BY.items() if tag in by} | {*LISTS} | FENCES.get(tag, set()) for tag in set().union(*CLOSED_BY.values())}
HEAD_ONLY = set("meta link base title style script noscript template".split())

# Parts of drawings and formulas that are not shown, and those whose content is HTML again.
HIDDEN_IN = {
    "svg": HIDDEN | set("title desc defs metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": HIDDEN | set("annotation annotation-xml mphantom".split()),
}
HIDDEN_IN["label"] = HIDDEN_IN["svg"]
HTML_IN = {"svg": set("foreignobject desc title".split()), "label": {"desc", "title"}, "math": set("mi mo mn ms mtext".split())}
# Start tags that end a drawing or a formula.
BREAKOUT = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
# Formulas whose parts stand above or beside each other, not in a row.
APART = set("mfrac mtr mtable".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+|[^>]*)>|[^<]+|<", re.S)
MAY_HIDE = re.compile("hidden|style", re.I)
# The name of an attribute, and its value in double quotes, single quotes or none.
ATTRIBUTE = re.compile(r"([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:[ \t\n\f\r]*+=[ \t\n\f\r]*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^ \t\n\f\r>]*+)))?")
# Parts of a style that hold no declarations: comments, strings, arguments.
NO_DECLARATION = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*\"|'[^']*'|\([^)]*\)", re.S)
HIDING = {("display", "none"), ("visibility", "hidden")}
# Columns are aligned up to this width; wider cells are whole, but nothing is padded to them.
WIDEST_COLUMN = 60
DEEPEST_INDENT = 40
LINE, SPACE = object(), object()


class Node:
    """An element. `space` and `inside` say what it and its content are part of: svg, label (text of an svg), math, or None for HTML."""

    __slots__ = ("tag", "children", "hidden", "parent", "space", "inside", "depth")

    def __init__(self, tag: str, parent: Node | None, hidden: bool, space: str | None = None, inside: str | None = None) -> None:
        self.tag, self.parent, self.hidden, self.children, self.space, self.inside = tag, parent, hidden, [], space, inside
        self.depth = 0 if parent is None else parent.depth + 1
        if parent is not None:
            parent.children.append(self)


def attributes_of(source: str) -> dict[str, str]:
    """Attributes by lower-case name; of two with one name the first counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _hides(source: str) -> bool:
    """Whether the attributes of a tag hide its element: one named `hidden`, or declarations of the one named `style`."""
    if not MAY_HIDE.search(source):
        return False
    found = attributes_of(source)
    if "hidden" in found:
        return True
    style: dict[str, tuple[bool, str]] = {}
    for declaration in NO_DECLARATION.sub(" ", found.get("style", "")).lower().split(";"):
        name, _, value = declaration.partition(":")
        value, mark, _ = value.partition("!")
        name = name.strip()
        if bool(mark) >= style.get(name, (False, ""))[0]:
            style[name] = bool(mark), value.strip()
    return any((name, value) in HIDING for name, (_, value) in style.items())


class Tree:
    """A page's tree while it is built: its nodes, the element parsing is in, and the open elements by tag, so that none
    is looked at but those a tag has to do with. An element is opened once and ended once, at any depth."""

    def __init__(self) -> None:
        self.nodes = [Node("html", None, False)]
        self.top = self.nodes[0]
        self.open: dict[str, list[Node]] = {}
        self.foreign: list[Node] = []

    def add(self, node: Node, enter: bool) -> None:
        self.nodes.append(node)
        if enter:
            self.top = node
            self.open.setdefault(node.tag, []).append(node)
            if node.space:
                self.foreign.append(node)

    def leave_to(self, top: Node) -> None:
        """Parsing goes on in `top`, an open element; all inside it end."""
        while self.top is not top:
            self.open[self.top.tag].pop()
            if self.top.space:
                self.foreign.pop()
            self.top = self.top.parent

    def up(self) -> None:
        if self.top.parent is not None:
            self.leave_to(self.top.parent)

    def close(self, tag: str) -> None:
        """An end tag: its nearest open element ends, a stray one changes nothing."""
        if not (own := self.open.get(tag)):
            return
        node = own[-1]
        if tag not in ENDS_CELLS and any(s[-1].depth > node.depth for t in CELLS if (s := self.open.get(t))):
            return
        self.leave_to(node.parent)

    def imply(self, tag: str) -> None:
        """End and supply what a start tag implies."""
        if self.top.tag == "head" and tag not in HEAD_ONLY:
            self.up()
        # The open elements that matter to this tag, from the inside; each is passed once, unless it is a fence.
        stacks = {t: len(s) for t in MATTERS.get(tag, ()) if (s := self.open.get(t))}
        limit = self.foreign[-1].depth if self.foreign else 0
        top = self.top
        while stacks:
            t = max(stacks, key=lambda t: self.open[t][stacks[t] - 1].depth)
            at = self.open[t][stacks[t] - 1]
            if at.depth <= limit:
                break
            stacks[t] -= 1
            if not stacks[t]:
                del stacks[t]
            if tag in CLOSED_BY.get(at.tag, ()):
                top = at.parent
            if tag in CLOSED_BY and at.tag in FENCES.get(tag, ()) or at.tag in LISTS and at is not top:
                break
        self.leave_to(top)
        if tag in ("td", "th") and top.tag in ("table", "tbody", "thead", "tfoot"):
            self.add(Node("tr", top, False), True)


def parsed(page: str) -> list[Node]:
    """The nodes of a page's tree, parents before children. Unclosed and stray tags are mended as browsers do."""
    tree, at = Tree(), 0
    while m := TOKEN.match(page, at):
        at = m.end()
        tag = m[2] and m[2].lower()
        if not tag:
            if tree.top.inside and m[0].startswith("<![CDATA["):
                end = page.find("]]>", m.start())
                text, at = (page[m.start() + 9 :], len(page)) if end < 0 else (page[m.start() + 9 : end], end + 3)
            elif m[0][0] != "<" or m[0] == "<":
                text = html.unescape(m[0])
            else:
                continue
            if tree.top.tag == "head" and text.strip():
                tree.up()
            # A drawing shows the text of its labels only.
            if tree.top.inside != "svg":
                tree.top.children.append(text)
        elif m[1]:
            tree.close(tag)
        elif tree.top.inside and tag not in BREAKOUT or tag in ("svg", "math"):
            _foreign(tree, tag, m[3])
        elif tag not in ("html", "body"):
            while tree.top.inside:
                tree.up()
            tree.imply(tag)
            node = Node(tag, tree.top, tag in HIDDEN or _hides(m[3]))
            tree.add(node, tag not in RAW and tag not in VOID)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
                node.children.append(html.unescape(page[at : end.start()]) if tag == "textarea" else page[at : end.start()])
                at = end.end()
        elif tree.top.tag == "head":
            tree.up()
    return tree.nodes


def _foreign(tree: Tree, tag: str, source: str) -> None:
    """Add an element of a drawing or a formula, and go on in it unless it is closed at once."""
    if not tree.top.inside:
        tree.imply(tag)
    top = tree.top
    space = top.inside or tag
    found = attributes_of(source)
    hidden = tag in HIDDEN_IN[space] or _hides(source) or space != "math" and any(found.get(k, "").strip().lower() == v for k, v in HIDING)
    inside = space
    if tag in HTML_IN[space] or tag == "annotation-xml" and found.get("encoding", "").lower() in ("text/html", "application/xhtml+xml"):
        inside = None
    elif space == "svg" and tag == "text":
        inside = "label"
    elif tag == "svg":
        inside = "svg"
    elif space == "label" and tag == "tspan" and ("x" in found or "y" in found):
        top.children.append(" ")
    closed = source.endswith("/") and not any(m.end() == len(source) for m in ATTRIBUTE.finditer(source))
    tree.add(Node(tag, top, hidden, space, inside), not closed)


def lines_of(pieces: list) -> list[str]:
    """Nested pieces as lines: inline text runs together, white space collapses, blank lines are single and inside."""
    out: list[str] = []
    inline: list[str] = []
    stack = [iter(pieces)]

    def end() -> None:
        text = " ".join("".join(inline).split())
        inline.clear()
        if text:
            out.append(text)

    while stack:
        for piece in stack[-1]:
            if isinstance(piece, list):
                stack.append(iter(piece))
                break
            if isinstance(piece, str):
                inline.append(piece)
                continue
            end()
            if isinstance(piece, tuple):
                out.extend(piece)
            elif isinstance(piece, Row):
                out.extend(piece.lines)
            elif piece is SPACE and out and out[-1]:
                out.append("")
        else:
            stack.pop()
    end()
    while out and not out[-1]:
        out.pop()
    return out


class Row:
    """A table row: the lines of each cell, and the lines it shows as."""

    def __init__(self, cells: list[list[str]]) -> None:
        self.cells = cells
        self.lines: tuple[str, ...] = ()


def _align(rows: list[Row]) -> None:
    """Give the rows of one table their lines, columns lined up."""
    columns = max((len(r.cells) for r in rows), default=0)
    widths = [0] * columns
    for r in rows:
        for c, cell in enumerate(r.cells):
            widths[c] = max([widths[c], *(len(x) for x in cell if len(x) <= WIDEST_COLUMN)])
    for r in rows:
        height = max(map(len, r.cells), default=0)
        r.lines = tuple(" | ".join((cell[k] if k < len(cell) else "").ljust(w) for cell, w in zip(r.cells, widths)).rstrip() for k in range(height))


def _rows_in(pieces: list) -> list[Row]:
    found, stack = [], [pieces]
    while stack:
        for piece in reversed(stack.pop()):
            if isinstance(piece, list):
                stack.append(piece)
            elif isinstance(piece, Row):
                found.append(piece)
    return found


def _item(lines: list[str], mark: str) -> tuple[str, ...]:
    if not lines:
        return ()
    if len(lines[-1]) - len(lines[-1].lstrip()) > DEEPEST_INDENT:
        return (mark + lines[0], *lines[1:])
    return (mark + lines[0], *(f"{' ' * len(mark)}{x}" if x else x for x in lines[1:]))


def text_of(page: str | None) -> str:
    """The visible text of a page; empty for NULL and for pages that show none."""
    if not page:
        return ""
    made: dict[int, list] = {}
    nodes = parsed(page)
    for node in reversed(nodes):
        if node.hidden:
            made[id(node)] = []
            continue
        inside: list = []
        number = 0
        for c in node.children:
            if isinstance(c, str):
                inside.append(tuple(c.strip("\n").expandtabs().split("\n")) if node.tag == "pre" else c)
                continue
            got = made.pop(id(c))
            if c.tag == "li" and not c.hidden:
                number += 1
                got = [LINE, _item(lines_of(got), f"{number}. " if node.tag == "ol" else "- "), LINE]
            elif c.tag in BLOCK and got:
                gap = SPACE if c.tag in SPACED and not (c.tag in ("ul", "ol") and node.tag == "li") else LINE
                got = [gap, got, gap]
            inside.append(got)
        if node.tag == "br":
            inside = [LINE]
        elif node.inside == "label" and node.space == "svg" or node.parent is not None and node.parent.tag in APART and node.space == "math":
            inside = [" ", inside, " "]
        elif node.tag == "tr":
            is_cell = [isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden for c in node.children]
            cells = [lines_of(p) for p, cell in zip(inside, is_cell) if cell]
            inside = [p for p, cell in zip(inside, is_cell) if not cell]
            if cells:
                inside.append(Row(cells))
                _align(inside[-1:])
        elif node.tag == "table":
            _align(_rows_in(inside))
        made[id(node)] = inside
    return "\n".join(lines_of(made[id(nodes[0])]))


def with_page_text(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the visible text of each page in `out`."""
    return pages.withColumn(out, page_text(F.col(f"`{source}`")))


@F.pandas_udf(StringType())
def _page_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([text_of(p) for p in batch], dtype=object)


def page_text(source: Column) -> Column:
    return _page_text(source)
