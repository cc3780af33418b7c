"""HTML extraction: a tree builder with implied tags, visibility rules, and a layout-aware rendering.

Parsing: tags are read with quoted attributes in mind; script, style and similar elements hold raw text; an
opening tag first closes what it implies (a paragraph before a block, a list item before the next, cells and rows
before the next, ...); a closing tag without a partner in scope is ignored.  Nesting deeper than ``DEEPEST`` is
flattened: the text stays, the extra elements don't, but their end tags close them and what they hide stays hidden.

Visibility: nothing is emitted of comments, head content, scripts, styles, templates, embedded media, controls that show
no text, what a drawing only defines or describes, notes of formulas for machines, elements with ``hidden``, ``display:none`` or ``visibility:hidden`` (which an inner ``visibility:visible``
lifts), closed dialogs, and closed details other than their summary; rules of
style sheets aren't followed, and objects count as loaded.  Text areas show their content as it is; of drawings (svg) text
elements are emitted, a line each; of formulas (math) all token text.

Layout: white space collapses as in a browser but for ``pre``; paragraphs, headings, lists, tables and the like are
set off by a blank line, other blocks by a line break; list items get ``- `` or their number and are indented by depth;
the cells of a table's column start at the same place (in characters, wide ones counted twice), with ``colspan`` and ``rowspan`` filling columns and
rows.  Columns are padded up to a width that keeps a page's text within a fixed multiple of it; longer cells are written whole.

Each page is rendered by itself and whole, in one pass over the rows, without a shuffle.  A null page gives a null text, an
empty one an empty text; repeated rows each get a row; input columns named like a result are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEEPEST = 200
#: Columns of a table that spans can fill.
MOST_COLUMNS = 1000
#: Greatest widths to which a table's columns are padded, and how much padding there may be for each character of a table.
LIMITS, PADDING = (80, 40, 20, 10, 5), 8
#: Open elements beyond that depth that are kept in mind; further ones of them count as text.
MOST_FLAT = 64
_TOKEN = r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*>?|<(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>%s)>|(?P<text>[^<]+|<)"""
#: In TOKEN a quoted value may hold ">".  Where quotes don't pair up, the rest of the page is read with LOOSE, so that
#: each character is looked at a fixed number of times.
TOKEN = re.compile(_TOKEN % r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""", re.S)
LOOSE = re.compile(_TOKEN % "[^>]*+", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style title head template noscript iframe noembed noframes object canvas video audio datalist defs desc metadata symbol marker clippath mask annotation annotation-xml".split())
#: In a drawing, only these show text.
DRAWN = frozenset("text foreignobject".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu".split())
BLOCK = SPACED | frozenset("address article aside body center dd details dialog div dt fieldset figcaption footer form header html legend li main nav optgroup option search section summary caption tr td th thead tbody tfoot".split())
CLOSES_P = SPACED | frozenset("address article aside center details dialog dir div fieldset figcaption footer form header hgroup main menu nav search section summary".split())

#: An opening tag: the elements that it ends, and those at which the search stops.
_ROWS, _CELLS = frozenset({"tr"}), frozenset({"td", "th"})
IMPLIED: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "table"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl", "table"})),
    "td": (_CELLS, frozenset({"table", "tr"})),
    "th": (_CELLS, frozenset({"table", "tr"})),
    "tr": (_ROWS | _CELLS, frozenset({"table"})),
    "thead": (_ROWS | _CELLS | {"thead", "tbody", "tfoot", "caption"}, frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "optgroup", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset({"html"})),
}
IMPLIED["tbody"] = IMPLIED["tfoot"] = IMPLIED["thead"]
SCOPE = frozenset({"table", "td", "th", "caption", "html", "button", "object"})
HEAD = frozenset("head title meta link base style script noscript template html".split())
HIDING = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


class Node:
    __slots__ = ("attrs", "children", "flat", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []
        self.flat: list[Node] | None = None  # open elements that are too deep to be put into the tree


def parse(html: str) -> Node:
    """The element tree; children are nodes and strings."""
    root = Node("html", {})
    stack, lower, at, token, last = [root], None, 0, TOKEN, html.rfind(">")
    while at < len(html):
        m = token.match(html, at)
        if m["text"] == "<" and at < last and html[at + 1 : at + 3].lstrip("/")[:1].isalpha():
            token = LOOSE
            m = token.match(html, at)
        elif m["text"] == "<" and at > last:  # no tag can follow
            stack[-1].children.append(unescape(html[at:]))
            break
        at = m.end()
        if (text := m["text"]) is not None:
            if stack[-1].tag == "head" and not text.isspace():
                stack.pop()
            if stack[-1].flat and any(hidden(x, False) != (False, False) for x in stack[-1].flat):
                continue
            stack[-1].children.append(unescape(text) if "&" in text else text)
            continue
        if (name := m["name"]) is None:
            continue
        name = name.lower()
        if m["end"]:
            if flat := stack[-1].flat:  # the innermost open element of that name is one that was flattened
                found = next((i for i in range(len(flat) - 1, -1, -1) if flat[i].tag == name), -1)
                if found >= 0:
                    del flat[found:]
                    continue
            close(stack, name)
            continue
        if name == "html":
            continue
        if stack[-1].tag == "head" and name not in HEAD:
            stack.pop()
        if name in CLOSES_P:
            end_implied(stack, frozenset({"p"}), SCOPE)
        elif name in IMPLIED:
            end_implied(stack, *IMPLIED[name])
            if name in _CELLS and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                push(stack, Node("tr", {}))
        raw = m["attrs"]
        attrs = {a.lower(): unescape(b or c or d) for a, b, c, d in reversed(ATTRIBUTE.findall(raw))} if raw and not raw.isspace() else {}
        node = Node(name, attrs)
        if name in VOID:
            stack[-1].children.append(node)
        elif name in RAW:
            if lower is None:
                lower = html.lower() if len(html.lower()) == len(html) else html
            end = lower.find(f"</{name}", at)
            end = len(html) if end < 0 else end
            node.children.append(unescape(html[at:end]) if name in ("textarea", "title") else html[at:end])
            stack[-1].children.append(node)
            at = html.find(">", end) + 1 or len(html)
        else:
            push(stack, node)
    return root


def push(stack: list[Node], node: Node) -> None:
    if len(stack) < DEEPEST:
        stack[-1].children.append(node)
        stack.append(node)
    else:
        top = stack[-1]
        top.flat = [] if top.flat is None else top.flat
        if len(top.flat) < MOST_FLAT:
            top.flat.append(node)


def end_implied(stack: list[Node], ended: frozenset[str], stop: frozenset[str]) -> None:
    """Close the outermost open element of ``ended`` that lies inside the innermost one of ``stop``."""
    cut = 0
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in ended:
            cut = i
        elif stack[i].tag in stop:
            break
    if cut:
        del stack[cut:]


def close(stack: list[Node], name: str) -> None:
    if name in ("html", "body"):
        return
    for i in range(len(stack) - 1, 0, -1):
        tag = stack[i].tag
        if tag == name:
            del stack[i:]
            return
        if tag in ("table", "td", "th") and name not in ("table", "tr", "td", "th", "thead", "tbody", "tfoot"):
            return


class Lines:
    """Collapses white space and keeps track of the breaks that are due."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.due = 0  # 1: a line break, 2: a blank line, before the next text
        self.first, self.rest = "", ""  # what the next line starts with, and the lines after it

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            self.space |= bool(s)
            return
        if self.due:
            self.flush()
        if self.line and (self.space or s[0].isspace()):
            self.line.append(" ")
        self.line.append(" ".join(words))
        self.space = s[-1].isspace()

    def flush(self) -> None:
        if self.line:
            self.out.append(self.first + "".join(self.line))
            self.first = self.rest
        if self.due == 2 and self.out and self.out[-1]:
            self.out.append("")
        self.line, self.space, self.due = [], False, 0

    def break_(self, kind: int) -> None:
        if self.line or self.out:
            self.due = max(self.due, kind)
        self.space = False

    def whole(self, lines: list[str]) -> None:
        """Lines as they are."""
        if self.due or self.line:
            self.due = max(self.due, 1)
            self.flush()
        for x in lines:
            self.out.append(self.first + x)
            self.first = self.rest
        self.due = 1

    def end(self) -> list[str]:
        self.due = min(self.due, 1)
        self.flush()
        while self.out and not self.out[-1]:
            self.out.pop()
        return self.out


def hidden(node: Node, unseen: bool) -> tuple[bool, bool]:
    """(drop the whole element, text directly in it is invisible)."""
    attrs = node.attrs
    if node.tag in UNSEEN:
        return True, True
    if node.tag == "dialog" and "open" not in attrs:
        return True, True
    if attrs:
        style = attrs.get("style", "")
        if "hidden" in attrs or HIDING.search(style):
            return True, True
        if v := VISIBILITY.search(style):
            unseen = v[1].lower() != "visible"
    return False, unseen


def walk(node: Node, to: Lines, unseen: bool, depth: int) -> None:
    number = 0
    if node.tag == "ol":
        number = int(x) - 1 if re.fullmatch(r"-?[0-9]{1,9}", x := node.attrs.get("start", "1")) else 0
    closed = node.tag == "details" and "open" not in node.attrs
    for child in node.children:
        if isinstance(child, str):
            if not unseen and not closed:
                to.text(child)
            continue
        tag = child.tag
        gone, blind = hidden(child, unseen)
        if gone or closed and tag != "summary":
            continue
        if tag == "br":
            if to.due == 0 and to.line:
                to.due = 1
            elif to.due:
                to.due = 2
        elif tag == "hr":
            to.break_(2)
        elif tag == "input":
            if child.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                to.text(f" {child.attrs.get('value', '')} ")
        elif tag == "table":
            to.break_(2)
            to.whole(table(child, blind, depth))
            to.break_(2)
        elif tag == "svg":
            drawing(child, to, blind, depth)
        elif tag == "textarea":
            to.break_(1)
            if not blind:
                to.whole(preformatted(child, blind))
            to.break_(1)
        elif tag == "pre":
            to.break_(2)
            to.whole(preformatted(child, blind))
            to.break_(2)
        elif tag == "li":
            number += 1
            if re.fullmatch(r"-?[0-9]{1,9}", x := child.attrs.get("value", "")):
                number = int(x)
            mark = f"{number}. " if node.tag == "ol" else "- "
            inner = Lines()
            walk(child, inner, blind, depth + 1)
            lines = inner.end()
            to.break_(1)
            if lines:
                to.whole([mark + lines[0], *(" " * len(mark) + x if x else x for x in lines[1:])])
        elif tag in BLOCK:
            inside_item = tag in ("ul", "ol", "menu") and depth > 0
            kind = 1 if inside_item else 2 if tag in SPACED else 1
            to.break_(kind)
            if tag in ("dd", "blockquote"):
                inner = Lines()
                walk(child, inner, blind, depth)
                to.whole(["    " + x if x else x for x in inner.end()])
            else:
                walk(child, to, blind, depth)
            to.break_(kind)
        else:
            walk(child, to, blind, depth)


def drawing(node: Node, to: Lines, unseen: bool, depth: int) -> None:
    """The text elements of a drawing, a line each; titles and shapes show none."""
    for child in node.children:
        if isinstance(child, str):
            continue
        gone, blind = hidden(child, unseen)
        if gone:
            continue
        if child.tag in DRAWN:
            to.break_(1)
            walk(child, to, blind, depth)
            to.break_(1)
        else:
            drawing(child, to, blind, depth)


def preformatted(node: Node, unseen: bool) -> list[str]:
    parts: list[str] = []

    def collect(n: Node, blind: bool) -> None:
        for c in n.children:
            if isinstance(c, str):
                if not blind:
                    parts.append(c)
            elif c.tag == "br":
                parts.append("\n")
            elif not (state := hidden(c, blind))[0]:
                collect(c, state[1])

    collect(node, unseen)
    lines = "".join(parts).replace("\r\n", "\n").expandtabs(8).split("\n")
    while lines and not lines[0].strip():
        lines.pop(0)
    while lines and not lines[-1].strip():
        lines.pop()
    return [x.rstrip() for x in lines]


def span_of(cell: Node, name: str, most: int) -> int:
    """A cell's colspan or rowspan; rowspan 0 reaches to the end of the rows."""
    x = cell.attrs.get(name, "1").strip()
    n = int(x[:9]) if x.isascii() and x.isdigit() else 1
    return most if n == 0 and name == "rowspan" else min(max(n, 1), most)


def wide(line: str) -> int:
    """Columns that a line takes: East Asian wide characters take two."""
    return len(line) if line.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in line)


def table(node: Node, unseen: bool, depth: int) -> list[str]:
    """Lines of a table: a caption, then rows whose columns are padded to a common width."""
    lines: list[str] = []
    grid: list[list[tuple[int, int, list[str]]]] = []  # of each row: column, columns it fills, lines
    taken: dict[int, int] = {}  # the last row that a cell from above fills in a column
    loose = Lines()

    def row(n: Node, blind: bool) -> None:
        cells: list[tuple[int, int, list[str]]] = []
        column, here = 0, len(grid)
        for cell in n.children:
            if isinstance(cell, str):
                if not blind:
                    loose.text(cell)
                continue
            gone, seen = hidden(cell, blind)
            if gone:
                continue
            inner = Lines()
            walk(cell, inner, seen, depth)
            while taken.get(column, -1) >= here:
                column += 1
            columns, down = min(span_of(cell, "colspan", MOST_COLUMNS), max(1, MOST_COLUMNS - column)), span_of(cell, "rowspan", 65534)
            if down > 1:
                taken.update(dict.fromkeys(range(column, column + columns), here + down - 1))
            cells.append((column, columns, inner.end()))
            column += columns
        grid.append(cells)

    def rows(n: Node, blind: bool) -> None:
        for c in n.children:
            if isinstance(c, str):
                if not blind:
                    loose.text(c)
                continue
            gone, own = hidden(c, blind)
            if gone:
                continue
            if c.tag in ("thead", "tbody", "tfoot", "colgroup"):
                taken.clear()  # cells end with their group of rows
                rows(c, own)
                taken.clear()
            elif c.tag == "caption":
                inner = Lines()
                walk(c, inner, own, depth)
                lines.extend(inner.end())
            elif c.tag == "tr":
                row(c, own)
            else:  # misplaced content comes before the table, as browsers put it
                wrap = Node("div", {})
                wrap.children.append(c)
                walk(wrap, loose, blind, depth)
                loose.break_(1)

    rows(node, unseen)
    return [*loose.end(), *lines, *aligned(grid)]


def aligned(grid: list[list[tuple[int, int, list[str]]]]) -> list[str]:
    """Lines of rows whose cells begin where their columns do.

    A column is as wide as its widest cell, up to a limit: the greatest at which padding takes PADDING times the text at most. Longer
    cells are written out whole, and push what follows them in their line to the right."""
    widths: dict[int, int] = {}
    text = 0
    for cells in grid:
        for column, columns, lines in cells:
            most = max((wide(x) for x in lines), default=0)
            text += sum(map(len, lines)) + 4
            if columns == 1:
                widths[column] = max(widths.get(column, 0), most)
    known = sorted(widths)
    for limit in (*LIMITS, -1):
        total, starts = [0], []
        for c in known:
            total.append(total[-1] + min(widths[c], limit) + 3)

        def start(column: int) -> int:
            """Where a column begins; columns that no cell has for itself take no room."""
            return total[bisect_left(known, column)] if limit >= 0 else 0

        starts = [start(cells[-1][0]) if cells else 0 for cells in grid]
        if limit < 0 or sum(s * max((len(x) for _, _, x in cells), default=0) for s, cells in zip(starts, grid, strict=True)) <= PADDING * text + 1000:
            break
    out = []
    for cells in grid:
        for i in range(max((len(x) for _, _, x in cells), default=0)):
            parts, at = [], 0
            for column, _, lines in cells:
                gap = start(column) - at
                if column and (limit >= 0 or column != cells[0][0]):
                    parts.append(" " * max(gap - 3, 0) + " | ")
                    at += max(gap - 3, 0) + 3
                body = lines[i] if i < len(lines) else ""
                parts.append(body)
                at += wide(body)
            out.append("".join(parts).rstrip())
    return out


def render(html: str) -> str:
    """All visible text of a page."""
    out = Lines()
    walk(parse(html), out, False, 0)
    return "\n".join(out.end())


def extract(pages: DataFrame, *, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """keep columns (all but the page by default) and text, the rendered page."""
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    keep = [c for c in keep if c != "text"]
    chosen = pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(html).alias("t"))
    schema = chosen.drop("t").withColumn("text", F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (x := v.as_py()) is None else render(x) for v in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*batch.schema.names[:-1], "text"])

    return chosen.mapInArrow(run, schema).withColumnsRenamed({f"k{i}": c for i, c in enumerate(keep)})
