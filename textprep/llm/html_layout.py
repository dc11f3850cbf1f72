"""Layout-aware text of web pages.

A tolerant tree builder (implied end tags, void and raw-text elements, end tags
without a start) is followed by a rendering walk that emits all visible text:

- blocks begin on a new line, paragraphs, headings, tables and outermost lists
  keep a blank line around them, ``br`` breaks a line, ``pre`` keeps its spaces;
- list items get ``- `` or their number, their other lines are indented;
- table cells are aligned in columns, with column and row spans;
- formulas (``math``) are in line, parts of fractions, scripts and rows apart by a
  space; of an ``svg`` the text elements and ``foreignObject``; of a ``select`` the
  chosen option (the last marked ``selected``, else the first that is enabled),
  of one that shows a list (``multiple``, ``size``) all; of an ``object`` its fallback;
- what a browser does not show is left out: head, scripts, styles, templates,
  comments, ``hidden`` elements, ``display:none`` and ``visibility:hidden``
  (until a descendant is made visible again); closed ``dialog``, of closed ``details`` all
  but the summary; ``rp``; ``datalist``; the fallback in
  ``audio``, ``video``, ``canvas``, ``iframe``, ``noscript``, ``noembed`` and
  ``noframes``, for browsers without them; annotations and phantoms of formulas;
  of an ``svg`` definitions, titles and descriptions.  Text that an ``svg``
  defines and draws by ``use`` is left out too.

Both passes are iterative, so nesting depth is not bounded by the interpreter.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship_package
from . import shared

# fixed values of the HTML language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist audio video "
                   "canvas rp area base link meta param source track".split())
SVG_UNSEEN = frozenset("defs symbol clippath mask pattern marker lineargradient radialgradient filter desc metadata".split())
MATH_UNSEEN = frozenset("annotation annotation-xml mphantom".split())
MATH_PARTS = frozenset("mfrac msub msup msubsup munder mover munderover mroot mmultiscripts mtable mtr mlabeledtr".split())
# these end an svg or math that is left open, but within elements that hold HTML
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li "
                       "listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
FOREIGN = frozenset("svg math".split())
HOLDS_HTML = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
BLOCKS = frozenset("address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
                   "option p pre section summary table tbody td tfoot th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table dl figure hr".split())
LISTS = frozenset("ul ol menu dir".split())
CLOSES_P = (BLOCKS - frozenset("td th tr tbody thead tfoot caption body html option optgroup legend".split()))
# an opening tag (left) ends open elements (middle), unless one of the right comes first
IMPLIED = {
    "li": ("li", "ul ol menu dir"),
    "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "td": ("td th", "table tr"), "th": ("td th", "table tr"),
    "tr": ("tr td th caption colgroup", "table tbody thead tfoot"),
    "tbody": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "thead": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "option": ("option", "select datalist optgroup"), "optgroup": ("option optgroup", "select"),
    "select": ("select", ""), "input": ("select", ""), "textarea": ("select", ""),
    "body": ("head", "html"),
}
IMPLIED_SETS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in IMPLIED.items()}
# a stray end tag reaches no further; those of a table's own parts only as far as the table
SCOPE = frozenset("td th table caption template html".split())
TABLE_PARTS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
TABLE_SCOPE = frozenset("table template html".split())

# Comments (two short forms are empty), other markup declarations, stray end tags, and tags: a name, then
# attributes.  A quote opens a value only right behind "=", and only if it is closed; elsewhere it is part of
# a name or value.  What "<" begins but no ">" ends before the next "<" outside quotes is text.
VALUE = r"""(?:"[^"]*"|'[^']*'|(?!["'])[^\s<>]*+)"""
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?=[!?])[^>]*>?|</(?=[^a-zA-Z])[^>]*>"
    rf"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[\s/]++|(?:=[^\s/<>=]*+|[^\s/<>=]++)(?:\s*+=\s*+{VALUE})?)*+)>", re.S)
ATTRIBUTE = re.compile(r"""(=[^\s/<>=]*|[^\s/<>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|(?!["'])([^\s>]+)))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)


DEEPEST = 64  # lists, quotations and cells nested deeper are rendered in line with the 64th: same text, no more indent


class Node:
    __slots__ = ("tag", "attrs", "children", "within")

    def __init__(self, tag: str, attrs: dict[str, str], within: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.within = within  # "svg", "text" (of an svg), "math" or "" for HTML

    def inside(self) -> str:
        """``within`` of its children."""
        if self.tag in FOREIGN:
            return self.tag
        if self.within == "svg" and self.tag in ("text", "foreignobject"):
            return "text" if self.tag == "text" else ""
        return self.within


def attributes(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def build(source: str) -> Node:
    """The element tree of a page."""
    root = Node("html", {})
    stack, at = [root], 0
    opened: dict[str, int] = {}  # open elements by tag

    def text(s: str) -> None:
        if stack[-1].tag == "pre" and not stack[-1].children:
            s = s.removeprefix("\r").removeprefix("\n")
        if s:
            stack[-1].children.append(html.unescape(s) if "&" in s else s)

    def close(tags: frozenset[str], until: frozenset[str]) -> None:
        """Ends every open element of ``tags`` that is nearer than one of ``until``."""
        if not any(opened.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in until:
                return
            if stack[i].tag in tags:
                for n in stack[i:]:
                    opened[n.tag] -= 1
                del stack[i:]
                if len(tags) == 1:
                    return

    pos, size = 0, len(source)
    while pos < size:
        m = TOKEN.search(source, pos)
        if not m:
            break
        text(source[at: m.start()])
        at = pos = m.end()
        tag = m[2].lower() if m[2] else None
        if tag is None:
            continue
        if m[1]:
            if tag == "p" and not opened.get("p"):
                stack[-1].children.append(Node("p", {}))
            elif tag not in VOID:
                close(frozenset((tag,)), (TABLE_SCOPE if tag in TABLE_PARTS else SCOPE) - {tag})
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            continue
        if tag in CLOSES_P:
            close(frozenset(("p",)), SCOPE)
        if tag in IMPLIED_SETS:
            close(*IMPLIED_SETS[tag])
        if tag == "html":
            root.attrs = attributes(m[3]) | root.attrs
            continue
        if tag in BREAKS_OUT and stack[-1].inside():
            close(FOREIGN, HOLDS_HTML)
        node = Node(tag, attributes(m[3]), stack[-1].inside())
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, pos)
            inner = source[pos: end.start()]
            if inner and tag == "textarea":
                node.children.append(html.unescape(inner))
            at = pos = end.end()
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCKS and tag != "hr":
            stack.append(node)
            opened[tag] = opened.get(tag, 0) + 1
    text(source[at:])
    return root


class Cell(NamedTuple):
    lines: list[str]
    columns: int
    rows: int


class Flow:
    """Lines of one formatting context: the page, a list item, a quotation or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space, self.gap = False, 0

    def words(self, s: str) -> None:
        ws = s.split()
        if not ws:
            self.space = True
            return
        if self.line and (self.space or s[0].isspace()):
            self.line.append(" ")
        self.start()
        self.line.append(" ".join(ws))
        self.space = s[-1].isspace()

    def kept(self, s: str) -> None:
        for i, part in enumerate(s.replace("\r\n", "\n").split("\n")):
            if i:
                self.brk()
            if part:
                self.start()
                self.line.append(part.replace("\t", "        "))

    def start(self) -> None:
        """Blank lines owed before the first content of a block."""
        if self.gap and not self.line:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0

    def brk(self) -> None:
        self.start()
        self.lines.append("".join(self.line).rstrip())
        self.line, self.space = [], False

    def block(self, gap: int) -> None:
        if self.line:
            self.brk()
        self.space = False
        self.gap = max(self.gap, gap)

    def put(self, lines: list[str]) -> None:
        if lines:
            self.block(0)
            self.start()
            self.lines += lines

    def done(self) -> list[str]:
        self.block(0)
        out = self.lines
        while out and not out[-1]:
            out.pop()
        first = next((i for i, x in enumerate(out) if x), len(out))
        return out[first:]


def span(attrs: dict[str, str], name: str, most: int) -> int:
    value = attrs.get(name, "1").strip()
    return min(max(int(value), 1), most) if value.isdecimal() and value.isascii() and len(value) < 9 else 1


def table_lines(rows: list[list[Cell]]) -> list[str]:
    """Aligned lines of a table's cells."""
    grid: list[dict[int, Cell]] = []
    taken: dict[int, int] = {}  # column -> rows it is still spanned for
    for cells in rows:
        line, col = {}, 0
        below = {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in cells:
            while col in taken:
                col += 1
            line[col] = cell
            if cell.rows > 1:
                below.update({c: cell.rows - 1 for c in range(col, col + cell.columns)})
            col += cell.columns
        taken = below
        grid.append(line)
    width: dict[int, int] = {}
    for line in grid:
        for c, cell in line.items():
            if cell.columns == 1:
                width[c] = max(width.get(c, 0), *map(len, cell.lines), 0) if cell.lines else width.get(c, 0)
    used = sorted(width)
    start, x = {}, 0
    for c in used:
        start[c] = x
        x += width[c] + 2 if width[c] else 0
    out = []
    for line in grid:
        for k in range(max((len(c.lines) for c in line.values()), default=0)):
            text = ""
            for c in sorted(line):
                if k < len(line[c].lines) and line[c].lines[k]:
                    want = start.get(c, len(text) + 2 if text else 0)
                    text = text.ljust(want) if len(text) < want or not text else text + "  "
                    text += line[c].lines[k]
            out.append(text.rstrip())
    return out


def shown_options(select: Node) -> list[Node] | None:
    """The option that a drop-down shows; None for a list, which shows all."""
    size = select.attrs.get("size", "").strip()
    if "multiple" in select.attrs or size.isdecimal() and size.isascii() and size.lstrip("0") not in ("", "1"):
        return None
    options: list[Node] = []
    enabled: list[Node] = []
    walk = [(select, False)]
    while walk:
        n, barred = walk.pop()
        barred = barred or n.tag in ("option", "optgroup") and "disabled" in n.attrs
        if n.tag == "option":
            options.append(n)
            if not barred:
                enabled.append(n)
        walk += [(c, barred) for c in reversed(n.children) if isinstance(c, Node)]
    return [o for o in options if "selected" in o.attrs][-1:] or enabled[:1] or options[:1]


def apart(children: list) -> list:
    """Children with a space between them."""
    return [x for c in children for x in (" ", c)][1:]


def content(node: Node) -> list:
    """Children that are rendered in an element's place."""
    tag, label = node.tag, node.attrs.get("label")
    if node.within == "svg" or tag == "svg":
        if tag == "text":
            return [" ", *node.children, " "]
        return node.children if tag == "foreignobject" else [c for c in node.children if isinstance(c, Node)]
    if tag == "math":
        return [" ", *node.children, " "] if node.attrs.get("display", "").lower() == "block" else node.children
    if node.within == "math" and tag in MATH_PARTS:
        return apart(node.children)
    if tag == "select":
        shown = shown_options(node)
        return node.children if shown is None else [" ", *(c for o in shown for c in content(o)), " "]
    if tag == "details" and "open" not in node.attrs:  # closed: its summary alone
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    if tag == "option" and label:
        return [label]
    if tag == "optgroup" and label:
        return [label, *node.children]
    return node.children


class Open(NamedTuple):
    """What an element being rendered has to finish."""
    node: Node
    flow: Flow       # context around the element
    seen: bool
    pre: bool
    lists: int


def render(root: Node) -> str:
    """Visible text of a tree."""
    page = Flow()
    rows: list[list[list[Cell]]] = []    # per open table
    numbers: list[list] = []             # per open list: [ordered, next number]
    # walk: nodes and texts to enter, and Open records to leave
    walk: list = [(root, page, True, False, 0, 0)]
    while walk:
        item = walk.pop()
        if isinstance(item, Open):
            leave(item, rows, numbers)
            continue
        node, flow, seen, pre, lists, depth = item
        if isinstance(node, tuple):  # an inner context that ends: (kind, Flow, Node)
            kind, inner, owner = node
            lines = inner.done()
            if kind == "li":
                mark = marker(numbers)
                flow.put([mark + lines[0], *(" " * len(mark) + x if x else "" for x in lines[1:])] if lines else [])
            elif kind == "quote":
                flow.put(["  " + x if x else "" for x in lines])
            elif kind == "cell" and rows:
                if not rows[-1]:
                    rows[-1].append([])
                rows[-1][-1].append(Cell(lines, span(owner.attrs, "colspan", 1000), span(owner.attrs, "rowspan", 65534)))
            continue
        if isinstance(node, str):
            if seen and pre:
                flow.kept(node)
            elif seen:
                flow.words(node)
            continue
        tag, attrs = node.tag, node.attrs
        if tag in UNSEEN or tag == "dialog" and "open" not in attrs or "hidden" in attrs and attrs["hidden"].lower() != "until-found":
            continue
        if node.within:
            if tag in (MATH_UNSEEN if node.within == "math" else SVG_UNSEEN):
                continue
            if node.within != "math":  # styles as attributes
                if attrs.get("display", "").strip().lower() == "none":
                    continue
                if (v := attrs.get("visibility", "").strip().lower()) in ("hidden", "collapse", "visible"):
                    seen = v == "visible"
        style = attrs.get("style", "")
        if style:
            if NOT_SHOWN.search(style):
                continue
            if v := VISIBILITY.search(style):
                seen = v[1].lower() == "visible"
        if tag == "br":
            flow.brk() if seen else None
            continue
        if tag == "input":
            if seen and attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search") and attrs.get("value"):
                flow.words(f" {attrs['value']} ")
            continue
        if tag == "hr":
            flow.block(1)
            continue
        if tag in VOID:
            continue
        pre = pre or tag in ("pre", "textarea", "xmp")
        inner, kind = flow, None
        if tag in LISTS:
            flow.block(0 if lists else 1)
            first = attrs.get("start", "1").strip()
            numbers.append([tag == "ol", int(first) if re.fullmatch(r"-?\d{1,9}", first, re.A) else 1])
            lists += 1
        elif tag == "table":
            flow.block(1)
            rows.append([])
        elif tag == "tr" and rows:
            rows[-1].append([])
        elif tag in BLOCKS:
            flow.block(1 if tag in SPACED else 0)
        if tag == "li":
            kind = "li"
        elif tag in ("blockquote", "dd"):
            kind = "quote"
        elif tag in ("td", "th") and rows:
            kind = "cell"
        walk.append(Open(node, flow, seen, pre, lists))
        if kind and depth >= DEEPEST:
            if kind == "li":
                flow.kept(marker(numbers))
            kind = None
        if kind:
            inner = Flow()
            walk.append(((kind, inner, node), flow, seen, pre, lists, depth))
            depth += 1
        walk += [(c, inner, seen, pre, 0 if kind == "cell" else lists, depth) for c in reversed(content(node))]
    return "\n".join(page.done())


def marker(numbers: list) -> str:
    """Mark of the next item of the innermost list."""
    if not numbers or not numbers[-1][0]:
        return "- "
    numbers[-1][1] += 1
    return f"{numbers[-1][1] - 1}. "


def leave(o: Open, rows: list, numbers: list) -> None:
    tag = o.node.tag
    if tag in LISTS:
        numbers.pop()
        o.flow.block(0 if o.lists > 1 else 1)
    elif tag == "table":
        o.flow.put(table_lines(rows.pop()))
        o.flow.block(1)
    elif tag in BLOCKS:
        o.flow.block(1 if tag in SPACED else 0)


def page_text(source: str) -> str:
    return render(build(source.replace("\x00", "")))


def extract(df: DataFrame, html_col: str = "html", out: str = "layout_text") -> DataFrame:
    """Every row of ``df`` with ``out``: the page's visible text.

    Null and empty pages give empty text.  Whole pages are read, whatever
    their length.  An existing column ``out`` is replaced; other columns pass
    through, but for ``html_col``.
    """
    shared.require(df, html_col)
    ship_package(df.sparkSession)
    df = df.drop(*[c for c in df.columns if c.lower() == out.lower() and c != html_col])
    keep = [c for c in df.columns if c != html_col]
    schema = StructType([*df.select(*keep).schema.fields, StructField(out, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(keep)
            texts = [page_text(x or "") for x in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n)), pa.array(texts, pa.string())],
                                             names=[*keep, out])

    return df.select(*keep, F.col(html_col)).mapInArrow(run, schema)
