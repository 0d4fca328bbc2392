"""Visible text of web pages, laid out.

A tree is built from the tags of a page with the implied ones put in (an open
paragraph ends where a block starts, an item where the next one does, cells get
a row). What a reader cannot see is left out: scripts, styles, templates, the
head, hidden elements, closed details, elements that a style hides (its own, or a rule
of the page for a plain tag, class or id; rules inside @-blocks do not count), and text of
invisible elements down to those that are visible again. Of drawings the text elements are
shown, of formulas all but annotations; titles, descriptions and definitions are not. The
tree is walked once: blocks stand on lines of their own, paragraphs, headings, lists and
tables with an empty line around them, list items behind their marker and indented by depth,
preformatted text as it is. A table cell is laid out like a page of its own; its lines stand
beside those of the other cells of its row, columns padded to one width. Cells wider than
``PAD_MOST`` do not widen their column, and a row that padding would make more than
``PAD_TIMES`` as long as its text is written without: one-line cells side by side, others one below
the other. No text is cut.

Each page is rendered in its own task memory, by loops that follow a stack, so
deep nesting cannot overflow; each character is read a fixed number of times, so a page takes
time in proportion to its length.

Defined cases: a null page has null text; a page without visible text has the
empty text; unclosed, stray and unknown tags are tolerated, a tag that the page ends in is
dropped with what follows it; spans count up to 1000 columns, and rows are kept free below a cell in the
first ``SPAN_COLUMNS`` columns; an empty table gives an empty one; rows are kept as
often as they come; other columns are not looked at.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from aisleflow.llm.common import work_groups

BATCH_BYTES = 4_000_000
PAD_MOST, PAD_TIMES, SPAN_COLUMNS = 80, 8, 256

# Element names by the role HTML gives them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset(
    "head script style template title noscript iframe noembed noframes object audio video canvas datalist "
    "area base link meta param source track rp dialog "
    "defs desc metadata symbol clippath mask marker annotation annotation-xml".split()
)
HEAD = frozenset("base link meta noscript script style template title head".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "caption tbody td tfoot th thead tr ul xmp".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())
CLOSES_P = BLOCKS - frozenset("body html caption tbody td tfoot th thead tr option optgroup legend".split())
LISTS = frozenset("ul ol menu".split())
SECTIONS = frozenset("thead tbody tfoot".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("html body table td th caption button object template marquee".split())
# What a start tag ends: the nearest of these, unless one of those stands before it.
ENDS = {
    "li": ({"li"}, SCOPES | LISTS),
    "dt": ({"dt", "dd"}, SCOPES | {"dl"}),
    "dd": ({"dt", "dd"}, SCOPES | {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "thead": (SECTIONS | {"caption", "colgroup"}, {"table"}),
    "tbody": (SECTIONS | {"caption", "colgroup"}, {"table"}),
    "tfoot": (SECTIONS | {"caption", "colgroup"}, {"table"}),
    "a": ({"a"}, SCOPES),
    "button": ({"button"}, SCOPES - {"button"}),
}

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)|[^<]+|<", re.S)
# One attribute of a tag, or the end of the tag.
ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)|(?=>)))?)""")
RULE = re.compile(r"([^{}]*)([{}])")
SELECTOR = re.compile(r"([a-z][\w-]*)?(?:([.#])([\w-]+))?\Z", re.I)
HIDING = re.compile(r"(?i)(?:^|;)\s*display\s*:\s*none")
VISIBILITY = re.compile(r"(?i)(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)")
DRAWN_TEXT = frozenset("text foreignobject".split())


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


def tree(page: str) -> Node:
    """The element tree of a page; children are nodes and strings."""
    root = Node("html", {})
    stack = [root]
    depths: dict[str, list[int]] = {}  # of the open elements, by name

    def cut(k: int) -> None:
        while len(stack) > k:
            depths[stack.pop().tag].pop()

    def nearest(names) -> int:
        return max((d[-1] for n in names if (d := depths.get(n))), default=0)

    def end(names, barriers) -> bool:
        k = nearest(names)
        if k <= nearest(barriers - names):
            return False
        cut(k)
        return True

    def begin(tag: str, attrs: dict) -> None:
        if stack[-1].tag == "head" and tag not in HEAD:
            cut(len(stack) - 1)
        if tag in ("html", "body"):
            stack[0].attrs.update(attrs)
            return
        if tag in CLOSES_P:
            end({"p"}, SCOPES)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            cut(len(stack) - 1)
        if tag in ENDS:
            end(*ENDS[tag])
            if tag == "tr" or tag in SECTIONS:  # a row ends with its section's content
                while stack[-1].tag in ("td", "th", "tr"):
                    cut(len(stack) - 1)
            if tag in ("td", "th") and stack[-1].tag in SECTIONS | {"table"}:
                begin("tr", {})
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag not in VOID:
            depths.setdefault(tag, []).append(len(stack))
            stack.append(node)

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.match(page, at)
        at = found.end()
        tag = found[2]
        if tag is not None:
            attrs = {}
            while m := ATTRIBUTE.match(page, at):
                at = m.end()
                if m[1]:
                    break
                attrs.setdefault(m[2].lower(), html.unescape(m[3] or m[4] or m[5] or "") if m[3] or m[4] or m[5] else "")
            else:  # the page ends inside the tag
                break
        if tag is None:
            text = found[0]
            if text[:2] not in ("<!", "<?"):
                if stack[-1].tag == "head" and not text.isspace():
                    cut(len(stack) - 1)
                stack[-1].children.append(html.unescape(text))
            continue
        tag = tag.lower()
        if found[1]:
            if tag == "br":
                begin("br", {})
            elif tag == "p" and not end({"p"}, SCOPES):
                begin("p", {})
                end({"p"}, SCOPES)
            elif tag in HEADINGS:
                end(HEADINGS, SCOPES)
            elif tag not in ("p", "html", "body"):
                inside = tag in ("tr", "td", "th", "caption") or tag in SECTIONS
                end({tag}, frozenset() if tag == "table" else {"table"} if inside else SCOPES)
            continue
        begin(tag, attrs)
        if tag in RAW:
            close = re.compile(f"(?i)</{tag}(?=[\\s/>])[^>]*>?").search(page, at)
            inside = page[at : close.start() if close else size]
            stack[-1].children.append(html.unescape(inside) if tag in ("textarea", "title") else inside)
            cut(len(stack) - 1)
            at = close.end() if close else size
    return root


class Styles:
    """What the style elements of a page hide, of rules for a plain tag, class or id."""

    def __init__(self):
        self.display: set[str] = set()
        self.visibility: dict[str, str] = {}

    def read(self, css: str) -> None:
        depth, at_depth, names = 0, None, ""
        for m in RULE.finditer(re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)):
            if m[2] == "{":
                depth += 1
                names = m[1].strip()
                if at_depth is None and names.startswith("@"):
                    at_depth = depth
                continue
            if at_depth is None and depth == 1:
                self._rule(names, m[1])
            depth = max(0, depth - 1)
            if at_depth is not None and depth < at_depth:
                at_depth = None

    def _rule(self, names: str, body: str) -> None:
        seen = VISIBILITY.search(body)
        for name in names.split(","):
            if SELECTOR.match(name.strip()) and name.strip():
                if HIDING.search(body):
                    self.display.add(name.strip())
                if seen:
                    self.visibility[name.strip()] = seen[1].lower()

    def _names(self, node: Node) -> list[str]:
        own = ["." + c for c in node.attrs.get("class", "").split()] + (["#" + node.attrs["id"]] if node.attrs.get("id") else [])
        return [node.tag, *own, *(node.tag + x for x in own)]

    def shown(self, node: Node) -> bool:
        """Whether an element is displayed, as far as its own tag, attributes and rules tell."""
        if node.tag in UNSEEN or "hidden" in node.attrs:
            return node.tag == "dialog" and "open" in node.attrs and "hidden" not in node.attrs
        if node.tag == "input" or HIDING.search(node.attrs.get("style", "")):
            return False
        return not self.display or not any(n in self.display for n in self._names(node))

    def muted(self, node: Node, before: bool) -> bool:
        """Whether the element's text is invisible; ``before`` tells that of its parent."""
        own = VISIBILITY.search(node.attrs.get("style", ""))
        if own:
            return own[1].lower() != "visible"
        for name in reversed(self._names(node)) if self.visibility else ():
            if name in self.visibility:
                return self.visibility[name] != "visible"
        return before


class Flow:
    """Text laid out in lines: white space collapsed, breaks merged, lines indented."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks, self.gap, self.indent, self.marker = 0, False, 0, ""

    def block(self, lines: int) -> None:
        self.gap = False
        if self.parts:
            self.breaks = max(self.breaks, lines)

    def line(self) -> None:
        if self.parts:
            if self.breaks:
                self.parts.append("\n" * self.breaks)
                self.breaks = 0
            self.breaks += 1
        self.gap = False

    def _open(self) -> None:
        if self.breaks or not self.parts:
            self.parts.append("\n" * self.breaks + " " * (self.indent - len(self.marker)) + self.marker)
        elif self.marker:
            self.parts.append(self.marker)
        self.breaks, self.marker = 0, ""

    def text(self, text: str) -> None:
        words = text.split()
        if not words:
            self.gap = self.gap or bool(text)
            return
        fresh = self.breaks or not self.parts
        space = "" if fresh or not (self.gap or text[0].isspace()) else " "
        self._open()
        self.parts.append(space + " ".join(words))
        self.gap = text[-1].isspace()

    def exact(self, text: str) -> None:
        """Preformatted lines, or lines laid out before."""
        for i, line in enumerate(text.split("\n")):
            if i:
                self.parts.append("\n" + " " * self.indent)
            elif line or "\n" in text:
                self._open()
            self.parts.append(line)
        self.gap = False

    def render(self) -> str:
        return "\n".join(line.rstrip(" \t") for line in "".join(self.parts).split("\n")).strip("\n")


class Grid:
    """Rows of a table while it is read: cells as (column, lines)."""

    def __init__(self):
        self.rows: list[list[tuple[int, list[str], int]]] = []
        self.caption = ""
        self.kept: dict[int, int] = {}  # columns that a cell above still takes, and for how many rows
        self.next = 0

    def row(self) -> None:
        self.kept = {c: n - 1 for c, n in self.kept.items() if n > 1}
        self.rows.append([])
        self.next = 0

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        while self.next in self.kept:
            self.next += 1
        self.rows[-1].append((self.next, lines, columns))
        if rows > 1:
            # A cell placed in this row counts it too: the next row has rows - 1 to go.
            self.kept.update({c: rows for c in range(self.next, min(self.next + columns, SPAN_COLUMNS))})
        self.next += columns

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, lines, columns in row:
                widest = max(map(len, lines), default=0)
                if columns == 1 and widest <= PAD_MOST:
                    widths[column] = max(widths.get(column, 0), widest)
        starts, at, columns = {}, 0, sorted({c for row in self.rows for c, _, _ in row} | widths.keys())
        for column in columns:
            starts[column] = at
            at += widths.get(column, 0) + 2
        out = [*self.caption.split("\n")] if self.caption else []
        for row in self.rows:
            out += self._laid([(starts[c], lines) for c, lines, _ in row if any(lines)])
        return out

    def _laid(self, cells: list[tuple[int, list[str]]]) -> list[str]:
        height = max((len(lines) for _, lines in cells), default=0)
        by_line: list[list[tuple[int, str]]] = [[] for _ in range(height)]
        for start, lines in cells:
            for k, line in enumerate(lines):
                if line:
                    by_line[k].append((start, line))
        text = sum(len(x) for line in by_line for _, x in line)
        if sum(line[-1][0] for line in by_line if line) > PAD_TIMES * (text + PAD_MOST):
            return ["  ".join(x for _, x in by_line[0])] if height == 1 else [x for _, lines in cells for x in lines]
        out = []
        for line in by_line:
            laid, length = [], 0
            for start, x in line:
                gap = max(start - length, 2 if laid else 0)
                laid += [" " * gap, x]
                length += gap + len(x)
            out.append("".join(laid))
        return out


def _number(text: str | None, default: int, most: int) -> int:
    return min(int(text), most) if text and re.fullmatch(r"-?\d{1,9}", text) else default


def _style_texts(root: Node) -> list[str]:
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        if node.tag == "style":
            found.append("".join(c for c in node.children if isinstance(c, str)))
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def render(page: str | None) -> str | None:
    """The visible text of a page."""
    if page is None:
        return None
    flows, grids, lists, pre, styles = [Flow()], [], [], 0, Styles()
    root = tree(page)
    for css in _style_texts(root):
        styles.read(css)
    todo: list[tuple] = [(root, False, False, False)]
    while todo:
        node, leaving, muted, drawing = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if not muted:
                flow.exact(node) if pre else flow.text(node)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th", "caption") and grids and len(flows) > 1:
                text = flows.pop().render()
                if tag == "caption":
                    grids[-1][0].caption = text
                else:
                    span = lambda name, most: max(1, _number(node.attrs.get(name), 1, most))  # noqa: E731, B023
                    grids[-1][0].cell(text.split("\n"), span("colspan", 1000), span("rowspan", 65_534))
            elif tag == "table":
                outside = flows.pop().render()  # text in no cell stands before the table
                if outside:
                    flows[-1].exact(outside)
                    flows[-1].block(2)
                lines = grids.pop()[0].lines()
                if lines:
                    flows[-1].exact("\n".join(lines))
                flows[-1].block(2)
            elif tag in LISTS:
                lists.pop()
                flow.indent = lists[-1][2] if lists and flow is lists[-1][3] else 0
                flow.block(1 if lists else 2)
            elif tag in BLOCKS:
                pre -= tag in ("pre", "xmp")
                flow.block(2 if tag in SPACED else 1)
                if tag == "li":
                    flow.marker = ""
                elif tag in ("dd", "blockquote"):
                    flow.indent = max(0, flow.indent - 2)
            elif tag == "q":
                flow.text('"')
            continue
        if not styles.shown(node):
            continue
        if tag == "br":
            flow.line()
            continue
        muted = styles.muted(node, muted)
        if drawing and tag in DRAWN_TEXT:
            drawing, muted = tag == "text", styles.muted(node, False)
            flow.block(1)
        elif tag == "svg":
            drawing, muted = True, True
            flow.block(1)
        todo.append((node, True, muted, drawing))
        if tag == "table":
            flow.block(2)
            flows.append(Flow())
            grids.append((Grid(), flows[-1]))
        elif tag in ("td", "th", "caption") and grids and flow is grids[-1][1]:
            if tag != "caption" and not grids[-1][0].rows:
                grids[-1][0].row()
            flows.append(Flow())
        elif tag in ("td", "th", "caption"):
            todo.pop()
        elif tag == "tr" and grids:
            grids[-1][0].row()
        elif tag in LISTS:
            flow.block(1 if lists else 2)
            start = _number(node.attrs.get("start"), 1, 10**9)
            lists.append([tag, start, flow.indent, flow])
        elif tag in BLOCKS:
            flow.block(2 if tag in SPACED else 1)
            if tag == "li":
                kind = lists[-1] if lists else ["ul", 1, flow.indent, flow]
                flow.marker = f"{_number(node.attrs.get('value'), kind[1], 10**9)}. " if kind[0] == "ol" else "- "
                kind[1] = _number(node.attrs.get("value"), kind[1], 10**9) + 1
                flow.indent = kind[2] + len(flow.marker)
            elif tag in ("dd", "blockquote"):
                flow.indent += 2
            pre += tag in ("pre", "xmp")
        elif tag == "q":
            flow.text('"')
        children = node.children
        if tag == "details" and "open" not in node.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag == "pre" and children and isinstance(children[0], str):
            children = [children[0].removeprefix("\n"), *children[1:]]
        todo += [(c, False, muted, drawing) for c in reversed(children)]
    return flows[0].render()


def _rendered(batches):
    for batch in batches:
        pages = batch.column("html")
        sizes = pc.fill_null(pc.binary_length(pages), 0).to_pylist()
        for a, b in work_groups(sizes, BATCH_BYTES):
            texts = [render(p) for p in pages.slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").slice(a, b - a), pa.array(texts, pa.string())], names=["page_id", "text"]
            )


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id and its visible text."""
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "html").mapInArrow(_rendered, f"page_id {kind}, text string")
