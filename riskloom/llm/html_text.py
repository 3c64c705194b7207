"""Visible text of web pages as they are laid out: blocks, lists and aligned table cells.

A small tree builder supplies tags that pages leave out (html, head, body, the ends of paragraphs,
list items, cells and rows); rendering drops what a reader does not see and writes the rest with
block spacing. Pages are independent of one another: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from riskloom.llm.common import table

# Element categories of the HTML standard that matter to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta noscript script style template title".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes title datalist audio video canvas rp".split()
)
#: Parts of drawings that are not drawn where they stand, and of formulas that are not displayed.
UNDRAWN = frozenset(
    "defs metadata desc symbol clippath mask pattern marker filter lineargradient radialgradient".split()
)
DRAWING = frozenset("svg g a switch".split())
ANNOTATION = frozenset("annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre "
    "search section summary table ul blockquote tr caption thead tbody tfoot td th xmp mtr".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table blockquote pre xmp figure hr".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary "
    "table ul li dd dt".split()
)
#: start tag → open elements it ends, and the elements that shield those further out.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
}
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
TABLE_CONTENT = frozenset(
    "thead tbody tfoot tr td th caption colgroup col script style template".split()
)
SCOPE = frozenset({"table", "td", "th", "caption", "html", "template"})

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_TAG_END = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_SPACES = re.compile(r"[ \t\n\r\f]+")
#: Tables nested deeper are laid out as plain blocks.
_TABLE_DEPTH = 8


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes = tag, attributes or {}
        self.children: list[Node | str] = []


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(double or single or bare))
    return out


class TreeBuilder:
    def __init__(self):
        self.root, self.head, self.body = Node("html"), Node("head"), Node("body")
        self.root.children = [self.head, self.body]
        self.open = [self.root, self.head]
        #: How often a tag is open, so that most searches of a deep stack need not begin.
        self.times: Counter = Counter()

    def _enter_body(self) -> None:
        if self.open[1] is self.head:
            self.open = [self.root, self.body]
            self.times.clear()

    def _cut(self, k: int) -> None:
        self.times.subtract(node.tag for node in self.open[k:])
        del self.open[k:]

    def _end(self, tags: set[str], shields: set[str]) -> None:
        if not any(self.times[tag] for tag in tags):
            return
        for k in range(len(self.open) - 1, 1, -1):
            tag = self.open[k].tag
            if tag in tags:
                self._cut(k)
                return
            if tag in shields:
                return

    def text(self, data: str) -> None:
        if not data:
            return
        if self.open[1] is self.head and len(self.open) == 2:
            if not data.strip(" \t\n\r\f"):
                return
            self._enter_body()
        self._insert(unescape(data), data.strip(" \t\n\r\f") == "")

    def _insert(self, child: Node | str, may_stay: bool) -> None:
        """Append to the open element; what cannot stand between cells goes before the table."""
        if may_stay or self.open[-1].tag not in TABLE_PARTS:
            self.open[-1].children.append(child)
            return
        k = max(k for k, node in enumerate(self.open) if node.tag == "table")
        siblings = self.open[k - 1].children
        at = next((j for j, node in enumerate(siblings) if node is self.open[k]), len(siblings))
        siblings.insert(at, child)

    def start(self, tag: str, source: str) -> Node | None:
        if tag in ("html", "head", "body"):
            if tag == "body":
                self._enter_body()
                self.body.attributes.update(_attributes(source))
            return None
        if self.open[1] is self.head and tag not in HEAD_ONLY:
            self._enter_body()
        if tag == "table" and self.open[-1].tag in TABLE_PARTS:
            self.end("table")
        if tag in ENDS_P:
            self._end({"p"}, {"table", "td", "th", "caption", "button"})
        if tag in IMPLIED_END:
            ended, shields = IMPLIED_END[tag]
            self._end(ended, shields)
            if tag in ("tr", "thead", "tbody", "tfoot"):
                self._end({"tr"}, {"table", "thead", "tbody", "tfoot"})
        if tag in TABLE_CONTENT and tag not in HEAD_ONLY and not self.times["table"]:
            return None  # a part of a table outside any table leaves its content in place
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.start("tr", "")
        node = Node(tag, _attributes(source) if source else None)
        self._insert(node, tag in TABLE_CONTENT)
        closed = source.endswith("/") and (self.times["svg"] or self.times["math"])
        if tag not in VOID and not closed:
            self.open.append(node)
            self.times[tag] += 1
        return node

    def end(self, tag: str) -> None:
        if tag == "head":
            self._enter_body()
            return
        if tag == "br":
            self.start("br", "")
            return
        if not self.times[tag]:
            return
        shields = set() if tag in SCOPE else SCOPE
        for k in range(len(self.open) - 1, 1, -1):
            if self.open[k].tag == tag:
                self._cut(k)
                return
            if self.open[k].tag in shields:
                return


def parse(page: str) -> Node:
    builder, at, size = TreeBuilder(), 0, len(page)
    while at < size:
        angle = page.find("<", at)
        if angle < 0 or angle + 1 >= size:
            builder.text(page[at:])
            break
        follows = page[angle + 1]
        closing = follows == "/"
        name = _NAME.match(page, angle + 1 + closing)
        if not name and follows not in "!?/":
            builder.text(page[at : angle + 1])
            at = angle + 1
            continue
        builder.text(page[at:angle])
        if not name:
            mark, skip = ("-->", 3) if page.startswith("<!--", angle) else (">", 1)
            stop = page.find(mark, angle + 2)
            at = size if stop < 0 else stop + skip
            continue
        tag = name[0].lower()
        done = _TAG_END.match(page, name.end())
        stop = done.end() if done else page.find(">", name.end()) + 1
        if not stop:
            break  # the page ends inside a tag
        at = stop
        if closing:
            builder.end(tag)
            continue
        source = page[name.end() : stop - 1]
        node = builder.start(tag, source)
        if tag in RAW and node is not None:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            inside = page[at : close.start() if close else size]
            if tag in ("textarea", "title"):
                builder.text(inside)
            elif tag == "xmp":
                node.children.append(inside)  # its text has no character references
            at = close.start() if close else size
    return builder.root


# --- layout -----------------------------------------------------------------------------------


def _style(node: Node) -> str:
    return node.attributes.get("style", "").replace(" ", "").lower()


def hidden(node: Node, parent: Node | None = None) -> bool:
    """Whether nothing inside a node is displayed."""
    tag, attributes = node.tag, node.attributes
    if tag in UNSEEN or "hidden" in attributes or "display:none" in _style(node):
        return True
    if tag == "dialog" and "open" not in attributes:
        return True
    if parent is not None and parent.tag == "details" and "open" not in parent.attributes:
        return tag != "summary"
    if tag in UNDRAWN:
        return parent is not None and parent.tag in DRAWING
    if tag in ANNOTATION:
        return parent is not None and parent.tag == "semantics"
    return False


def _options(select: Node) -> list[Node]:
    """The options of a select element, those in groups included, in order."""
    out, stack = [], list(reversed(select.children))
    while stack:
        node = stack.pop()
        if isinstance(node, Node) and not hidden(node):
            if node.tag == "option":
                out.append(node)
            else:
                stack += reversed(node.children)
    return out


def _is_list_box(select: Node) -> bool:
    return "multiple" in select.attributes or _number(select.attributes.get("size"), 1) > 1


class Flow:
    """Lines of text under way: white space is collapsed, margins between blocks meet."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space, self.blank = False, 0
        self.indent: list[str] = []
        self.bullet = ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            for k, line in enumerate(data.replace("\r\n", "\n").split("\n")):
                if k:
                    self.line_break()
                if line:
                    self.parts.append(line)
            return
        for k, word in enumerate(_SPACES.split(data)):
            self.space |= k > 0
            if word:
                if self.space and self.parts and not self.parts[-1].endswith(" "):
                    self.parts.append(" ")
                self.parts.append(word)
                self.space = False

    def _write(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * self.blank
        self.blank = 0
        lead = "".join(self.indent)
        if self.bullet:
            lead = lead[: len(lead) - len(self.bullet)] + self.bullet
            self.bullet = ""
        self.lines.append((lead + line).rstrip())

    def line_break(self) -> None:
        self._write("".join(self.parts).replace("\xa0", " "))
        self.parts, self.space = [], False

    def block(self, blank: int = 0) -> None:
        if self.parts:
            self.line_break()
        self.space = False
        self.blank = max(self.blank, blank)

    def rows(self, rows: list[str]) -> None:
        for row in rows:
            self._write(row)


def _number(value: str | None, default: int) -> int:
    try:
        return int(value or default)
    except ValueError:
        return default


def _cells(node: Node) -> tuple[list[Node], list[list[Node]]]:
    """Captions, and the visible cells of each visible row of a table (not of tables inside)."""
    captions, rows, stack = [], [], list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str) or hidden(child):
            continue
        if child.tag == "caption":
            captions.append(child)
        elif child.tag in ("thead", "tbody", "tfoot"):
            stack += reversed(child.children)
        elif child.tag == "tr":
            rows.append(
                [c for c in child.children if isinstance(c, Node) and c.tag in ("td", "th") and not hidden(c)]
            )
    return captions, rows


def table_lines(node: Node, depth: int) -> list[str]:
    """A table as lines, its columns as wide as their widest cell, two blanks apart."""
    captions, rows = _cells(node)
    placed, taken, width = [], {}, {}
    for y, row in enumerate(rows):
        x = 0
        for cell in row:
            while taken.get((y, x)):
                x += 1
            across = max(1, min(1000, _number(cell.attributes.get("colspan"), 1)))
            down = max(1, min(1000, _number(cell.attributes.get("rowspan"), 1)))
            for dy in range(min(down, len(rows) - y)):
                for dx in range(across):
                    taken[y + dy, x + dx] = True
            lines = layout(cell.children, depth + 1, cell.tag == "pre")
            right = cell.attributes.get("align", "").lower() == "right" or "text-align:right" in _style(cell)
            placed.append((y, x, across, lines, right))
            if across == 1:
                width[x] = max([width.get(x, 0), *map(len, lines)])
            x += across
    for _, x, across, lines, _ in placed:
        if across > 1:
            have = sum(width.setdefault(k, 0) for k in range(x, x + across)) + 2 * (across - 1)
            width[x + across - 1] += max(0, max(map(len, lines), default=0) - have)
    start, at = {}, 0
    for x in range(max(width, default=-1) + 1):
        start[x] = at
        at += width.get(x, 0) + 2
    out = [line for c in captions for line in layout(c.children, depth + 1)]
    by_row: list[list] = [[] for _ in rows]
    for cell in placed:
        by_row[cell[0]].append(cell)
    for cells in by_row:
        for k in range(max((len(c[3]) for c in cells), default=0)):
            line = ""
            for _, x, across, lines, right in cells:
                if k < len(lines):
                    room = sum(width.get(j, 0) + 2 for j in range(x, x + across)) - 2
                    value = lines[k].rjust(room) if right else lines[k]
                    line = line.ljust(start[x]) + value
            out.append(line.rstrip())
    return out


def layout(children: list, depth: int = 0, pre: bool = False) -> list[str]:
    """Lines of the visible text below ``children``; no recursion but for tables."""
    flow = Flow()
    parent = Node("body")
    parent.children = children
    # (node, parent, preformatted, seen) to open, or a function to close an element
    stack: list = [(c, parent, pre, True) for c in reversed(children)]
    counters: list[list] = []
    #: Options of list boxes, each a line of its own.
    lines: set[int] = set()
    while stack:
        item = stack.pop()
        if callable(item):
            item()
            continue
        node, above, pre, seen = item
        if isinstance(node, str):
            if seen and not (above.tag == "details" and "open" not in above.attributes):
                flow.text(node, pre)
            continue
        if hidden(node, above):
            continue
        tag, style = node.tag, _style(node)
        if "visibility:" in style:
            seen = "visibility:visible" in style
        if tag == "br":
            flow.line_break()
            continue
        if tag == "wbr" or tag == "img" or tag in VOID and tag not in ("hr", "input"):
            continue
        if tag == "input":
            if node.attributes.get("type", "").lower() in ("submit", "button", "reset") and seen:
                flow.text(node.attributes.get("value", ""), False)
            continue
        spaced = 1 if tag in SPACED else 0
        if tag in ("ul", "ol", "menu", "dir") and counters:
            spaced = 0  # a list inside a list follows its item closely
        is_block = tag in BLOCK or "display:block" in style or id(node) in lines
        is_block |= tag == "text" and above.tag in DRAWING
        if tag == "mtd" or above.tag == "mfrac":
            flow.space = True
        if is_block:
            flow.block(spaced)
        if tag == "hr":
            continue
        if tag == "table" and depth < _TABLE_DEPTH and seen:
            flow.rows(table_lines(node, depth))
            flow.block(1)
            continue
        if tag == "select" and not _is_list_box(node):
            # closed, it shows one option
            options = _options(node)
            shown = [o for o in options if "selected" in o.attributes] or options
            stack += [(o, node, pre, seen) for o in shown[:1]]
            continue
        if tag == "select":
            lines.update(map(id, _options(node)))
        elif tag == "optgroup" and seen:
            flow.text(node.attributes.get("label", ""), False)
        indent = ""
        if tag in ("ul", "ol", "menu", "dir"):
            start = _number(node.attributes.get("start"), 1)
            counters.append([tag == "ol", start])
        elif tag == "li":
            ordered, number = counters[-1] if counters else (False, 1)
            number = _number(node.attributes.get("value"), number) if ordered else number
            if counters:
                counters[-1][1] = number + 1
            flow.bullet = f"{number}. " if ordered else "- "
            indent = " " * len(flow.bullet)
        elif tag in ("blockquote", "dd"):
            indent = "  "
        if indent:
            flow.indent.append(indent)

        def close(tag=tag, is_block=is_block, spaced=spaced, indent=indent):
            if is_block:
                flow.block(spaced)
            if indent:
                flow.indent.pop()
                flow.bullet = "" if tag == "li" else flow.bullet
            if tag in ("ul", "ol", "menu", "dir"):
                counters.pop()

        stack.append(close)
        pre = pre or tag in ("pre", "textarea", "xmp") or "white-space:pre" in style
        stack += [(c, node, pre, seen) for c in reversed(node.children)]
        if tag in ("td", "th"):  # cells outside a laid-out table stand side by side
            flow.space = True
    flow.block()
    return flow.lines


def render(page: str | None) -> str:
    """The visible text of a page; empty for null."""
    if not isinstance(page, str):
        return ""
    body = parse(page).children[1]
    return "" if hidden(body) else "\n".join(layout([body]))


def visible_text(html: Column) -> Column:
    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([render(p) for p in batch], dtype=object)

    return text(html)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_lines, n_chars``.

    A null or empty page has an empty text and no lines. Pages of any length and depth are rendered
    whole; tables nested deeper than eight keep their text but not their columns. Repeated rows are kept
    and an empty table stays empty; columns other than ``page_id``, ``url`` and ``html`` are not read.
    """
    found = pages.select("page_id", "url", visible_text(F.col("html")).alias("text"))
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return found.select(
        "page_id", "url", "text", lines.cast("long").alias("n_lines"),
        F.length("text").cast("long").alias("n_chars"),
    )


def op6_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
