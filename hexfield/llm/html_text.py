"""Layout-aware rendering of HTML.

A tree builder with implied tags (a paragraph ends where a block begins, an item where the next one
begins, cells and rows likewise) takes the markup apart; visibility rules leave out what a reader does
not see (head, scripts, styles, templates, `hidden`, `display:none` or `visibility:hidden`, inline or
by a plain tag, class or id rule of the page's own style sheet; rules count that hold on every screen,
not those for print, for some widths or under other conditions).  All other text is emitted: blocks on
lines of their own, a blank line around paragraphs and headings, list items with bullets or numbers
and their depth's indent, preformatted text as it stands, table cells in aligned columns (spans of columns
and rows counted in), after what else stands between a table's rows and cells.

Pages are independent rows, so the job is one Arrow pass without a shuffle.  A page takes time and room
in proportion to its length (times its logarithm, for spans), whatever its nesting: open elements are found
by name, spans of rows are kept as gaps between columns, indents are at most `MOST_INDENT`, and the cells of
tables nested deeper than `MOST_TABLES` follow one another as blocks.  Cells are aligned to their columns'
full widths unless that makes more than `ROOM` times the table's text in blanks; then `MOST_PAD` for a column
and `MOST_OFFSET` for a line limit them.

Defined results: null and empty markup render to the empty text; unclosed and stray tags are repaired
as browsers do for the cases above and otherwise ignored; a tag that never ends is dropped with what
follows it; nesting of any depth is walked without recursion; repeated rows are each answered; extra
columns are carried, and those named like an added one are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from html import unescape
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import extended, free, in_arrow

TAG = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
PLAIN_TAG = re.compile(r"[^>\"']*>")
QUOTE_OR_END = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
STYLE = re.compile(r"<style\b", re.I)
STYLE_CLOSE = re.compile(r"</style", re.I)
STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
AT_RULE = re.compile(r"@([\w-]+)(.*)", re.S)
ON_SCREEN = frozenset(["", "all", "screen", "only all", "only screen", "not print", "not speech"])
SELECTOR = re.compile(r"[.#]?[\w-]+")
DECLARED = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([\w-]+)", re.I)
HIDING = {"display": frozenset(["none"]), "visibility": frozenset(["hidden", "collapse"])}
WHITE = re.compile(r"[ \t\n\f\r]+")
MOST_PAD, MOST_OFFSET, MOST_INDENT, MOST_TABLES = 40, 240, 60, 8
ROOM, ROOM_AT_LEAST = 16, 4096

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
UNSEEN = frozenset("head script style title template noscript datalist meta link base".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure".split())
BLOCK = SPACED | frozenset("html body div article section nav header footer main aside address form fieldset details summary figcaption li dt dd tr caption thead tbody tfoot hr center option legend".split())
BLOCK_BUT_P = BLOCK - {"p"}
#: A start tag ends the open elements named, unless one of the barriers stands in between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "body": ({"head"}, set()),
}


class Node:
    """An element: its tag, whether it is seen, and its children (nodes and texts)."""

    __slots__ = ("across", "children", "down", "mark", "start", "tag", "unseen")

    def __init__(self, tag: str, unseen: bool = False, start: int = 1, children: list | None = None):
        self.tag, self.unseen, self.start, self.mark = tag, unseen, start, "- "
        self.across = self.down = 1
        self.children: list[Node | str] = children or []


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _declared(body: str) -> dict[str, bool]:
    """Whether declarations hide, by property; the last one of each counts."""
    return {m[1].lower(): m[2].lower() in HIDING[m[1].lower()] for m in DECLARED.finditer(body)}


def _hidden(tag: str, attributes: dict[str, str], rules: dict[str, dict[str, tuple[int, bool]]]) -> bool:
    """Whether an element is hidden, and with it all that it holds: its own style counts before rules by id,
    these before rules by class and by tag, and of equal ones the last."""
    if tag in UNSEEN:
        return True
    found: dict[str, tuple[int, int, bool]] = {}
    if rules:
        for rank, name in [(0, tag), *((1, "." + c) for c in attributes.get("class", "").split()), (2, "#" + attributes.get("id", ""))]:
            for what, (place, hides) in rules.get(name, {}).items():
                found[what] = max(found.get(what, (-1, 0, False)), (rank, place, hides))
    for what, hides in _declared(attributes.get("style", "")).items():
        found[what] = (3, 0, hides)
    if "hidden" in attributes and "display" not in found:
        return True
    return any(hides for _, _, hides in found.values())


def _on_screen(media: str) -> bool:
    """Whether a list of media queries holds on every screen."""
    return any(" ".join(q.lower().split()) in ON_SCREEN for q in media.split(","))


def _style_sheets(html: str) -> Iterator[tuple[str, str]]:
    """Attributes and text of each style element."""
    at = 0
    while m := STYLE.search(html, at):
        end = html.find(">", m.end())
        if end < 0:
            return
        close = STYLE_CLOSE.search(html, end)
        at = close.end() if close else len(html)
        yield html[m.end() : end], html[end + 1 : close.start() if close else at]


def _hiding(html: str) -> dict[str, dict[str, tuple[int, bool]]]:
    """What the page's style sheets last say about plain selectors on the screen: by property the place of
    the rule and whether it hides."""
    found: dict[str, dict[str, tuple[int, bool]]] = {}
    place = 0
    for raw, sheet in _style_sheets(html):
        if not _on_screen(_attributes(raw).get("media", "")):
            continue
        parts = re.split("([{}])", STYLE_COMMENT.sub(" ", sheet))
        blocks: list[tuple[bool, set[str]]] = [(True, set())]  # whether rules inside count, and the selectors
        for text, brace in zip(parts[::2], [*parts[1::2], "}"], strict=True):
            body, _, head = text.rpartition(";") if brace == "{" else (text, "", "")
            place += 1
            for what, hides in _declared(body).items() if blocks[-1][1] else ():
                for name in blocks[-1][1]:
                    found.setdefault(name, {})[what] = place, hides
            if brace == "{":
                inside = blocks[-1][0]
                if m := AT_RULE.fullmatch(head.strip()):
                    name = m[1].lower()
                    blocks.append((inside and (name == "layer" or (name == "media" and _on_screen(m[2]))), set()))
                else:
                    blocks.append((False, {x.strip() for x in head.split(",") if inside and SELECTOR.fullmatch(x.strip())}))
            elif len(blocks) > 1:
                blocks.pop()
    return found


class Open:
    """The open elements, found by name."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def top(self, tags: Iterable[str]) -> int:
        """The place of the innermost open element of the names; 0 without one."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def cut(self, place: int) -> None:
        """Close the element at a place and all inside it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def end(self, tags: Iterable[str], barriers: Iterable[str]) -> None:
        """Close the open elements of the names that no barrier stands before."""
        if self.top(tags):
            barrier = self.top(barriers)
            while (place := self.top(tags)) > barrier:
                self.cut(place)


def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
    """Where the tag ends whose name ends at `at`: past quoted values; -1 if nowhere."""
    if m := PLAIN_TAG.match(html, at):
        return m.end() - 1
    while m := QUOTE_OR_END.search(html, at):
        if m[0] == ">":
            return m.start()
        at = m.end() if m.start() >= last[m[0]] else html.index(m[0], m.end()) + 1
    return -1


def _number_of(attributes: dict[str, str], name: str, most: int) -> int:
    """A positive number among the attributes, `most` at most; else 1."""
    given = attributes.get(name, "").strip()
    return max(1, min(most, int(given))) if re.fullmatch(r"[0-9]{1,9}", given) else 1


def build(html: str) -> Node:
    """The tree of a page."""
    rules = _hiding(html)
    root = Node("html")
    opened = Open(root)
    last = {c: html.rfind(c) for c in "\"'"}
    at, n = 0, len(html)
    while at < n:
        m = TAG.search(html, at)
        text = html[at : m.start() if m else n]
        if text:
            opened.stack[-1].children.append(unescape(text))
        if not m:
            break
        if not m[2]:
            mark = "-->" if m[0] == "<!--" else ">"
            end = html.find(mark, m.start() + 2)
            at = end + len(mark) if end >= 0 else n
            continue
        end = _tag_end(html, m.end(), last)
        if end < 0:
            break
        at = end + 1
        tag, raw = m[2].lower(), html[m.end() : end]
        if m[1]:  # an end tag closes its element and all inside it; one without an element is ignored
            place = opened.top([tag])
            if place and (tag in BLOCK or place >= opened.top(["table"])):
                opened.cut(place)
            continue
        if tag == "html":
            continue
        attributes = _attributes(raw) if raw else {}
        if tag in ENDS:
            opened.end(*ENDS[tag])
        if tag in BLOCK:
            opened.end(("p",), BLOCK_BUT_P)
        if opened.stack[-1].tag == "head" and tag not in UNSEEN:
            opened.cut(len(opened.stack) - 1)
        start = attributes.get("start", "")
        node = Node(tag, _hidden(tag, attributes, rules), int(start) if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", start) else 1)
        if tag in ("td", "th"):
            node.across, node.down = _number_of(attributes, "colspan", 1000), _number_of(attributes, "rowspan", 65534)
        opened.stack[-1].children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            node.children.append(html[at : close.start() if close else n] if tag in ("script", "style") else unescape(html[at : close.start() if close else n]))
            at = close.end() if close else n
        elif tag not in VOID and not raw.endswith("/"):
            opened.push(node)
    return root


class Lines:
    """Lines under way: inline text gathers in `open` until a block ends it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.open: list[str] = []
        self.gap = False
        self.indent = ""
        self.mark = ""

    def inline(self, text: str) -> None:
        text = WHITE.sub(" ", text)
        if not self.open or self.open[-1].endswith((" ", "\n")):
            text = text.lstrip(" ")
        if text:
            self.open.append(text)

    def take(self) -> str:
        """The inline text so far, which ends here."""
        text, self.open = "".join(self.open), []
        return text

    def end(self, spaced: bool = False) -> None:
        """End the line; `spaced` asks for a blank one before the next text."""
        if text := self.take().strip(" \n"):
            self.put([x.strip(" ") for x in text.split("\n")])
        self.gap |= spaced

    def put(self, lines: list[str]) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        for x in lines:
            self.lines.append((self.indent + self.mark + x).rstrip() if x else "")
            if self.mark:
                self.indent, self.mark = (self.indent + " " * len(self.mark))[:MOST_INDENT], ""

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines)


def _wrappers(table: Node) -> set[int]:
    """The ids of the elements between a table and its own rows and cells."""
    found: set[int] = set()
    path: list[tuple[Node, int]] = [(table, 0)]
    while path:
        x, i = path.pop()
        if i == len(x.children):
            continue
        path.append((x, i + 1))
        c = x.children[i]
        if isinstance(c, str) or c.unseen or c.tag in ("table", "caption"):
            continue
        if c.tag in ("tr", "td", "th"):
            for w, _ in reversed(path):
                if id(w) in found:
                    break
                found.add(id(w))
        if c.tag not in ("td", "th"):
            path.append((c, 0))
    return found


def _parts(table: Node) -> tuple[list[list[Node]], list[Node], list[Node | str]]:
    """The cells of a table's own rows, its captions, and what stands between them."""
    wrappers = _wrappers(table)
    rows: list[list[Node]] = []
    captions: list[Node] = []
    stray: list[Node | str] = []
    stack: list[tuple[Node | str, list[Node] | None]] = [(c, None) for c in reversed(table.children)]
    while stack:
        x, row = stack.pop()
        if isinstance(x, str):
            stray.append(x)
        elif x.unseen:
            continue
        elif x.tag in ("td", "th"):
            stray.append(" ")
            if row is None:
                rows.append([x])
            else:
                row.append(x)
        elif x.tag == "caption":
            captions.append(x)
        elif x.tag in ("tr", "thead", "tbody", "tfoot") or id(x) in wrappers:
            stray.append(" ")
            if x.tag == "tr":
                row = []
                rows.append(row)
            stack += [(" ", row), *((c, row) for c in reversed(x.children))]
        else:
            stray.append(x)
    return [r for r in rows if r], captions, stray if any(isinstance(c, Node) or c.strip() for c in stray) else []


class Gaps:
    """The columns that no cell above holds, as ordered gaps."""

    def __init__(self) -> None:
        self.starts: list[float] = [0]
        self.ends: list[float] = [inf]

    def take(self, a: float, b: float) -> list[tuple[float, float]]:
        """Close what is open of [a, b), and say what that was."""
        i = bisect_right(self.ends, a)
        j, pieces, left = i, [], []
        while j < len(self.starts) and self.starts[j] < b:
            pieces.append((max(a, self.starts[j]), min(b, self.ends[j])))
            left += [x for x in ((self.starts[j], a), (b, self.ends[j])) if x[0] < x[1]]
            j += 1
        self.starts[i:j], self.ends[i:j] = [x for x, _ in left], [y for _, y in left]
        return pieces

    def give(self, a: float, b: float) -> None:
        """Open [a, b) again."""
        i = bisect_left(self.ends, a)
        j = bisect_right(self.starts, b)
        if i < j:
            a, b = min(a, self.starts[i]), max(b, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [a], [b]


def _columns(rows: list[list[Node]]) -> list[list[int]]:
    """The column in which each cell begins, by the spans of the cells before it and above it; where spans
    overlap the earlier one holds.  Columns in which no cell begins are left out of the count.  A row passes
    no more gaps than its own cells do, whatever spans there are above it."""
    gaps, ending = Gaps(), {}
    begins: list[list[float]] = []
    for r, row in enumerate(rows):
        for piece in ending.pop(r, ()):
            gaps.give(*piece)
        at, g, places = 0, 0, []
        for c in row:
            while at >= gaps.ends[g]:
                g += 1
            at = max(at, gaps.starts[g])
            places.append(at)
            at += c.across
        for c, k in zip(row, places, strict=True):
            if c.down > 1:
                pieces = gaps.take(k, k + c.across)
                if r + c.down < len(rows):
                    ending.setdefault(r + c.down, []).extend(pieces)
        begins.append(places)
    order = {k: i for i, k in enumerate(sorted({k for row in begins for k in row}))}
    return [[order[k] for k in row] for row in begins]


def _align(rows: list[list[Node]], texts: list[list[str]]) -> list[str]:
    """Cells in columns: each as wide as its widest line, two spaces between; long cells keep their lines."""
    begins = _columns(rows)
    width: dict[int, int] = {}
    for row, places, cells in zip(rows, begins, texts, strict=True):
        for c, k, text in zip(row, places, cells, strict=True):
            if c.across == 1:
                width[k] = max(width.get(k, 0), *(len(x) for x in text.split("\n")))
    columns = max((k for places in begins for k in places), default=-1) + 1
    lines_, chars = sum(1 + max(t.count("\n") for t in cells) for cells in texts), sum(len(t) for cells in texts for t in cells)
    # blanks stay in proportion to the text: only where full widths would make many more they are limited
    whole = lines_ * (sum(width.values()) + 2 * columns) <= ROOM * chars + ROOM_AT_LEAST
    offset, total = [], 0
    for k in range(columns):
        offset.append(total if whole else min(total, MOST_OFFSET))
        total += (width.get(k, 0) if whole else min(width.get(k, 0), MOST_PAD)) + 2
    out = []
    for places, cells in zip(begins, texts, strict=True):
        lines: dict[int, list[str]] = {}
        size: dict[int, int] = {}
        for k, text in zip(places, cells, strict=True):
            for i, x in enumerate(text.split("\n")):
                parts, now = lines.setdefault(i, []), size.get(i, 0)
                if x:
                    pad = max(offset[k] - now, 2 if now else 0)
                    parts += [" " * pad, x]
                    size[i] = now + pad + len(x)
        out += ["".join(lines[i]) for i in range(len(lines))]
    return out


def _number(items: Node) -> None:
    """Gives the items of a list their bullets or numbers."""
    number = items.start
    for c in items.children:
        if isinstance(c, Node) and c.tag == "li":
            c.mark = f"{number}. " if items.tag == "ol" else "- "
            number += 1


def render(root: Node) -> str:
    """The visible text of a tree, walked with a stack of its own.

    The stack holds what is still to do: visit a node, emit a text, leave a block, or take up a cell's
    or a whole table's text, for which the lines under way are set aside in `tables`.
    """
    out = Lines()
    tables: list[tuple[Lines, list[list[str]]]] = []
    work: list[tuple] = [("visit", root, 0, False)]
    while work:
        what, x, *state = work.pop()
        if what == "text":
            if state[0]:
                out.open.append(x)
            else:
                out.inline(x)
        elif what == "leave":
            if x.tag == "pre":
                text = out.take()
                if text.strip():
                    out.put(text.removeprefix("\n").rstrip().split("\n"))
            out.end(x.tag in SPACED and not (x.tag in ("ul", "ol") and state[1] > 1))
            if state[0] is not None:
                out.indent, out.mark = state[0], ""
        elif what == "rows":
            rows, spaced = state
            out.end(spaced)
            tables.append((out, [[] for _ in rows]))
            work.append(("table", x, rows))
            for i in range(len(rows) - 1, -1, -1):
                for c in reversed(rows[i]):
                    work += [("cell", c, i), ("visit", Node("span", children=c.children), 0, False)]
            out = Lines()
        elif what == "cell":
            tables[-1][1][state[0]].append(out.text().strip("\n"))
            out = Lines()
        elif what == "table":
            out, cells = tables.pop()
            if any(c for r in cells for c in r):
                out.put(_align(state[0], cells))
            out.gap = True
        elif not x.unseen:
            depth, pre = state
            if x.tag == "br":
                out.open.append("\n")
            elif x.tag == "table" and (parts := _parts(x))[0]:
                rows, captions, stray = parts
                out.end(not stray)
                if len(tables) < MOST_TABLES:
                    work.append(("rows", x, rows, not captions))
                else:
                    work += [("visit", Node("div", children=c.children), depth, pre) for r in reversed(rows) for c in reversed(r)]
                work += [("visit", Node("div", children=c.children), depth, pre) for c in reversed(captions)]
                if stray:
                    work.append(("visit", Node("span", children=stray), depth, pre))
            else:
                indent = None
                if x.tag in ("ul", "ol"):
                    _number(x)
                    depth += 1
                if x.tag in BLOCK:
                    out.end(x.tag in SPACED and not (x.tag in ("ul", "ol") and depth > 1))
                if x.tag == "li":
                    indent, out.mark = out.indent, x.mark
                elif x.tag in ("dd", "blockquote"):
                    indent, out.indent = out.indent, (out.indent + "  ")[:MOST_INDENT]
                pre |= x.tag == "pre"
                if x.tag in BLOCK:
                    work.append(("leave", x, indent, depth))
                work += [("text", c, pre) if isinstance(c, str) else ("visit", c, depth, pre) for c in reversed(x.children)]
    return out.text().strip("\n")


def page_text(html: str | None) -> str:
    """The visible text of a page."""
    return render(build(html)) if html else ""


TEXT = "text string, n_chars bigint, n_lines bigint"


def _extract(column: str):
    def run(batches):
        for batch in batches:
            for i in range(0, len(batch), 500):
                part = batch.slice(i, 500)
                texts = [page_text(h) for h in part.column(column).to_pylist()]
                yield pa.record_batch([*part.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], names=[*part.schema.names, *(f.split()[0] for f in TEXT.split(", "))])

    return run


def extract_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """The frame's columns with the text, its characters and its lines."""
    pages = free(pages, TEXT)
    return in_arrow(pages, _extract(column), extended(pages, TEXT))


def op10_html_text(spark, sf_dir: str) -> DataFrame:
    """Every page of the table."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return extract_text(pages).select("page_id", "text", "n_chars", "n_lines", F.sha2("text", 256).alias("text_sha256"))
