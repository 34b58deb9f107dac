"""Visible text of HTML pages with its layout.

A tree builder reads tags in order and keeps the open elements, with the tags
that HTML implies: a block closes an open paragraph, an item, row, cell, term
or option closes its predecessor, cells get rows and rows get tables, end tags
close what is open inside them, and end tags without a start are ignored. A head
ends at the first tag or text that cannot stand in it. In ``svg`` and ``math`` a
slash closes an element, and a block of HTML ends them. What
is not shown is left out: heads, scripts, styles, templates and the like,
``hidden`` elements and those whose style says so. Choices of a ``select`` are
controls, not text, and are left out by definition, the shown one too.

Formulas (``math``) give their tokens apart by a space, without annotations.
Drawings (``svg``) give each ``text`` on its own lines, and the HTML in them.

Text is laid out as it is built: white space collapses outside ``pre``, blocks
begin lines, paragraphs, headings, lists and tables stand apart by one empty
line, list items get ``- `` or their number and are indented, and the cells of
a table are padded to the width of their column. Time and text stay in
proportion to the page: indents end at ``MOST_INDENT`` columns, a cell wider
than ``MOST_CELL`` widens no column, columns are aligned up to ``MOST_ALIGNED``,
and tables inside ``MOST_TABLES`` others are not aligned.

Null and empty pages give an empty text. Unclosed tags and comments end at the
page's end, a ``<`` that begins no tag is text. Rows are independent: repeated
pages each get a row, a null page_id is kept. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import tidy

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe noembed noframes object "
    "audio video canvas datalist select meta link base".split()
)
#: What is not shown in a drawing or formula.
UNSEEN_IN = {
    "svg": frozenset("defs symbol clippath mask pattern marker metadata desc lineargradient radialgradient filter".split()),
    "label": frozenset(("desc", "metadata")),
    "math": frozenset(("annotation", "annotation-xml", "mphantom")),
}
TOKEN = frozenset("mi mn mo ms mtext".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure menu".split())
BLOCK = APART | frozenset(
    "html body div section article header footer nav aside main address form fieldset figcaption "
    "li dd dt tr caption hr center details summary legend hgroup dialog search".split()
)
CELL = frozenset(("td", "th"))
#: Open elements that a start tag ends, looked for up to one of the limits.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "table", "td", "th"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th"))),
    "td": (CELL, frozenset(("tr", "table"))),
    "th": (CELL, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "thead": (frozenset(("thead", "tbody", "tfoot", "tr")), frozenset(("table",))),
    "tbody": (frozenset(("thead", "tbody", "tfoot", "tr")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot", "tr")), frozenset(("table",))),
    "body": (frozenset(("head",)), frozenset()),
}
ENDS_P = APART | frozenset(
    "div section article header footer nav aside main address form fieldset figcaption li dd dt hr details summary".split()
)
#: What may stand in a head; any other tag, and text, ends it.
HEAD = frozenset("title meta link style script base basefont bgsound template noscript noframes".split())
#: Drawings and formulas: their elements may be closed by a slash. HTML resumes
#: inside some of them, and these start tags of HTML end them.
FOREIGN = frozenset(("svg", "math"))
RESUMES = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_P = (frozenset(("p",)), frozenset(("table", "td", "th", "li", "button", "body")))

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Box:
    """An open or finished block: lines, and whether it stands apart."""

    __slots__ = ("apart", "items", "kind", "number", "pre", "rows", "span")

    def __init__(self, kind: str, pre: bool):
        self.kind, self.pre, self.apart = kind, pre, kind in APART
        self.items: list = []
        self.rows: list = []
        self.number: int | None = None
        self.span = 1


def _inline(parts: list[str], pre: bool) -> list[str]:
    text = "".join(parts)
    if pre:
        lines = text.replace("\r\n", "\n").replace("\x00", "\n").split("\n")
        return [x.rstrip() for x in lines]
    return [_SPACE.sub(" ", x).strip(" ") for x in text.split("\x00")]


class Block:
    """Finished lines: pairs of an indent, to which ``shift`` is added, and the
    pieces of the text, last piece first. Indents are resolved once, at the end,
    and the fewer lines are moved when blocks are joined, so nesting copies no
    line at every level."""

    __slots__ = ("lines", "shift")

    def __init__(self, texts=()):
        self.lines = deque([0, [x] if x else []] for x in texts)
        self.shift = 0

    def trimmed(self) -> Block:
        """Without empty lines at its ends."""
        while self.lines and not self.lines[0][1]:
            self.lines.popleft()
        while self.lines and not self.lines[-1][1]:
            self.lines.pop()
        return self

    def joined(self, below: Block) -> Block:
        """This block's lines and then those of another; both are used up."""
        few, many = (below, self) if len(below.lines) <= len(self.lines) else (self, below)
        for line in few.lines:
            line[0] += few.shift - many.shift
        if many is self:
            many.lines.extend(few.lines)
        else:
            many.lines.extendleft(reversed(few.lines))
        return many

    def marked(self, mark: str) -> Block:
        """Indented by a mark that stands before the first line."""
        first = self.lines[0]
        inner = min(first[0] + self.shift, MOST_INDENT)
        self.shift += len(mark)
        first[0] = -self.shift
        first[1] += [" " * inner, mark]
        return self

    def texts(self) -> list[str]:
        return [" " * min(i + self.shift, MOST_INDENT) + "".join(reversed(x)) if x else "" for i, x in self.lines]


def lay_out(box: Box) -> Block:
    """Lines of a block: runs of inline text and the blocks between them."""
    out = Block()
    apart = False
    run: list[str] = []

    def put(new: Block, gap: bool) -> None:
        nonlocal apart, out
        if new.trimmed().lines:
            if out.lines and (gap or apart):
                out.lines.append([0, []])
            out = out.joined(new)
            apart = gap
        elif gap:
            apart = bool(out.lines)

    for item in box.items:
        if isinstance(item, str):
            run.append(item)
            continue
        if run:
            put(Block(_inline(run, box.pre)), False)
            run = []
        put(item[0], item[1])
    if run:
        put(Block(_inline(run, box.pre)), False)
    return out


#: Columns of indent, of a cell that widens its column, and up to which columns
#: of a table are aligned; tables around a table whose cells are still aligned.
MOST_INDENT, MOST_CELL, MOST_ALIGNED, MOST_TABLES = 64, 160, 480, 16


def _table(rows: list[list[tuple[Block, int]]], aligned: bool = True) -> Block:
    """Cells in columns. A cell over several columns, or wider than
    ``MOST_CELL``, widens none; what follows it on its line comes after two
    spaces. Rows of one cell, and tables deep inside others, need no columns:
    their cells stand below each other."""
    if not aligned or all(len(row) == 1 for row in rows):
        out = Block()
        for row in rows:
            for cell, _ in row:
                out = out.joined(cell)
        return out
    texts = [[(cell.texts(), span) for cell, span in row] for row in rows]
    width: dict[int, int] = {}
    for row in texts:
        at = 0
        for lines, span in row:
            if span == 1:
                width[at] = max(width.get(at, 0), max((n for n in map(len, lines) if n <= MOST_CELL), default=0))
            at += span
    columns = sorted(width)
    before = [0, *accumulate(width[c] for c in columns)]
    out = []
    for row in texts:
        # pieces and length of each line so far
        got = [([], [0]) for _ in range(max((len(lines) for lines, _ in row), default=0))]
        at = 0
        for lines, span in row:
            left = min(before[bisect_left(columns, at)] + 2 * at, MOST_ALIGNED)
            for x, (pieces, size) in zip(lines, got, strict=False):
                if x:
                    gap = max(left - size[0], 2 if pieces else 0)
                    pieces += [" " * gap, x]
                    size[0] += gap + len(x)
            at += span
        out += ["".join(pieces).rstrip() for pieces, _ in got]
    return Block(out)


#: Columns that one cell may span, as in the HTML standard.
MOST_SPAN = 1000


class Builder:
    """Open elements and the blocks they lay out."""

    def __init__(self):
        self.open: list[tuple[str, int, Box | None, bool]] = []
        self.boxes = [Box("body", False)]
        self.unseen = 0
        # where tags are a drawing's, its label's or a formula's ("" in HTML),
        # and what they were outside
        self.foreign = [""]
        # whether the formula has a token yet
        self.tokens = False
        # how many of each element are open: end tags need no search in vain
        self.count: dict[str, int] = {}

    def _end_head(self) -> None:
        if self.open and self.open[-1][0] == "head":
            self._pop()

    def text(self, s: str) -> None:
        if self.unseen and s.strip(" \t\n\r\f"):
            self._end_head()
        if not self.unseen and s:
            if self.foreign[-1] == "math" and s.isspace():
                return
            box = self.boxes[-1]
            if box.kind in ("table", "tr") and not s.strip():
                return
            box.items.append(s)

    def _push(self, name: str, unseen: bool, number: int | None = None, span: int = 1) -> None:
        box, here, turn, hides = None, self.foreign[-1], None, int(unseen)
        if name in FOREIGN:
            turn = name
            hides += name == "svg" and here != "svg"
            self.tokens = False
        elif here and name in RESUMES:
            turn = ""
        elif here == "svg" and name == "text":
            turn = "label"
        # a drawing hides its text, its labels show theirs
        label = here == "svg" and name in ("text", "foreignobject")
        hides -= label
        if not self.unseen + hides and (name in BLOCK or name in CELL or label):
            above = self.boxes[-1]
            box = Box(name, above.pre or name == "pre")
            box.span = span
            if name == "ol":
                box.number = 1 if number is None else number
            self.boxes.append(box)
        self.unseen += hides
        if turn is not None:
            self.foreign.append(turn)
        self.open.append((name, hides, box, turn is not None))
        self.count[name] = self.count.get(name, 0) + 1

    def _pop(self) -> str:
        name, hides, box, turns = self.open.pop()
        self.count[name] -= 1
        self.unseen -= hides
        if turns:
            self.foreign.pop()
        if box is not None:
            self.boxes.pop()
            self._place(box, self.boxes[-1])
        return name

    def _place(self, box: Box, above: Box) -> None:
        out = lay_out(box)
        if box.kind in CELL:
            if above.kind == "tr":
                above.rows.append((out, box.span))
            else:
                above.items.append((out, False))
            return
        # tables around this one
        aligned = self.count.get("table", 0) < MOST_TABLES
        if box.kind == "tr":
            row = [(out, 1), *box.rows] if out.lines else box.rows
            if above.kind == "table":
                if row:
                    above.rows.append(row)
            else:
                above.items.append((_table([row], aligned), False))
            return
        if box.kind == "table":
            out = out.joined(_table(box.rows, aligned))
        elif box.kind == "li" and out.lines:
            mark = "- "
            if above.number is not None:
                mark = f"{above.number}. "
                above.number += 1
            out = out.marked(mark)
        elif box.kind in ("blockquote", "dd"):
            out.shift += 2
        apart = box.apart and not (box.kind in ("ul", "ol", "menu") and above.kind == "li")
        above.items.append((out, apart))

    def _end_implied(self, ended: frozenset, limits: frozenset) -> None:
        if not any(self.count.get(n) for n in ended):
            return
        found = -1
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name in limits:
                break
            if name in ended:
                found = i
                if name != "p":
                    continue
                break
        if found >= 0:
            while len(self.open) > found:
                self._pop()

    def start(self, name: str, attrs: str) -> bool:
        """Whether the element is open and what follows is its content."""
        if self.foreign[-1] and name in ENDS_FOREIGN:
            while self.foreign[-1]:
                self._pop()
        if self.unseen and name not in HEAD and self.open[-1][0] == "head":
            if name in ("html", "head"):
                return False
            self._end_head()
        if name == "br":
            self.text("\x00")
            return False
        if name in ENDS_P:
            self._end_implied(*_P)
        if name in IMPLIED:
            self._end_implied(*IMPLIED[name])
        if name in CELL and not (self.boxes[-1].kind == "tr") and not self.unseen:
            if self.boxes[-1].kind != "table":
                self._push("table", False)
            self._push("tr", False)
        elif name == "tr" and self.boxes[-1].kind != "table" and not self.unseen:
            self._push("table", False)
        if name in VOID:
            if name == "hr" and not self.unseen:
                self.boxes[-1].items.append((Block(), True))
            return False
        here = self.foreign[-1]
        unseen, number, span = name in UNSEEN or name in UNSEEN_IN.get(here, ()), None, 1
        if here == "math" and name in TOKEN:
            if self.tokens and not self.unseen:
                self.boxes[-1].items.append(" ")
            self.tokens = True
        if attrs:
            for a in _ATTR.finditer(attrs):
                key = a[1].lower()
                if key == "hidden":
                    unseen = True
                elif key == "style" and a[2] and _HIDING.search(a[2]):
                    unseen = True
                elif key in ("colspan", "start") and a[2]:
                    m = re.match(r"[\"']?\s*(-?\d{1,9})", a[2])
                    if m and key == "start":
                        number = int(m[1])
                    elif m:
                        span = min(max(int(m[1]), 1), MOST_SPAN)
        closed = (name in FOREIGN or here) and _self_closed(attrs)
        self._push(name, unseen, number, span)
        if closed:
            self._pop()
        return not closed

    def end(self, name: str) -> None:
        if name in ("body", "html", "br"):
            self._end_head()
        if name == "br":
            self.text("\x00")
            return
        if not self.count.get(name):
            if name == "p" and not self.unseen:
                self.boxes[-1].items.append((Block(), True))
            return
        # an end tag inside a cell does not reach out of its table
        if name not in ("table", "tr", "td", "th", "tbody", "thead", "tfoot", "body", "html"):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == name:
                    break
                if self.open[i][0] in CELL:
                    return
        while self._pop() != name:
            pass

    def finish(self) -> str:
        while self.open:
            self._pop()
        return "\n".join(lay_out(self.boxes[0]).texts())


def _self_closed(attrs: str) -> bool:
    """Whether a tag ends in a slash that is no part of an unquoted value."""
    if not attrs.endswith("/"):
        return False
    last = 0
    for a in _ATTR.finditer(attrs):
        last = a.end()
    return last < len(attrs)


def _tag_end(html: str, at: int, closed: dict[str, bool]) -> int:
    """Place of the ``>`` that ends a tag; quotes may hold others."""
    while True:
        stop = html.find(">", at)
        if stop < 0:
            return len(html)
        quote = min((q for q in (html.find('"', at, stop), html.find("'", at, stop)) if q >= 0), default=-1)
        # a quote opens a value only after "="
        if quote < 0 or not html[at:quote].rstrip().endswith("="):
            if quote < 0:
                return stop
            at = quote + 1
            continue
        mark = html[quote]
        end = html.find(mark, quote + 1) if closed[mark] else -1
        if end < 0:
            closed[mark] = False  # no more of them further on
            return stop
        at = end + 1


def visible_text(html: str) -> str:
    """The page's visible text."""
    b = Builder()
    at, n = 0, len(html)
    closed = {'"': True, "'": True}
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            s = html[at:lt]
            b.text((unescape(s) if "&" in s else s).replace("\x00", ""))
        if lt >= n:
            break
        m = _NAME.match(html, lt)
        if m is None:
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif b.foreign[-1] and html.startswith("<![CDATA[", lt):
                end = html.find("]]>", lt + 9)
                b.text(html[lt + 9 : n if end < 0 else end].replace("\x00", ""))
                at = n if end < 0 else end + 3
            elif html.startswith(("<!", "<?", "</"), lt):
                end = html.find(">", lt + 2)
                at = n if end < 0 else end + 1
            else:
                b.text("<")
                at = lt + 1
            continue
        name = m[1].lower()
        stop = _tag_end(html, m.end(), closed)
        at = stop + 1
        if html[lt + 1] == "/":
            b.end(name)
            continue
        if b.start(name, html[m.end() : stop]) and name in RAW:
            # its content is no markup
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            end = close.start() if close else n
            s = html[at:end]
            if name in ("textarea", "title"):
                s = unescape(s)
            b.text(s.replace("\x00", ""))
            b.end(name)
            at = n if close is None else html.find(">", close.end()) + 1 or n
    return b.finish()


def _render(batches):
    for b in batches:
        texts = [visible_text(h) if h else "" for h in b["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["page_id"], pa.array(texts, pa.string())], ["page_id", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, text`` for each row of ``page_id, html``."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html")
    return rows.mapInArrow(tidy(_render), "page_id bigint, text string")
