"""HTML extraction by layout: all visible text, as a browser would lay it out in plain lines.

A tree builder keeps the stack of open elements. Start tags imply the end of others (a block ends a paragraph, an
item an item, a cell a cell, a row a row) and missing rows are made; whatever is open at the end of the page is
closed there. Elements that are not rendered (head, script, style, template, ``hidden``, ``display:none``,
``visibility:hidden``, ``noscript``, embedded media, drawing definitions) give no text; options, labels of drawings, formulas
and image maps do. Blocks start on a line of their own, paragraphs, headings, lists, tables
and quotes keep a blank line around them; list items get their bullet or number and indent what they hold; cells of
a table are blocks of lines aligned in columns, also across ``colspan`` (1,000 at most, as the standard has it) and ``rowspan``;
a row is as high as its tallest cell; preformatted text keeps its spaces; other white space collapses.

The rules run on one page at a time inside Arrow batches; pages are not shuffled. Nested elements share the buffer
of the nearest item, cell or quote, so depth costs no recursion.

Cases: a null or empty page gives an empty text; a null page_id is carried; broken markup (stray ends, unclosed
comments, quotes or tags, cut pages) never fails: an unfinished tag or comment at the end shows nothing; repeated
rows each give their text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIDDEN = frozenset("head title script style template noscript iframe object noembed noframes datalist audio video canvas area annotation annotation-xml metadata defs desc symbol".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
HEAD = frozenset("base basefont bgsound link meta title script style noscript template".split())  # what a head may hold
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr fieldset listing".split())
BLOCK = SPACED | frozenset("html body address article aside center details dialog dd dir div dt figcaption footer form header hgroup legend li main nav search section summary tbody thead tfoot tr td th caption optgroup option".split())
#: Start tag -> (elements it ends, elements beyond which it does not look).
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "td", "th", "table")), "dt": (("dt", "dd"), ("dl", "td", "th", "table")), "dd": (("dt", "dd"), ("dl", "td", "th", "table")),
    "td": (("td", "th", "caption"), ("table",)), "th": (("td", "th", "caption"), ("table",)), "tr": (("tr", "caption"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "caption"), ("table",)), "thead": (("tbody", "thead", "tfoot", "tr", "caption"), ("table",)), "tfoot": (("tbody", "thead", "tfoot", "tr", "caption"), ("table",)),
    "option": (("option",), ("select", "optgroup")), "optgroup": (("option", "optgroup"), ("select",)),
}
#: Elements that an end tag of something within them does not close.
WALLS = frozenset("table td th caption html".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_BLANKS = re.compile(r"[ \t\r\n\f]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)")


class Buffer:
    """Lines under way, with the run of inline text not yet broken."""

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = 0

    def flush(self, even_empty: bool = False) -> None:
        line = _BLANKS.sub(" ", "".join(self.run)).strip(" ")
        self.run = []
        if line or even_empty:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        self.lines += lines

    def space(self, blank: bool) -> None:
        """End the line; ``blank``: a blank line belongs here."""
        self.flush()
        self.gap = max(self.gap, int(blank))


class Element:
    __slots__ = ("tag", "hidden", "buffer", "rows", "number", "span", "depth", "held", "at")

    def __init__(self, tag: str):
        self.tag, self.hidden, self.buffer, self.rows, self.number, self.span = tag, False, None, None, None, 1
        self.depth, self.held, self.at = 1, {}, 0

    def place(self, cell: Element, lines: list[str]) -> None:
        """Put a cell of this table into the first column that no cell above it still covers."""
        while self.at in self.held:
            self.at += 1
        self.rows[-1][self.at] = lines
        if cell.depth > 1:
            self.held.update(dict.fromkeys(range(self.at, self.at + cell.span), cell.depth))
        self.at += cell.span


class Page:
    def __init__(self):
        self.open: list[Element] = []
        self.buffers = [Buffer()]
        self.hidden = self.pre = 0

    def leave_head(self) -> None:
        if self.open and self.open[-1].tag == "head":
            self.close()

    def text(self, text: str) -> None:
        if self.hidden and text and not text.isspace():
            self.leave_head()
        if self.hidden or not text:
            return
        text = unescape(text)
        buffer = self.buffers[-1]
        if not self.pre:
            buffer.run.append(text)
            return
        first, *rest = text.replace("\r\n", "\n").split("\n")
        buffer.run.append(first.replace(" ", " ").replace("\t", " " * 4))
        for line in rest:
            buffer.flush(even_empty=True)
            buffer.run.append(line.replace(" ", " ").replace("\t", " " * 4))

    def end_open(self, tags: tuple[str, ...], walls) -> bool:
        """Close the innermost open one of ``tags`` and all within it, unless a wall stands before it."""
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i].tag
            if tag in tags:
                while len(self.open) > i:
                    self.close()
                return True
            if tag in walls:
                return False
        return False

    def start(self, tag: str, attributes: str) -> None:
        if tag not in HEAD:
            self.leave_head()
        if tag == "br":
            if not self.hidden:
                self.buffers[-1].flush(even_empty=True)
            return
        if tag in BLOCK:
            self.end_open(("svg", "math"), WALLS | {"foreignobject"})
        if tag in BLOCK and tag not in ("option", "optgroup"):
            self.end_open(("p",), WALLS | {"li", "dd", "dt", "blockquote", "button"} if tag != "li" else WALLS | {"ul", "ol", "blockquote"})
        if tag in ENDS:
            while self.end_open(*ENDS[tag]):
                pass
        if tag in ("td", "th") and self.open and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", "")
        given = {a.lower(): v.strip("\"'") for a, v in _ATTRIBUTE.findall(attributes)} if attributes and not attributes.isspace() else {}
        if tag in VOID:
            if tag == "hr" and not self.hidden:
                self.buffers[-1].space(True)
            return
        e = Element(tag)
        e.hidden = tag in HIDDEN or "hidden" in given or bool(given.get("style")) and bool(_UNSEEN.search(given["style"].lower()))
        self.open.append(e)
        self.hidden += e.hidden
        if self.hidden:
            return
        if tag in BLOCK and tag not in ("td", "th"):
            self.buffers[-1].space(tag in SPACED and not (tag in ("ul", "ol") and self.inside("li")))
        if tag in ("li", "td", "th", "blockquote"):
            e.buffer = Buffer()
            self.buffers.append(e.buffer)
            wide, high = (re.fullmatch(r"\s*0*(\d{1,9})\s*", given.get(a, "")) for a in ("colspan", "rowspan"))
            e.span = min(max(int(wide[1]), 1), 1000) if wide else 1
            e.depth = min(int(high[1]) or 65_534, 65_534) if high else 1  # 0: to the end of the row group
        elif tag == "table":
            e.rows = []
        elif tag == "tr" and (table := self.table()) is not None:
            table.rows.append({})
            table.at = 0
            table.held = {c: n - 1 for c, n in table.held.items() if n > 1}
        elif tag in ("tbody", "thead", "tfoot") and (table := self.table()) is not None:
            table.held = {}
        elif tag == "ol":
            e.number = int(given["start"]) if re.fullmatch(r"-?\d{1,9}", given.get("start", "")) else 1
        elif tag in ("pre", "listing"):
            self.pre += 1
        elif tag == "q":
            self.buffers[-1].run.append('"')

    def inside(self, tag: str) -> bool:
        return len(self.open) > 1 and self.open[-2].tag == tag

    def table(self) -> Element | None:
        return next((e for e in reversed(self.open) if e.rows is not None), None)

    def close(self) -> None:
        e = self.open.pop()
        if self.hidden:
            self.hidden -= e.hidden
            return
        tag = e.tag
        if e.buffer is not None:
            e.buffer.flush()
            self.buffers.pop()
            lines, out = e.buffer.lines, self.buffers[-1]
            if tag == "li":
                place = next((o for o in reversed(self.open) if o.tag in ("ul", "ol", "menu", "dir")), None)
                mark = "- "
                if place is not None and place.number is not None:
                    mark, place.number = f"{place.number}. ", place.number + 1
                out.flush()
                if lines:
                    out.put([mark + lines[0], *(" " * len(mark) + x if x else "" for x in lines[1:])])
            elif tag == "blockquote":
                out.space(True)
                if lines:
                    out.put(["  " + x if x else "" for x in lines])
            else:
                table = self.table()
                if table is None:
                    out.run.append(" " + " ".join(x.strip() for x in lines if x) + " ")
                else:
                    if not table.rows:
                        table.rows.append({})
                    table.place(e, lines)
        if e.rows is not None:
            self.buffers[-1].space(True)
            self.buffers[-1].put(aligned(e.rows))
        if tag in ("pre", "listing"):
            self.pre -= 1
        elif tag == "q":
            self.buffers[-1].run.append('"')
        elif tag == "text":  # a label of a drawing
            self.buffers[-1].run.append(" ")
        if tag in BLOCK and tag not in ("td", "th"):
            self.buffers[-1].space(tag in SPACED and not (tag in ("ul", "ol") and bool(self.open) and self.open[-1].tag == "li"))

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag not in ("html", "body"):  # text may still follow
            self.end_open((tag,), WALLS - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else {"table", "html"} - {tag})


def aligned(rows: list[dict[int, list[str]]]) -> list[str]:
    """Cells (column -> lines) of each column on the same position, two blanks apart; rows and columns without text are left out."""
    widths: dict[int, int] = {}
    for row in rows:
        for column, lines in row.items():
            widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
    columns, out = sorted(c for c, w in widths.items() if w), []
    for row in rows:
        if any(map(any, row.values())):
            for i in range(max(map(len, row.values()))):
                cells = ((row[c][i] if c in row and i < len(row[c]) else "").ljust(widths[c]) for c in columns)
                out.append("  ".join(cells).rstrip())
    return out


def visible_text(html: str) -> str:
    page, at, size = Page(), 0, len(html)
    while at < size:
        tag = html.find("<", at)
        if tag < 0:
            page.text(html[at:])
            break
        after = html[tag + 1 : tag + 2]
        if not (after.isalpha() and after.isascii() or after in ("/", "!", "?")) or not after:
            page.text(html[at : tag + 1])
            at = tag + 1
            continue
        page.text(html[at:tag])
        if after in ("!", "?") or after == "/" and not re.match(r"[a-zA-Z]", html[tag + 2 : tag + 3]):
            comment = html.startswith("<!--", tag)
            end = html.find("-->", tag + 2) if comment else html.find(">", tag + 1)
            at = size if end < 0 else end + (3 if comment else 1)
            continue
        m = _TAG.match(html, tag) or _LOOSE.match(html, tag)
        if m is None:
            break
        at = m.end()
        name = m[2].lower()
        if m[1]:
            page.end(name)
            continue
        page.start(name, m[3])
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, at)
            page.text(html[at : stop.start() if stop else size])
            at = stop.start() if stop else size
    while page.open:
        page.close()
    page.buffers[0].flush()
    return "\n".join(page.buffers[0].lines).replace(" ", " ").strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars of every page."""

    def run(batches):
        for b in batches:
            out = [visible_text(h) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], ["page_id", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("html"), F.lit("")).alias("html")).mapInArrow(run, "page_id long, text string, n_chars long")
