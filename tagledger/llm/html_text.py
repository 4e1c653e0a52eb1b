"""Visible text of HTML pages, laid out: block spacing, lists, aligned table cells.

A tree builder reads the tags, opens and closes the ones that may be left out, and ignores
what nobody opened; a renderer walks the visible part of the tree.  Each page is handled
by itself, in linear time: no shuffle.

* Hidden: head, scripts, styles, templates, embedded media, ``hidden``, ``display:none``,
  ``visibility:hidden``, comments, alternative texts.
* Blocks stand on lines of their own; paragraphs, headings, lists, tables and quotes have a blank
  line around them.  White space is collapsed, but kept inside ``pre`` and ``textarea``.
* Items get ``- `` or their number, and what belongs to them is indented.
* Cells of a table's column start at the same place.  What is wider than ``WIDEST`` ends its line, and the
  cells behind it go on in the next one at their own place.  A cell over several columns or rows
  keeps the others in theirs.  Columns that would begin more than ``FARTHEST`` characters from the left follow
  each other in their line.

Null and empty pages give an empty text.  An unclosed comment or script ends with the page; a
``<`` that begins no tag is text.  Elements nested deeper than ``DEEPEST`` are open and closed like others, but
what they show stands in the element at that depth, on lines of its own where they are blocks; what is
hidden stays hidden at any depth.  Repeated rows are kept; other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDEST = 60
DEEPEST = 150
FARTHEST = 2_000
GAP = "  "

# HTML's own element groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes title textarea".split())
UNSEEN = set("head script style template title iframe noembed noframes object video audio canvas svg datalist param map".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul caption xmp".split()
)
SPACED = set("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul dir xmp".split())
ENDS_P = BLOCK - set("body dd dt html li option optgroup tbody td tfoot th thead tr caption legend".split())
# A start tag closes these open elements, up to the nearest of the second group.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
# An end tag does not reach beyond these.
SCOPE = {"table", "td", "th", "caption", "template", "button"}
IN_HEAD = set("base link meta title style script noscript template".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_HIDDEN = re.compile(r"(?:^|[\s\"'])hidden(?=[\s=/]|$)|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        for found in _ATTRIBUTE.finditer(self.attributes):
            if found[1].lower() == name:
                return html.unescape((found[2] or "").strip("\"'"))
        return None

    def number(self, name: str) -> int | None:
        value = self.get(name)
        return int(value) if value and re.fullmatch(r"\s*-?[0-9]{1,9}\s*", value) else None

    def seen(self) -> bool:
        if self.tag in UNSEEN or self.tag == "dialog" and self.get("open") is None:
            return False
        if not self.attributes or not _HIDDEN.search(self.attributes):
            return True
        style = self.get("style") or ""
        return self.get("hidden") is None and not re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", style, re.I)


def parse(page: str) -> Element:
    """The tree of a page."""
    root = Element("html")
    stack = [root]
    opened = Counter()  # open elements by name

    def cut(depth: int):
        """Close what is open from this depth on."""
        for own in stack[depth:]:
            opened[own.tag] -= 1
        if depth < DEEPEST < len(stack) and any(e.tag in BLOCK for e in stack[DEEPEST:]):
            stack[DEEPEST - 1].children.append(Element("div"))
        elif depth >= DEEPEST and any(e.tag in BLOCK for e in stack[depth:]):
            stack[depth - 1].children.append(Element("div"))
        del stack[depth:]

    def close(names: set[str], stop: set[str]):
        """Close open elements of these names, and what is open inside them."""
        if not any(opened[name] for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in stop:
                return
            if stack[depth].tag in names:
                cut(depth)
                if not any(opened[name] for name in names):
                    return

    def add_text(text: str):
        if text:
            if stack[-1].tag == "head" and text.strip():
                cut(len(stack) - 1)
            stack[-1].children.append(text)

    def start(tag: str, attributes: str) -> Element:
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ENDS_P:
            close({"p"}, SCOPE)
        top = stack[-1].tag
        if top == "head" and tag not in IN_HEAD:
            cut(len(stack) - 1)
        if tag == "tr" and top in {"td", "th"}:
            cut(len(stack) - 1)
        if tag in {"td", "th"} and stack[-1].tag in {"table", "thead", "tbody", "tfoot"}:
            start("tr", "")
        own = Element(tag, attributes)
        if tag in VOID or len(stack) < DEEPEST:
            stack[-1].children.append(own)
        elif own.seen():
            # Too deep for a level of its own: its text goes where the last level's goes.
            if tag in BLOCK:
                stack[-1].children.append(Element("div"))
            own.children = stack[-1].children
        if tag not in VOID:
            stack.append(own)
            opened[tag] += 1
        return own

    at, last = 0, len(page) if "<!" in page else page.rfind(">") + 1  # no tag ends behind the last ">"
    while at < len(page):
        found = _TAG.search(page, at, last) if at < last else None
        if found is None:
            add_text(html.unescape(page[at:]))
            break
        add_text(html.unescape(page[at : found.start()]))
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        if found[1] or found[4]:
            if tag == "p" and not opened["p"] or tag == "br":
                start(tag, "")
            for depth in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[depth].tag == tag:
                    cut(depth)
                    break
                if stack[depth].tag in SCOPE and tag not in {"table", "tr", "tbody", "thead", "tfoot", "body", "html"}:
                    break
            continue
        attributes = found[3] if found[2] else found[6]
        if tag in {"html", "body"}:
            close(*CLOSES["body"])
            continue
        own = start(tag, attributes)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            inner = page[at : end.start() if end else len(page)]
            if tag == "textarea":
                own.children.append(html.unescape(inner.removeprefix("\n")))
            elif tag == "xmp":
                own.children.append(inner)
            closing = page.find(">", end.end()) if end else -1
            at = closing + 1 if closing >= 0 else len(page)
            if stack[-1] is own:
                cut(len(stack) - 1)
    return root


class Lines:
    """Lines of a block, with the inline text that is not on a line yet."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.blank = False

    def text(self, text: str):
        self.inline.append(text)

    def end_line(self, forced: bool = False):
        line = " ".join("".join(self.inline).split())
        self.inline = []
        if line or forced and self.lines:
            self.put([line])

    def put(self, lines: list[str]):
        if lines:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.extend(lines)

    def space(self):
        self.end_line()
        self.blank = True


def render(node: Element) -> list[str]:
    out = Lines()
    _fill(node, out)
    out.end_line()
    return out.lines


def _fill(node: Element, out: Lines):
    for child in node.children:
        if isinstance(child, str):
            out.text(child)
        elif child.seen():
            _element(child, out)


def _element(own: Element, out: Lines):
    tag = own.tag
    if tag == "br":
        out.end_line(forced=True)
    elif tag == "input":
        if (own.get("type") or "").lower() in {"submit", "button", "reset"}:
            out.text(own.get("value") or "")
    elif tag == "wbr" or tag in VOID and tag != "hr":
        pass
    elif tag not in BLOCK and tag != "textarea":
        _fill(own, out)
    else:
        out.space() if tag in SPACED else out.end_line()
        if tag in {"pre", "textarea", "xmp"}:
            out.put([x.rstrip() for x in _plain(own).strip("\n").split("\n")] if _plain(own).strip() else [])
        elif tag == "table":
            _table(own, out)
        elif tag in {"ul", "ol", "menu", "dir"}:
            _list(own, out)
        elif tag in {"blockquote", "dd"}:
            out.put(["  " + x if x else x for x in render(own)])
        else:
            _fill(own, out)
        out.space() if tag in SPACED else out.end_line()


def _plain(node: Element) -> str:
    parts = []
    for child in node.children:
        if isinstance(child, str):
            parts.append(child)
        elif child.tag == "br":
            parts.append("\n")
        elif child.seen():
            parts.append(_plain(child))
    return "".join(parts)


def _list(own: Element, out: Lines):
    number = own.number("start") or 1
    loose = Lines()
    for child in own.children:
        if isinstance(child, str):
            loose.text(child)
        elif child.seen():
            if child.tag != "li":
                _element(child, loose)
                continue
            loose.end_line()
            out.put(loose.lines)
            loose.lines = []
            value = child.number("value")
            number = number if value is None else value
            mark = f"{number}. " if own.tag == "ol" else "- "
            number += 1
            lines = render(child)
            if lines:
                pad = " " * len(mark)
                out.put([mark + lines[0], *[pad + x if x else x for x in lines[1:]]])
    loose.end_line()
    out.put(loose.lines)


def _rows(own: Element, out: Lines) -> list[list[Element]]:
    """Rows of cells; captions and stray text go before the table."""
    rows = []
    for child in own.children:
        if isinstance(child, str):
            out.text(child)
        elif child.seen():
            if child.tag == "tr":
                rows.append([c for c in child.children if isinstance(c, Element) and c.tag in {"td", "th"}])
                for other in child.children:
                    if isinstance(other, str):
                        out.text(other)
                    elif other.tag not in {"td", "th"} and other.seen():
                        _element(other, out)
            elif child.tag in {"thead", "tbody", "tfoot"}:
                rows.extend(_rows(child, out))
            else:
                _element(child, out)
    return rows


def _table(own: Element, out: Lines):
    rows = _rows(own, out)
    out.end_line()
    grid: list[dict[int, list[str]]] = []
    covered: list[tuple[int, int, int]] = []  # columns from, behind the last, and the last row, of cells over several rows
    widths: dict[int, int] = {}
    for row, cells in enumerate(rows):
        line, at, nth = {}, 0, 0
        covered = [c for c in covered if c[2] >= row]
        added = []
        for cell in cells:
            while nth < len(covered) and covered[nth][0] <= at:
                at = max(at, covered[nth][1])
                nth += 1
            wide = min(max(cell.number("colspan") or 1, 1), 1000)
            tall = min(max(cell.number("rowspan") or 1, 1), 65534)
            text = render(cell) if cell.seen() else []
            if text:
                line[at] = text
            if wide == 1:
                widths[at] = max(widths.get(at, 0), *map(len, text), 0)
            if tall > 1:
                # Neighbours that end in the same row are one range.
                if added and added[-1][1] == at and added[-1][2] == row + tall - 1:
                    added[-1] = (added[-1][0], at + wide, row + tall - 1)
                else:
                    added.append((at, at + wide, row + tall - 1))
            at += wide
        covered = sorted(covered + added) if added else covered
        grid.append(line)
    place, begins = {}, 0
    for c in sorted({c for line in grid for c in line} | set(widths)):
        place[c] = begins
        begins = min(begins + min(widths.get(c, 0), WIDEST) + len(GAP), FARTHEST)
    for line in grid:
        for n in range(max(map(len, line.values()), default=0)):
            parts, size = [], 0
            for c in sorted(line):
                piece = line[c][n] if n < len(line[c]) else ""
                if not piece:
                    continue
                if size > place[c] and place[c] < FARTHEST:
                    # A piece before it is too wide: go on in the next line.
                    out.put(["".join(parts).rstrip()])
                    parts, size = [], 0
                gap = " " * (place[c] - size) if size <= place[c] else GAP
                parts += [gap, piece]
                size += len(gap) + len(piece)
            if parts:
                out.put(["".join(parts).rstrip()])


def page_text(page: str | None) -> str:
    """The visible text of a page."""
    return "\n".join(render(parse(page))).strip("\n") if page else ""


def visible_text(page: Column) -> Column:
    @F.arrow_udf("string")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([page_text(p) for p in batch.to_pylist()], pa.string())

    return scan(page)


def extract_text(df: DataFrame, page: str = "html", out: str = "text") -> DataFrame:
    """Add the visible text of a page; a column of that name is replaced."""
    return df.withColumn(out, visible_text(F.col(f"`{page}`")))


def page_report(pages: DataFrame) -> DataFrame:
    return extract_text(pages.select("page_id", "html")).select("page_id", "text", F.length("text").alias("n_chars"))
