"""Finding elements in page markup with regular expressions and array functions.

A page is small next to a table of pages, so one page is handled inside one row
and the table is spread over tasks by Spark; nothing here leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import escape

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagledger.functions.text import MARK

# What \\s stands for, spelled out: a class of single characters is a table, a class with \\s in it is not.
_SPACE = r" \t\n\x0B\f\r"
# Attributes up to the end of a start tag; a '>' inside quotes does not end it.
# What is inside a possessive group is not tried twice either.
_ATTRIBUTES = r"""(?:[^>"']+|"[^"]*+"|'[^']*+')*+"""
_NAME_END = rf"(?=[{_SPACE}/>])"


def _before(name: str) -> str:
    """Pattern of what stands before an attribute of this name in a start tag; never tried twice."""
    return rf"""(?:[^>"'{_SPACE}]+|"[^"]*+"|'[^']*+'|[{_SPACE}](?!(?i:{escape(name)})\s*=))*+"""


@dataclass(frozen=True)
class TagRule:
    """A tag, and what its class must hold: a word of it (``token``) or a part of it."""

    tag: str
    css_class: str | None = None
    match: str = "token"

    @property
    def start(self) -> str:
        """Pattern of the start tag, without capturing groups."""
        return f"<{self.opened}"

    @property
    def opened(self) -> str:
        """The same without the '<', to look for it behind one."""
        return rf"(?i:{escape(self.tag)}){_NAME_END}{self._class()}{_ATTRIBUTES}>"

    def _class(self) -> str:
        """Up to the end of the class; after it the attributes go on as they would without a class."""
        if self.css_class is None:
            return ""
        word = escape(self.css_class)
        if self.match == "token":
            values = [rf'"(?:[^"]*\s)?{word}(?:\s[^"]*)?"', rf"'(?:[^']*\s)?{word}(?:\s[^']*)?'", rf"{word}{_NAME_END}"]
        elif self.match == "part":
            values = [rf'"[^"]*{word}[^"]*"', rf"'[^']*{word}[^']*'", rf"[^\s\"'>]*{word}"]
        else:
            raise ValueError(f"unknown match: {self.match!r}")
        return rf"{_before("class")}\s(?i:class)\s*=\s*(?>{'|'.join(values)})"


def _named(tag: str) -> str:
    return f"(?i:{escape(tag)}){_NAME_END}"


def _up_to(tag: str) -> str:
    """Pattern of text up to the next start or end tag of this name; never tried twice."""
    return f"(?:[^<]+|<(?!/?{_named(tag)}))*+"


def _end(tag: str) -> str:
    """Pattern of an end tag's beginning, with one character behind the name."""
    return rf"</(?i:{escape(tag)})[{_SPACE}/>]"


def starts_with_tag(html: Column, rule: TagRule) -> Column:
    return html.rlike("^" + rule.start)


def _cut_before(html: Column, pattern: str) -> Column:
    """Array of the text before the first '<' with a match behind it and the pieces each such '<' begins.

    Marks the matches and splits at the mark: a replacement keeps its compiled
    pattern from row to row, a split by pattern compiles it for every row.
    """
    return F.split(F.regexp_replace(html, f"<(?={pattern})", f"{MARK}<"), MARK)


def split_at_starts(html: Column, rule: TagRule) -> Column:
    """The text before any start tag, then a piece from each start tag on."""
    return _cut_before(html, rule.opened)


def from_first(html: Column, rule: TagRule) -> Column:
    """Text from the first matching start tag on; ``''`` if there is none."""
    return F.regexp_extract(html, f"(?s)({rule.start}.*)", 1)


def cut_at_tags(html: Column, tag: str) -> Column:
    """Pieces that each begin with a start or end tag of this name."""
    return _cut_before(html, f"/?{_named(tag)}")


def first_element(pieces: Column) -> Column:
    """The element that pieces of ``cut_at_tags`` begin with, up to its own end tag.

    Counts start and end tags, so inner elements of the same name do not end it.
    An element that is never closed goes to the end of the text.
    """

    def step(acc: Column, piece: Column) -> Column:
        depth = acc["depth"] + F.when(piece.startswith("</"), -1).when(piece == "", 0).otherwise(1)
        inside = acc["open"] & ((depth > 0) | (piece == ""))
        return F.struct(
            depth.cast("int").alias("depth"),
            (acc["taken"] + inside.cast("int")).cast("int").alias("taken"),
            inside.alias("open"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("taken"), F.lit(True).alias("open"))
    taken = F.aggregate(pieces, start, step, lambda acc: acc["taken"])
    counted = F.array_join(F.slice(pieces, F.lit(1), taken), "")
    # Mostly nothing of the same name is inside: after what is before the first tag ('') and
    # the element's start comes its end.
    plain = (F.get(pieces, F.lit(0)) == "") & F.get(pieces, F.lit(2)).startswith("</") & ~F.get(pieces, F.lit(1)).startswith("</")
    return F.when(plain, F.get(pieces, F.lit(1))).otherwise(counted)


def plain_element(html: Column, tag: str) -> Column:
    """The element a text begins with, if none of the same name inside holds another one; else ``''``."""
    text = _up_to(tag)
    return F.regexp_extract(html, f"^(<{text}(?:<{_named(tag)}{text}</{_named(tag)}{text})*+){_end(tag)}", 1)


def element_here(plain: Column, html: Column, tag: str) -> Column:
    """The element a text begins with, of its ``plain_element``; otherwise tags are counted."""
    return F.when(plain != "", plain).otherwise(first_element(cut_at_tags(html, tag)))


def near_element(html: Column, rule: TagRule) -> Column:
    """Text from the first matching start tag to the next tag of its name; with the beginning of that if it is an end tag."""
    return F.regexp_extract(html, f"(<(?={rule.opened}){_up_to(rule.tag)}(?:{_end(rule.tag)})?)", 1)


def whole_element(near: Column, html: Column, rule: TagRule) -> Column:
    """The first matching element, of its ``near_element``; ``''`` if there is none.

    Mostly the next tag of the name is its end.  Otherwise tags are counted.
    """
    size = len(rule.tag) + 3
    closed = F.substring(near, -size, size).rlike(rf"^{_end(rule.tag)}\z")
    counted = first_element(cut_at_tags(from_first(html, rule), rule.tag))
    return F.when(near == "", "").when(closed, F.substring(near, F.lit(1), F.length(near) - size)).otherwise(counted)


def inner_html(element: Column) -> Column:
    """The element without its start tag."""
    return F.regexp_replace(element, rf"^<[A-Za-z]{_ATTRIBUTES}>", "")


def attribute(element: Column, name: str) -> Column:
    """Value of an attribute of the element's start tag as written; ``''`` if it has none."""
    pattern = (
        rf"^<[A-Za-z]{_before(name)}\s(?i:{escape(name)})\s*=\s*"
        r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
    )
    return F.regexp_replace(F.regexp_extract(element, pattern, 1), r"""^["']|["']$""", "")
