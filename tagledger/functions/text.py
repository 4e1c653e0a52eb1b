"""Text clean-up used on names, links and page fragments."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, plus the four ASCII separators that also count as space.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"

# The standard library's table of HTML's character references; names without a semicolon
# are the ones that are also read without it.
REFERENCES = {name: text for name, text in html5.items() if name.endswith(";")}
LEGACY_REFERENCES = {name: text for name, text in html5.items() if not name.endswith(";")}
REPLACEMENT = "\ufffd"

# A control character that no page text holds; drop_hidden removes it.
MARK = "\u0001"
_HIDDEN = r"(?i)<(?:!--(?:[^-]+|-(?!->))*+(?:-->)?|script\b(?s:.*?)</script\s*>|style\b(?s:.*?)</style\s*>)"
ANY_TAG = r"""</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, inside functions of arrays as well."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip_text(text: Column) -> Column:
    """Drop white space of any kind from both ends."""
    return F.btrim(text, F.lit(SPACES))


def _strip_once(text: Column) -> Column:
    """The same; mostly what is left without blanks has no other white space at its ends, which is quickly seen."""

    def ends(bare: Column) -> Column:
        inked = F.left(bare, F.lit(1)).between("!", "~") & F.right(bare, F.lit(1)).between("!", "~")
        return F.when(inked, bare).otherwise(strip_text(bare))

    return _let(F.trim(text), ends)


def trim_spaces(text: Column) -> Column:
    """Drop blanks only: a tab at the end stays."""
    return F.trim(text)


def first_word(text: Column) -> Column:
    """Text before the first blank."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def resolve_url(base: str, href: Column) -> Column:
    """Put ``base`` before a link that starts with ``/``; a missing link is ``''``."""
    link = F.coalesce(href, F.lit(""))
    return F.when(link.startswith("/"), F.concat(F.lit(base), link)).otherwise(link)


def _code_point(digits: Column, base: int) -> Column:
    """The character with this number; U+FFFD if there is none."""

    def character(number: Column) -> Column:
        real = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        hexed = F.lpad(F.hex(F.when(real, number).otherwise(ord(REPLACEMENT))), 8, "0")
        return F.decode(F.unhex(hexed), "UTF-32")

    def number(bare: Column) -> Column:
        return F.when(F.length(bare) <= 7, F.conv(bare, base, 10).cast("bigint"))

    return _let(_let(F.regexp_replace(digits, "^0+", ""), number), character)


_CLOSED = r"^&([A-Za-z][A-Za-z0-9]*;)"
_LEGACY = rf"^&({'|'.join(sorted(LEGACY_REFERENCES, key=len, reverse=True))})"
_DECIMAL = r"^&#([0-9]+);?"
_HEXADECIMAL = r"^&#[xX]([0-9A-Fa-f]+);?"


# A lookup looks through one slice of the table, a few names, whatever the name.
_SLICES = 512


def _lookup(names: dict[str, str], name: Column) -> Column:
    """The text of a name, null if there is none; the table is one literal, so that plans stay small."""
    slices: list[dict[str, str]] = [{} for _ in range(_SLICES)]
    for key, text in names.items():
        slices[crc32(key.encode()) % _SLICES][key] = text
    table = F.from_json(F.lit(json.dumps(slices)), "array<map<string,string>>")
    return F.try_element_at(F.get(table, F.crc32(name.cast("binary")) % _SLICES), name)


def _decode_piece(piece: Column) -> Column:
    """One piece of text that holds at most one reference, at its start."""

    def first(pattern: str, use: Callable[[Column], Column]) -> Column:
        return _let(F.regexp_extract(piece, pattern, 1), use)

    def hexadecimal(digits: Column) -> Column:
        return F.when(digits != "", F.concat(_code_point(digits, 16), F.regexp_replace(piece, _HEXADECIMAL, ""))).otherwise(piece)

    def decimal(digits: Column) -> Column:
        found = F.concat(_code_point(digits, 10), F.regexp_replace(piece, _DECIMAL, ""))
        return F.when(digits != "", found).otherwise(first(_HEXADECIMAL, hexadecimal))

    def legacy(name: Column) -> Column:
        found = F.concat(_lookup(LEGACY_REFERENCES, name), F.substr(piece, F.length(name) + 2))
        return F.when(name != "", found).otherwise(piece)

    def closed(name: Column) -> Column:
        def known(text: Column) -> Column:
            found = F.concat(text, F.substr(piece, F.length(name) + 2))
            return F.when(text.isNotNull(), found).otherwise(first(_LEGACY, legacy))

        return _let(_lookup(REFERENCES, name), known)

    return (
        F.when(~piece.startswith("&"), piece)
        .when(piece.startswith("&#"), first(_DECIMAL, decimal))
        .otherwise(first(_CLOSED, closed))
    )


def decode_references(text: Column) -> Column:
    """Replace character references, each one once."""
    pieces = F.transform(F.split(text, "(?=&)"), _decode_piece)
    # Mostly there is none, or all are the one that links are full of.
    plain = ~text.rlike("&(?!amp;)")
    return (
        F.when(~text.contains("&"), text)
        .when(plain, F.replace(text, F.lit("&amp;"), F.lit("&")))
        .otherwise(F.array_join(pieces, ""))
    )


def drop_hidden(html: Column) -> Column:
    """Remove comments, scripts, styles and the mark character: none is page text."""
    unmarked = F.when(html.contains(MARK), F.replace(html, F.lit(MARK), F.lit(""))).otherwise(html)
    return F.regexp_replace(unmarked, _HIDDEN, "")


def element_text(inner: Column) -> Column:
    """Visible text: every text piece between tags is stripped, then joined."""
    pieces = F.split(F.regexp_replace(inner, ANY_TAG, MARK), MARK)
    joined = F.array_join(F.transform(pieces, lambda p: _strip_once(decode_references(p))), "")
    # Most fields have no tags inside.
    return F.when(inner.contains("<"), joined).otherwise(_strip_once(decode_references(inner)))
