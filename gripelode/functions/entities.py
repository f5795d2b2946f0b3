"""HTML character references decoded by Column expressions, as HTML 5 defines them.

A text is cut at its ampersands; what follows each of them is decoded once: numeric references by arithmetic, names by the
full named table, and a name without its semicolon by the longest of the old names that it begins with. Nothing is decoded
twice, and no row leaves the JVM.
"""

from __future__ import annotations

import json
import re
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that nearly all texts use come first: a map literal is looked through in order.
FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "middot;", "copy;", "mdash;", "ndash;", "hellip;", "rsquo;")
REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
LAST = 0x10FFFF


@cache
def _names() -> str:
    """The named table as JSON: the library's own, with the frequent names in front."""
    order = [*FREQUENT, *(n for n in html5 if n not in FREQUENT)]
    return json.dumps({n: html5[n] for n in order})


@cache
def _old_names() -> str:
    """A pattern of the names that need no semicolon, longest first."""
    found = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return "^(?:" + "|".join(map(re.escape, found)) + ")"


@cache
def _replaced() -> str:
    """Numbers that stand for another character: zero, the carriage return, and 128 to 159 as in code page 1252."""
    table = {0: "�", 13: "\r"}
    for n in range(0x80, 0xA0):
        try:
            table[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            table[n] = chr(n)
    return json.dumps({str(n): c for n, c in table.items()})


def _map(text: str) -> Column:
    return F.from_json(F.lit(text), "map<string,string>")


def _character(number: Column) -> Column:
    """The character of a code point; none for those that HTML leaves out."""
    control = number.between(1, 8) | (number == 11) | number.between(14, 31) | (number == 127)
    no_character = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    known = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return (
        F.when(number.between(0xD800, 0xDFFF) | (number > LAST), "�")
        .when(control | no_character, "").otherwise(known)
    )


def _numeric(reference: Column) -> Column:
    digits = F.regexp_replace(F.rtrim(F.substring(reference, 2, 100_000_000), F.lit(";")), "^[xX]?0*", "")
    hexadecimal = F.substring(reference, 2, 1).isin("x", "X")
    # More digits than the last code point has are beyond it, however many there are.
    long = F.length(digits) > 7
    value = F.when(long, LAST + 1).otherwise(F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("long"))
    decimal = F.when(long, LAST + 1).otherwise(F.concat(F.lit("0"), digits).cast("long"))
    number = F.when(hexadecimal, value).otherwise(decimal)
    return F.get(F.transform(F.array(number), lambda n: F.coalesce(F.element_at(_map(_replaced()), n.cast("string")), _character(n))), F.lit(0))


def _named(reference: Column) -> Column:
    prefix = F.regexp_extract(reference, _old_names(), 0)
    rest = F.substring(reference, F.length(prefix) + 1, F.length(reference))
    names = _map(_names())
    return F.coalesce(F.element_at(names, reference), F.when(prefix != "", F.concat(F.element_at(names, prefix), rest)), F.concat(F.lit("&"), reference))


def _decoded(piece: Column) -> Column:
    """What follows an ampersand, with the reference at its start decoded."""
    def whole(reference: Column) -> Column:
        rest = F.substring(piece, F.length(reference) + 1, F.length(piece))
        told = F.when(reference == "", "&").when(reference.startswith("#"), _numeric(reference)).otherwise(_named(reference))
        return F.concat(told, rest)

    return F.get(F.transform(F.array(F.regexp_extract(piece, REFERENCE, 0)), whole), F.lit(0))


def unescape(c: Column) -> Column:
    """The text with all character references decoded; null stays null."""
    def decode(t: Column) -> Column:
        pieces = F.transform(F.split(t, "&", -1), lambda p, i: F.when(i == 0, p).otherwise(_decoded(p)))
        return F.when(t.contains("&"), F.array_join(pieces, "")).otherwise(t)

    return F.get(F.transform(F.array(c), decode), F.lit(0))
