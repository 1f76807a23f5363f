"""Visible text and links of an HTML string as column expressions."""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

HIDDEN = r"<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
HIDDEN_PATTERN = rf"(?is){HIDDEN}"
# Attribute values are skipped whole, so that a > inside quotes does not end a tag; with an odd quote the first > does.
MARKUP_PATTERN = rf"""(?is){HIDDEN}|<[a-z/!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[a-z/!?][^>]*>"""
# Names with a closing semicolon, and the older ones that may stand without it, longest first.
ENTITIES = {name.removesuffix(";"): text for name, text in html5.items() if name.endswith(";")}
OPEN_ENTITIES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
ANCHOR_HREF_PATTERN = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _character(code_point: Column) -> Column:
    """The character of a code point; U+FFFD when there is none."""
    valid = code_point.between(1, 0x10FFFF) & ~code_point.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(code_point), 8, "0"))
    return F.when(valid, F.decode(utf32, "UTF-32")).otherwise(F.lit("�"))


def _decode_piece(piece: Column) -> Column:
    """Decode the entity at the start of a piece that followed an ampersand."""
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
    decimal = F.regexp_extract(piece, r"^#([0-9]{1,9});?", 1)
    hexadecimal = F.regexp_extract(piece, r"^#[xX]([0-9a-fA-F]{1,8});?", 1)
    closed = F.regexp_extract(piece, r"^([a-zA-Z][a-zA-Z0-9]*);", 1)
    opened = F.regexp_extract(piece, f"^({'|'.join(OPEN_ENTITIES)})", 1)
    rest = F.regexp_replace(piece, r"^#(?:[0-9]{1,9}|[xX][0-9a-fA-F]{1,8});?", "")
    return (
        F.when(decimal != "", F.concat(_character(decimal.cast("bigint")), rest))
        .when(hexadecimal != "", F.concat(_character(F.conv(hexadecimal, 16, 10).cast("bigint")), rest))
        .when(names[closed].isNotNull(), F.concat(names[closed], F.substr(piece, F.length(closed) + 2)))
        .when(opened != "", F.concat(names[opened], F.substr(piece, F.length(opened) + 1)))
        .otherwise(F.concat(F.lit("&"), piece))
    )


def decode_entities(text: Column) -> Column:
    """Decode numeric and named character references in one left-to-right pass."""
    pieces = F.split(text, "&")
    decoded = F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decode_piece(piece)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def html_text(html: Column) -> Column:
    """Text of a page: comments, scripts, styles and tags become a blank, entities are decoded."""
    return decode_entities(F.regexp_replace(html, MARKUP_PATTERN, " "))


def anchor_hrefs(html: Column) -> Column:
    """``href`` values of all ``<a>`` tags in page order, as an array."""
    visible = F.regexp_replace(html, HIDDEN_PATTERN, " ")
    values = F.regexp_extract_all(visible, F.lit(ANCHOR_HREF_PATTERN), F.lit(1))
    return F.transform(values, lambda v: decode_entities(F.regexp_replace(v, r"""^["']|["']$""", "")))


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.startswith(text, F.lit(p)) for p in prefixes])
