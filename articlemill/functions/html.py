"""Extraction from raw HTML with native Spark expressions.

These cover elements that do not nest in themselves. General selectors run in
`articlemill.operators.selectors`.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from articlemill.functions.text import squeeze

BLANK = "[ \\t\\r\\n]"
# The rest of a tag up to its end: a `>` inside a quoted value does not end it. The group
# repeats once per quoted value, so long tags cause no deep recursion.
REST = "[^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*"
NOISE = f"(?is)<!--.*?-->|<script(?:{BLANK}{REST})?>.*?</script{BLANK}*>|<style(?:{BLANK}{REST})?>.*?</style{BLANK}*>"
INLINE_TAG = (
    f"(?i)</?(?:a|abbr|b|cite|code|em|font|i|mark|q|s|small|span|strong|sub|sup|u)(?:{BLANK}{REST})?>"
)
ANY_TAG = f"</?[A-Za-z!?]{REST}>"
# A name, and its value if it has one.
ATTRIBUTE = f"([^ \\t\\r\\n\"'>/=]+)(?:{BLANK}*={BLANK}*(\"[^\"]*\"|'[^']*'|[^ \\t\\r\\n\"'>]+))?"

# A character reference; old names are read without their semicolon too.
REFERENCE = "&(?:#[0-9]{1,8};?|#[xX][0-9A-Fa-f]{1,7};?|[A-Za-z][A-Za-z0-9]{1,30};?)"
SHORTEST, LONGEST_OPEN = 2, max(len(n) for n in html5 if not n.endswith(";"))


def strip_noise(html: Column) -> Column:
    """Drops comments, scripts and style sheets, whose content may look like tags."""
    return F.regexp_replace(html, NOISE, "")


def element_pattern(tag: str, attr: str | None = None, value: str | None = None) -> str:
    """Pattern with the attributes of the first such element as group 1, inside as 2.

    Tag, attribute and value are taken literally.
    """
    tag = re.escape(tag)
    if attr is None:
        return f"(?is)<{tag}((?:{BLANK}{REST})?)>(.*?)</{tag}{BLANK}*>"
    exact = re.escape(value or "")
    wanted = f"{BLANK}{re.escape(attr)}{BLANK}*={BLANK}*(?:\"{exact}\"|'{exact}'|{exact})"
    return f"(?is)<{tag}((?:{wanted}|{BLANK}{REST}{wanted})(?:{BLANK}{REST})?)>(.*?)</{tag}{BLANK}*>"


def has_element(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    return html.rlike(element_pattern(tag, attr, value))


def inner_html(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """Markup inside the first such element; an empty string if there is none."""
    return F.regexp_extract(html, element_pattern(tag, attr, value), 2)


def outer_html(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    return F.regexp_extract(html, element_pattern(tag, attr, value), 0)


def paragraphs(html: Column) -> Column:
    """Markup of every paragraph; one left open ends where the next begins."""
    pieces = F.split(html, f"(?i)<p(?:{BLANK}{REST})?>")
    opened = F.slice(pieces, F.lit(2), F.size(pieces))
    return F.transform(opened, lambda p: F.regexp_replace(p, "(?is)</p[ \\t\\r\\n]*>.*", ""))


#: Parts of the table of names. Spark scans a map from its start, so each part is kept small.
NAME_PARTS = 512


@functools.cache
def _name_table() -> str:
    parts: list[dict[str, str]] = [{} for _ in range(NAME_PARTS)]
    for name, char in html5.items():
        parts[zlib.crc32(name.encode()) % NAME_PARTS][name] = char
    return json.dumps(parts)


def named_references() -> Callable[[Column], Column]:
    """A lookup of names, hashed into a constant of the plan; the list is the standard library's."""
    table = F.from_json(F.lit(_name_table()), "array<map<string,string>>")
    return lambda name: F.element_at(F.get(table, (F.crc32(name.cast("binary")) % NAME_PARTS).cast("int")), name)


#: Numbers 128 to 159 mean characters of an old code page where it has them.
OLD_PAGE = "".join(bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(0x80, 0xA0))


def numbered_reference(reference: Column) -> Column:
    digits = F.regexp_extract(reference, "([0-9A-Fa-f]+);?$", 1)
    number = F.when(reference.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    last = number.bitwiseAND(F.lit(0xFFFF))
    void = number.between(1, 8) | number.between(14, 31) | number.isin(11, 127) | number.between(0xFDD0, 0xFDEF) | (last >= 0xFFFE)
    bad = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    return F.when(bad, "\ufffd").when(number.between(0x80, 0x9F), F.substring(F.lit(OLD_PAGE), (number - 0x7F).cast("int"), F.lit(1))).when(void, "").otherwise(char)


def named_reference(reference: Column, names: Callable[[Column], Column]) -> Column:
    """The whole name, else the longest start of it that stands without a semicolon, else the text itself."""
    name = F.substring(reference, F.lit(2), F.length(reference))
    starts = F.transform(F.sequence(F.lit(LONGEST_OPEN), F.lit(SHORTEST), F.lit(-1)), lambda n: F.left(name, n))
    known = F.filter(starts, lambda s: names(s).isNotNull() & ~s.endswith(";"))
    start = F.get(known, F.lit(0))
    cut = F.concat(names(start), F.substring(name, F.length(start) + 1, F.length(name)))
    return F.coalesce(names(name), cut, reference)


def decode_entities(text: Column) -> Column:
    """Character references, each decoded once: the text is cut at them and put together again."""
    names = named_references()

    def decoded(reference: Column) -> Column:
        common = F.when(reference == "&amp;", "&").when(reference == "&lt;", "<").when(reference == "&gt;", ">")
        common = common.when(reference == "&quot;", '"').when(reference == "&nbsp;", "\u00a0")
        return common.when(reference.startswith("&#"), numbered_reference(reference)).otherwise(named_reference(reference, names))

    gaps, found = F.split(text, REFERENCE), F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    pieces = F.zip_with(gaps, found, lambda g, r: F.when(r.isNull(), g).otherwise(F.concat(g, decoded(r))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def markup_text(markup: Column) -> Column:
    """Visible text: inline tags vanish, other tags part words, blanks are squeezed."""
    flat = F.regexp_replace(F.regexp_replace(markup, INLINE_TAG, ""), ANY_TAG, " ")
    return squeeze(decode_entities(flat))


def element_text(html: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    return markup_text(inner_html(html, tag, attr, value))


def document_title(html: Column) -> Column:
    return element_text(html, "title")


def tags(html: Column, tag: str) -> Column:
    """Attribute text of every opening tag of that name, in document order."""
    return F.regexp_extract_all(html, F.lit(f"(?is)<{re.escape(tag)}((?:{BLANK}{REST})?)>"), F.lit(1))


def unquoted(value: Column) -> Column:
    return F.regexp_replace(value, "^[\"']|[\"']$", "")


def _names_and_values(attr_text: Column) -> tuple[Column, Column]:
    names = F.transform(F.regexp_extract_all(attr_text, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
    return names, F.regexp_extract_all(attr_text, F.lit(ATTRIBUTE), F.lit(2))


def attribute(attr_text: Column, name: str) -> Column:
    """Value of an attribute, empty if it has none, null where it is absent."""
    names, values = _names_and_values(attr_text)
    place = F.array_position(names, name.lower())
    return F.when(place > 0, decode_entities(unquoted(F.get(values, (place - 1).cast("int")))))


def attributes(attr_text: Column) -> Column:
    """Map of lowercase attribute names to values, the first of a repeated name kept."""
    names, values = _names_and_values(attr_text)
    unique = F.array_distinct(names)
    first = F.transform(
        unique,
        lambda n: decode_entities(
            unquoted(F.get(values, (F.array_position(names, n) - 1).cast("int")))
        ),
    )
    return F.map_from_arrays(unique, first)


def link_targets(html: Column) -> Column:
    """`href` of every link that has one, in document order, not resolved."""
    targets = F.transform(tags(html, "a"), lambda t: attribute(t, "href"))
    return F.filter(targets, lambda t: t.isNotNull())
