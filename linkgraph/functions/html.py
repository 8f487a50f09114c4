"""Anchors of an HTML text as column expressions."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, functions as F

# Elements whose content is text, never markup.
TEXT_ELEMENTS = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")

# One token of markup at a time: a comment, a text element with its content, an anchor with an href, any other
# tag, another declaration. Whichever opens first is taken whole, so nothing inside it is taken for markup.
# Every repetition is possessive: the engine neither goes back nor recurses, whatever the number of attributes.
BLANK = r"[ \t\n\f\r]"
_PARTED = rf"[ \t\n\f\r/]*+"
_NAME = r"(?:=[^ \t\n\f\r/>=]*+|[^ \t\n\f\r/>=]++)"
_VALUE = r"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+|(?=>)|\z)"""
_ATTRIBUTE = rf"(?:{_PARTED}{_NAME}(?:{BLANK}*+={BLANK}*+{_VALUE})?+)"
_HREF_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+|(?=>))"""
_HREF = rf"(href(?:{BLANK}*+={BLANK}*+{_HREF_VALUE}|(?![^ \t\n\f\r/>])(?!{BLANK}*+=)))"
_BEFORE_HREF = rf"(?:(?!{_PARTED}href(?:[ \t\n\f\r/>=]|\z)){_ATTRIBUTE})*+"
_REST = rf"{_ATTRIBUTE}*+{_PARTED}"
TOKEN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
    rf"|<({'|'.join(TEXT_ELEMENTS)})(?=[ \t\n\f\r/>]){_REST}>.*?(?=</\1[ \t\n\f\r/>]|\z)"
    rf"|<a(?=[ \t\n\f\r/]){_BEFORE_HREF}{_PARTED}{_HREF}{_REST}>"
    rf"|</?+[a-z][^ \t\n\f\r/>]*+{_REST}>?+"
    r"|<[!?/][^>]*+")

NUMERIC = r"^#(?:[0-9]+|[xX][0-9A-Fa-f]+);?"
NAMED = r"^[A-Za-z][A-Za-z0-9]*;?"
REPLACEMENT = "�"
# Characters that the numbers 128 to 159 stand for, as the standard has it.
NUMBERS_FROM_128 = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0))
# Looked up before the whole table.
COMMON = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;")


def _named_reference(name: Column) -> Column:
    """The characters of a reference, by the table of the HTML standard; NULL for an unknown name."""
    table = html.entities.html5
    mark = "\x01"
    whole = F.map_from_arrays(F.split(F.lit(mark.join(table)), mark), F.split(F.lit(mark.join(table.values())), mark))
    found = F.when(name == "", None)
    for common in COMMON:
        found = found.when(name == common, table[common])
    return found.otherwise(F.try_element_at(whole, name))


def _numeric_reference(reference: Column) -> Column:
    """The character of a numeric reference of any length."""
    digits = F.regexp_extract(reference, "^#[xX]?0*([0-9A-Fa-f]*)", 1)
    number = F.when(F.length(digits) > 7, 0x110000).when(digits == "", 0).when(
        F.lower(F.substr(reference, F.lit(2), F.lit(1))) == "x", F.conv(digits, 16, 10).cast("bigint")).otherwise(
        digits.cast("bigint"))
    bad = (number == 0) | (number >= 0x110000) | number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(number)), 8, "0")), "UTF-32")
    early = F.substr(F.lit(NUMBERS_FROM_128), (number - 127).cast("int"), F.lit(1))
    return F.when(number.between(0x80, 0x9F), early).otherwise(char)


def _decode_piece(piece: Column) -> Column:
    """A piece of text that stood behind an ampersand, with the reference it starts with decoded."""
    number = F.regexp_extract(piece, NUMERIC, 0)
    name = F.regexp_extract(piece, NAMED, 0)
    after = F.substr(piece, F.length(name) + 1, F.lit(1))
    char = F.when(name.endswith(";") | (after != "="), _named_reference(name))
    return (F.when(number != "", F.concat(_numeric_reference(number), F.substr(piece, F.length(number) + 1)))
            .when(char.isNotNull(), F.concat(char, F.substr(piece, F.length(name) + 1)))
            .otherwise(F.concat(F.lit("&"), piece)))


def decode_references(text: Column) -> Column:
    """Decode all character references of an attribute value, each of them once."""
    pieces = F.split(text, "&")
    decoded = F.concat(F.get(pieces, F.lit(0)), F.array_join(
        F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), _decode_piece), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _value(attribute: Column) -> Column:
    value = F.regexp_replace(attribute, rf"(?i)^href(?:{BLANK}*={BLANK}*)?", "")
    quoted = value.startswith('"') | value.startswith("'")
    return F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def anchor_hrefs(html: Column) -> Column:
    """The ``href`` of every anchor, in document order and with repeats."""
    found = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(2))
    attributes = F.filter(found, lambda attribute: attribute != "")
    return F.transform(F.transform(attributes, _value), decode_references)
