"""Text helpers shared by the readers, the page transforms and the robots parser."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters cut from both ends of bodies and tokens.
BLANKS = "".join(chr(code) for code in range(0x21))


def strip_blanks(text: Column) -> Column:
    """Cut characters up to U+0020 from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def normalise_body(text: Column) -> Column:
    """Join the lines of a body by a plain newline and strip blanks from both ends."""
    lines = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return strip_blanks(lines)


def format_list(items: Column) -> Column:
    """``[a, b, c]``, the text form of a link list."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def parse_list(text: Column) -> Column:
    """Read the text form back: what lies between the first ``[`` and the last ``]``, cut at commas.

    Items are trimmed and empty ones dropped; text without brackets gives an empty list.
    """
    inner = F.regexp_extract(text, r"(?s)\[(.*)\]", 1)
    items = F.transform(F.split(inner, ","), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")
