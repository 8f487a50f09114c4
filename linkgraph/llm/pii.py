"""Personal data in whole texts, also where it is disguised, with spans in the source text.

Plain identifiers are found by patterns. Disguised ones are found in a normalised copy of the text that a chain
of transducers makes: look-alike characters, at and dot in words or brackets, spelled digits. Each transducer
carries, for every character it writes, the span of source characters it came from, so a match in the copy is
reported as a span of the source. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from linkgraph.llm.batches import long_texts

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,added:boolean>>"

# Patterns of the plain identifiers.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
DOTTED = re.compile(r"[0-9]\.[0-9]")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones, and characters that show nothing.
LOOKALIKES = dict(zip("асеоріхуѕјһԁԛԝкмтвнАВЕКМНОРСТХУІЈЅαοερτυνιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                      "aceopixysjhdqwkmtbhABEKMHOPCTXYIJSaoeptuviABEZHIKMNOPTYX"))
STYLED = 0x1D400, 0x1D800  # letters and digits in mathematical styles
INVISIBLE = "­​‌‍⁠﻿"
DIGIT_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
               "seven": "7", "eight": "8", "nine": "9"}
SIGNS = {"at": "@", "dot": "."}

BRACKETED = re.compile(r"[\[({<]\s*(at|dot)\s*[\])}>]\s*", re.IGNORECASE)
SPOKEN = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?:\s+at\s+|@)[A-Za-z0-9-]+"
                    r"(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
SPOKEN_PART = re.compile(r"\s+(at|dot)\s+", re.IGNORECASE)
SPELLED_WORD = re.compile(r"\b(?:" + "|".join(DIGIT_WORDS) + r")\b", re.IGNORECASE)
SPELLED_GAPS = {"": "", "-": "", ",": "", ".": ".", "dot": ".", "point": "."}
MIN_SPELLED = 4  # digit words in a row that count as a number
# Last labels of spoken addresses; labels that are words of running text are not among them.
SPOKEN_ENDS = frozenset("com org net edu gov mil info biz io dev app ai eu uk de fr es nl ch pl cz se fi dk pt br "
                        "ru ua jp cn kr au nz ca us mx ar cl".split())
# Quick tests, on the lower-cased text, for whether a transducer has anything to do.
BRACKETS = "[({<"
DIGIT_ENDS = {word: tuple(word + sign for sign in " -.,\n") for word in DIGIT_WORDS}
_cache: dict = {}


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from their at signs, in time linear in the text."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last:  # back over the local part, a stretch at a time
            begin = max(last, start - 64)
            run = LOCAL_END.search(text[begin:start])
            stretch = start - begin - run.start()
            start -= stretch
            if stretch < 64:
                break
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            found.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return found


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Undisguised identifiers: leftmost matches of each kind that do not overlap, checked after matching."""
    found = [("email", *span) for span in _emails(text)]
    if DOTTED.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return found


class Traced:
    """A text with, for each character, the source span it stands for and whether it was rewritten."""

    def __init__(self, text: str, start=None, end=None, new=None):
        self.text, self.start, self.end, self.new = text, start, end, new

    def rewrite(self, edits: list[tuple[int, int, str]]) -> "Traced":
        """Replace each (start, end) of the current text; edits are in order and do not overlap."""
        if not edits:
            return self
        size = len(self.text)
        if self.new is None:
            self.start, self.end = np.arange(size), np.arange(1, size + 1)
            self.new = np.zeros(size, dtype=bool)
        text, start, end, new, at = [], [], [], [], 0
        for a, b, by in edits:
            text += [self.text[at:a], by]
            start += [self.start[at:a], np.full(len(by), self.start[a])]
            end += [self.end[at:a], np.full(len(by), self.end[b - 1])]
            new += [self.new[at:a], np.ones(len(by), dtype=bool)]
            at = b
        parts = [np.concatenate([*made, kept[at:]])
                 for made, kept in ((start, self.start), (end, self.end), (new, self.new))]
        return Traced("".join(text) + self.text[at:], *parts)


def _folds() -> tuple[re.Pattern, dict[str, str]]:
    """Characters that stand for one ASCII character: compatibility forms, look-alikes, other blanks."""
    if "folds" not in _cache:
        table = {}
        for code in (*range(0xA0, 0x10000), *range(*STYLED)):
            char = chr(code)
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and " " <= plain <= "~":
                table[char] = plain
            elif char.isdecimal():
                table[char] = str(unicodedata.decimal(char))
        table |= LOOKALIKES | dict.fromkeys(INVISIBLE, "")
        near = "".join(re.escape(char) for char in table if ord(char) < STYLED[0])
        _cache["folds"] = re.compile(f"[{near}{chr(STYLED[0])}-{chr(STYLED[1] - 1)}]"), table
    return _cache["folds"]


def _bracketed(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in BRACKETED.finditer(text):
        start = m.start()
        while start > (edits[-1][1] if edits else 0) and text[start - 1].isspace():
            start -= 1
        edits.append((start, m.end(), SIGNS[m.group(1).lower()]))
    return edits


def _spoken(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in SPOKEN.finditer(text):
        parts = [(p.start() + m.start(), p.end() + m.start(), p.group(1).lower())
                 for p in SPOKEN_PART.finditer(m.group())]
        last = m.group()[parts[-1][1] - m.start():].lower() if parts else ""
        if parts and parts[-1][2] == "dot" and last in SPOKEN_ENDS:  # else "at" and "dot" are ordinary words
            edits += [(a, b, SIGNS[word]) for a, b, word in parts]
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Runs of digit words become digits; "plus" before a run and signs within it are kept as signs."""
    edits, run = [], []
    for m in (*SPELLED_WORD.finditer(text), None):
        gap = text[run[-1].end():m.start()] if m and run else None
        by = SPELLED_GAPS.get(gap.strip(" \t\r\n").lower()) if gap else None
        if run and by is None:  # the run ends here
            if len(run) >= MIN_SPELLED:
                first = run[0].start()
                before = text[max(0, first - 5):first]
                if re.fullmatch(r"plus[\s-]", before, re.IGNORECASE):
                    edits.append((first - 5, first, "+"))
                for word, following in zip(run, [*run[1:], None]):
                    edits.append((word.start(), word.end(), DIGIT_WORDS[word.group().lower()]))
                    if following:
                        between = text[word.end():following.start()].strip(" \t\r\n").lower()
                        edits.append((word.end(), following.start(), SPELLED_GAPS[between]))
            run = []
        if m:
            run.append(m)
    return edits


def normalised(text: str) -> Traced:
    """The text after all transducers: characters, signs in brackets, signs as words, digits as words."""
    out = Traced(text)
    if not text.isascii():
        pattern, table = _folds()
        out = out.rewrite([(m.start(), m.end(), table.get(m.group(), m.group())) for m in pattern.finditer(text)])
    if any(sign in out.text for sign in BRACKETS):
        out = out.rewrite(_bracketed(out.text))
    low = out.text.lower()
    if "dot" in low:
        out = out.rewrite(_spoken(out.text))
    if any(word in low and any(end in low for end in ends) for word, ends in DIGIT_ENDS.items()):
        out = out.rewrite(_spelled(out.text))
    return out


def all_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """Plain spans, then what shows only after normalising, by kind and start; ``added`` marks the latter."""
    text = text or ""
    plain = plain_spans(text)
    found = [(*span, False) for span in plain]
    copy = normalised(text)
    if copy.new is not None:
        seen = set(plain)
        for kind, a, b in plain_spans(copy.text):
            span = kind, int(copy.start[a]), int(copy.end[b - 1])
            if not copy.new[a:b].any() and span[2] - span[1] == b - a:
                continue  # as in the source
            covered = any(k == kind and s <= span[1] and span[2] <= e for k, s, e in plain)
            if span not in seen and not covered:
                seen.add(span)
                found.append((*span, True))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def redacted(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _spans_of(text: pd.Series) -> pd.Series:
    names = ("kind", "start", "end", "added")
    return pd.Series([[dict(zip(names, span)) for span in all_spans(value)] for value in text])


def _redacted(text: pd.Series) -> pd.Series:
    return pd.Series([redacted(value, all_spans(value)) for value in text], dtype=object)


def personal_spans(text: Column | str) -> Column:
    """All identifiers of a text, by kind and start; none for a null or empty text."""
    return F.pandas_udf(_spans_of, SPANS)(text)


def with_personal_spans(docs: DataFrame, text_col: str = "text", out_col: str = "personal") -> DataFrame:
    """``docs`` with the identifiers of each text; rows and other columns stay as they are.

    A column that is already called ``out_col`` is replaced. Repeated rows each get their own result.
    """
    return long_texts(docs).withColumn(out_col, personal_spans(F.col(text_col)))


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with identifiers replaced in the text; a column of text lengths follows, null texts stay null."""
    out = long_texts(docs).withColumn(text_col, F.pandas_udf(_redacted, "string")(F.col(text_col)))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.coalesce(F.length(text_col).cast(kind), F.col(length_col))
        out = out.withColumn(length_col, length)
    return out


def _is_kind(kind: str):
    return lambda span: F.when(span["kind"] == kind, True)


def joined_spans(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def span_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the counts and the hash of the plain identifiers, and all spans as text."""
    found = long_texts(docs).select(id_col, personal_spans(F.col(text_col)).alias("personal"))
    plain = F.filter("personal", lambda s: ~s["added"])
    counts = [F.size(F.array_compact(F.transform(plain, _is_kind(kind)))).cast("bigint").alias(f"n_{kind}")
              for kind in KINDS]
    return found.select(
        id_col, *counts, F.sha2(joined_spans(plain), 256).alias("base_sha256"),
        joined_spans(F.col("personal")).alias("spans"),
        F.size(F.filter("personal", lambda s: s["added"])).cast("bigint").alias("n_added"))
