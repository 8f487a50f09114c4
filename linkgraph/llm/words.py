"""Words of whole texts as 64-bit hashes, computed on bytes with numpy inside tasks.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased first. UTF-8 never uses these
bytes inside a character, so bytes and characters give the same words. Equal words have equal hashes; two
different words of one text share a hash with a chance of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes hashed at a time, so that a very long text needs no more memory than this many positions.
PIECE = 1 << 17

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_SPACES = (0x20, *range(0x09, 0x0E))
_cache: dict = {}


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    out = np.array(values, dtype=np.uint64)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        out ^= out >> np.uint64(shift)
        out *= np.uint64(factor)
    out ^= out >> np.uint64(33)
    return out


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: lower case, whether it parts words, a 64-bit value."""
    if "bytes" not in _cache:
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        space = np.zeros(256, dtype=bool)
        space[list(_SPACES)] = True
        _cache["bytes"] = lower, space, mix(np.arange(1, 257, dtype=np.uint64))
    return _cache["bytes"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if "powers" not in _cache or len(_cache["powers"][0]) < n:
        size = max(n, 1 << 12)
        inverse = pow(_BASE, -1, 1 << 64)
        made = []
        for base in (_BASE, inverse):
            factors = np.full(size, base & _MASK, dtype=np.uint64)
            factors[0] = 1
            made.append(np.multiply.accumulate(factors))
        _cache["powers"] = tuple(made)
    return _cache["powers"]


def lowered(text: bytes | None) -> np.ndarray:
    """The bytes of a text, A-Z in lower case; a missing text is empty."""
    lower, _, _ = _byte_tables()
    return lower[np.frombuffer(text or b"", dtype=np.uint8)]


def _piece_hashes(data: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Hashes of the words of one piece, in order."""
    _, _, values = _byte_tables()
    edges = np.flatnonzero(np.diff(np.concatenate(([True], apart, [True])).view(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    powers, inverses = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers[:len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverses[starts]
    return mix(hashes + (ends - starts).astype(np.uint64))


def hash_words(data: np.ndarray, apart_table: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the words of lower-cased bytes, in order, repeats included.

    ``apart_table`` says of each byte whether it parts words (default: white space). Long texts are cut at
    such bytes into pieces; a single word longer than a piece makes its piece longer.
    """
    table = _byte_tables()[1] if apart_table is None else apart_table
    if len(data) <= PIECE:
        return _piece_hashes(data, table[data])
    found, start = [], 0
    while start < len(data):
        end = start + PIECE
        while end < len(data):
            gaps = np.flatnonzero(table[data[end:end + PIECE]])
            if len(gaps):
                end += int(gaps[0])
                break
            end += PIECE
        piece = data[start:end]
        found.append(_piece_hashes(piece, table[piece]))
        start = end
    return np.concatenate(found)


def letters_apart() -> np.ndarray:
    """A table for words made of letters, digits and bytes of characters beyond ASCII only."""
    if "letters" not in _cache:
        apart = np.ones(256, dtype=bool)
        apart[128:] = False
        apart[48:58] = apart[97:123] = False
        _cache["letters"] = apart
    return _cache["letters"]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row; a shorter text gives its whole sequence as one."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for place in range(width):
        total = mix(total + words[place:len(words) - width + 1 + place])
    return np.unique(total)


def binary(column: pa.Array) -> pa.Array:
    """A string column as bytes, without decoding."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())


def texts(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a string column as bytes, one at a time."""
    for value in binary(column):
        yield value.as_py()
