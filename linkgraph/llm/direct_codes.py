"""Directly addressable codes: numbers in chunks by level, any of them read without decoding others.

A number is cut into chunks of some bits, the lowest first. Level 0 holds the first chunk of every number and
a bit that says whether the number goes on; level 1 holds the second chunks of those that do, and so on. The
place of a number in the next level is the count of set bits before its own, which a rank directory gives in
constant time (Brisaboa, Ladra and Navarro, DACs: Bringing Direct Access to Variable-Length Codes, 2013).
Numbers in a row are in a row on every level, so a range is read with one rank for each level.

A segment is one run of bytes, little-endian throughout:

    magic "DAC1", uint32 levels, then int64: part, number in the part, first id in the part, documents, ids,
    bytes of the segment
    documents: int64 ids, uint8 whether the id is known, int64 place of the first number, one more for the end
    for each level: int64 bits of a chunk, int64 chunks; chunks by half-bytes; bitmap in words of 64 bits;
    uint32 set bits before each 512 bits of the bitmap

Every array is padded to eight bytes. The last level has no bitmap.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

MAGIC = b"DAC1"
HEADER = "<4sI6q"
LEVEL = "<2q"
STEP = 4  # chunks have a multiple of so many bits
MAX_BITS = 32
RANK_BITS = 512  # bits of a bitmap for each entry of its rank directory


def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def chunk_bits(values: np.ndarray) -> list[int]:
    """The bits of each level that make these numbers smallest, bitmaps included."""
    steps = MAX_BITS // STEP
    # longer[k]: numbers that need more than k steps
    longer = [int((values >> np.uint64(STEP * k)).astype(bool).sum()) if k else len(values) for k in range(steps)]
    most = max([1, *(k + 1 for k in range(1, steps) if longer[k])])
    best = {most: (0, [])}
    for at in range(most - 1, -1, -1):
        ways = []
        for after in range(at + 1, most + 1):
            bits = STEP * (after - at)
            ways.append((longer[at] * (bits + (after < most)) + best[after][0], [bits, *best[after][1]]))
        best[at] = min(ways)
    return best[0][1]


def pack(values: np.ndarray, bits: int) -> bytes:
    """Chunks of a multiple of four bits in a row."""
    if bits == 8:
        return values.astype(np.uint8).tobytes()
    parts = np.empty((len(values), bits // STEP), dtype=np.uint8)
    for k in range(bits // STEP):
        parts[:, k] = (values >> np.uint64(STEP * k)) & np.uint64(15)
    flat = parts.ravel()
    if len(flat) % 2:
        flat = np.append(flat, np.uint8(0))
    return (flat[0::2] | (flat[1::2] << 4)).tobytes()


def unpack(data: np.ndarray, bits: int, start: int, end: int) -> np.ndarray:
    """Chunks ``start`` to ``end`` of packed bytes."""
    if bits == 8:
        return data[start:end].astype(np.uint32)
    each = bits // STEP
    low, high = start * each, end * each
    taken = data[low // 2:-(-high // 2)]
    flat = np.empty(2 * len(taken), dtype=np.uint8)
    flat[0::2], flat[1::2] = taken & 15, taken >> 4
    parts = flat[low % 2:low % 2 + high - low].reshape(end - start, each)
    out = np.zeros(end - start, dtype=np.uint32)
    for k in range(each):
        out |= parts[:, k].astype(np.uint32) << np.uint32(STEP * k)
    return out


def encode_segment(values: np.ndarray, doc_ids: list[int | None], offsets: list[int], part: int = 0,
                   number: int = 0, first: int = 0) -> bytes:
    """Numbers below 2^32 as a segment; document k has numbers ``offsets[k]`` to ``offsets[k + 1]``."""
    left = np.asarray(values, dtype=np.uint64)
    widths = chunk_bits(left)
    body = [_padded(np.array([0 if i is None else i for i in doc_ids], dtype="<i8").tobytes()),
            _padded(np.array([i is not None for i in doc_ids], dtype=np.uint8).tobytes()),
            np.array(offsets, dtype="<i8").tobytes()]
    for level, bits in enumerate(widths):
        body += [struct.pack(LEVEL, bits, len(left)), _padded(pack(left & np.uint64((1 << bits) - 1), bits))]
        if level + 1 < len(widths):
            rest = left >> np.uint64(bits)
            goes_on = rest.astype(bool)
            bitmap = _padded(np.packbits(goes_on, bitorder="little").tobytes())
            ones = np.bitwise_count(np.frombuffer(bitmap, dtype="<u8")).astype(np.int64)
            before = np.concatenate(([0], np.cumsum(ones)))[:-1:RANK_BITS // 64]
            body += [bitmap, _padded(before.astype("<u4").tobytes())]
            left = rest[goes_on]
    data = b"".join(body)
    return struct.pack(HEADER, MAGIC, len(widths), part, number, first, len(doc_ids), len(values),
                       struct.calcsize(HEADER) + len(data)) + data


class Segment:
    """A segment in a buffer; nothing is decoded until it is asked for."""

    def __init__(self, buffer: bytes, at: int = 0):
        self.data = np.frombuffer(buffer, dtype=np.uint8)
        magic, levels, self.part, self.number, self.first, docs, self.ids, self.size = struct.unpack_from(
            HEADER, buffer, at)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self._at = at + struct.calcsize(HEADER)
        ids, known = self._array("<i8", docs), self._array("u1", docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.offsets = self._array("<i8", docs + 1)
        self.levels = []
        for level in range(levels):
            bits, n = struct.unpack_from(LEVEL, buffer, self._at)
            self._at += struct.calcsize(LEVEL)
            chunks = self._array("u1", -(-n * bits // 8))
            bitmap = ranks = None
            if level + 1 < levels:
                words = -(-n // 64)
                bitmap, ranks = self._array("<u8", words), self._array("<u4", -(-words * 64 // RANK_BITS))
            self.levels.append((bits, chunks, bitmap, ranks))

    def _array(self, kind: str, n: int) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        found = self.data[self._at:self._at + size].view(kind)
        self._at += size + -size % 8
        return found

    @staticmethod
    def _rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before bit ``i``."""
        word, bit = divmod(i, 64)
        block = i // RANK_BITS
        if block == len(ranks):  # the end of a bitmap that fills its last block
            block -= 1
        first = block * (RANK_BITS // 64)
        count = int(ranks[block]) + int(np.bitwise_count(bitmap[first:word]).sum())
        return count + (int(bitmap[word]) & ((1 << bit) - 1)).bit_count() if bit else count

    def get(self, i: int) -> int:
        """The number at place ``i``: a chunk, a bit and a rank on each of its levels."""
        value = shift = 0
        for bits, chunks, bitmap, ranks in self.levels:
            value |= int(unpack(chunks, bits, i, i + 1)[0]) << shift
            if bitmap is None or not int(bitmap[i // 64]) >> (i % 64) & 1:
                break
            i, shift = self._rank(bitmap, ranks, i), shift + bits
        return value

    def range(self, start: int, end: int) -> np.ndarray:
        """The numbers at places ``start`` to ``end`` (32 bits each)."""
        out = np.zeros(max(0, end - start), dtype="<u4")
        places, shift = None, 0
        for bits, chunks, bitmap, ranks in self.levels:
            if start >= end:
                break
            found = unpack(chunks, bits, start, end)
            if places is None:
                out |= found
            else:
                out[places] |= found << np.uint32(shift)
            if bitmap is None:
                break
            words = bitmap[start // 64:-(-end // 64)]
            flags = np.unpackbits(words.view(np.uint8), bitorder="little")[start % 64:start % 64 + end - start]
            goes_on = np.flatnonzero(flags)
            places = goes_on if places is None else places[goes_on]
            start = self._rank(bitmap, ranks, start)
            end, shift = start + len(goes_on), shift + bits
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Id, place in the segment and numbers of every document."""
        for k, doc_id in enumerate(self.doc_ids):
            start, end = int(self.offsets[k]), int(self.offsets[k + 1])
            yield doc_id, start, self.range(start, end)


def segments(buffer: bytes, separator: int = 1) -> Iterator[Segment]:
    """The segments of a file, which are parted by so many bytes."""
    at = 0
    while at < len(buffer):
        found = Segment(buffer, at)
        yield found
        at += found.size + separator
