"""Runs of words: stretches that repeat with a period, found as maximal pairs.

A pair of places (i, j) of a text with a common continuation of l words is maximal if the words before differ and
the words after the continuation differ. A run of period q from i is such a pair with j = i + q, and a maximal
pair whose distance is at most half of l is a run of i, l + j - i words, so nothing has to be extended.

Maximal pairs come from the LCP-interval tree of the suffix array, bottom-up: the places below a node share as
many words as the node is deep; a pair from two children that differ in the word before is maximal (Gusfield,
Algorithms on Strings, Trees and Sequences, 7.12.3; Abouelhoda, Kurtz and Ohlebusch, 2004). A node keeps the
places below it in lists by the word before, ordered over all lists by place. When children meet, each place of
the smaller one looks into the other for places of other lists that are near enough (Brodal, Lyngsø, Pedersen and
Stoye, Finding Maximal Pairs with Bounded Gap, 1999). Within half the depth the equal stretches overlap so far
that they lie one period apart, so all but the first have the same word before: one look to each side finds the
partner if there is one. Children whose places are all of one and the same list make no pair.

A wanted run of at least ``least`` words and three periods has a pair of at least two thirds of ``least`` words,
so less deep nodes are never built; a text in which no stretch of that length recurs has none.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from linkgraph.llm.batches import long_texts
from linkgraph.llm.words import binary, mix

LEAST_WORDS = 24
LEAST_TIMES = 3
MIXED = -2  # the list of a node with places of several lists
NO_WORD = -1  # the word before the first one
BLOCK = 1024


class Places:
    """Ordered places in blocks, so that one more costs little among very many."""

    def __init__(self, ordered: list[int]):
        self.blocks = [ordered[at:at + BLOCK] for at in range(0, len(ordered), BLOCK)]
        self.firsts = [block[0] for block in self.blocks]
        self.n = len(ordered)

    def add(self, place: int) -> None:
        at = max(0, bisect_right(self.firsts, place) - 1)
        block = self.blocks[at]
        insort(block, place)
        self.firsts[at] = block[0]
        self.n += 1
        if len(block) > 2 * BLOCK:
            self.blocks[at:at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.firsts[at:at + 1] = [block[0], block[BLOCK]]

    def from_on(self, place: int) -> int | None:
        """The first place that is not before ``place``."""
        at = max(0, bisect_right(self.firsts, place) - 1)
        block = self.blocks[at]
        k = bisect_left(block, place)
        if k < len(block):
            return block[k]
        return self.firsts[at + 1] if at + 1 < len(self.firsts) else None

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def numbered(words: list) -> np.ndarray:
    """Equal words as equal numbers from 0."""
    known: dict = {}
    return np.fromiter((known.setdefault(word, len(known)) for word in words), dtype=np.int64, count=len(words))


def recurs(ids: np.ndarray, length: int) -> bool:
    """Whether some stretch of ``length`` words may occur twice; never false where one does (hashes are compared)."""
    if len(ids) <= length:
        return False
    made, width = mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while width < length:
        step = min(width, length - width)
        made = mix(made[:len(made) - step] * np.uint64(0x9E3779B97F4A7C15) + made[step:])
        width += step
    made.sort()
    return bool((made[1:] == made[:-1]).any())


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the rest of the text from there, and words shared with the one before in that order.

    By prefix doubling; the ranks of every round tell the shared words by binary search over powers of two.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int32)
    ranks, width = [rank], 1
    order = np.argsort(rank, kind="stable")
    while width < n:
        after = np.zeros(n, dtype=np.int64)
        after[:n - width] = rank[width:].astype(np.int64) + 1
        key = rank.astype(np.int64) * (n + 1) + after
        order = np.argsort(key)
        new = np.concatenate(([False], key[order][1:] != key[order][:-1]))
        rank = np.empty(n, dtype=np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32)
        width *= 2
        if rank[order[-1]] == n - 1:
            break
        ranks.append(rank)
    shared = np.zeros(n, dtype=np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((left + (1 << k) <= n) & (right + (1 << k) <= n))
        same = inside[ranks[k][left[inside]] == ranks[k][right[inside]]]
        left[same] += 1 << k
        right[same] += 1 << k
        shared[same + 1] += 1 << k
    return order, shared


def maximal_pairs(ids: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """Maximal pairs (first place, distance, shared words) that are runs of ``least`` words and ``times`` periods."""
    floor = max(times - 1, -(-least * (times - 1) // times))
    order, shared = suffix_array(ids)
    before = np.concatenate(([NO_WORD], ids[:-1])).tolist()
    ends = np.flatnonzero(shared >= floor)
    if not len(ends):
        return
    found = []

    def meet(one: tuple, two: tuple, depth: int) -> tuple:
        """The node of two children, after looking for pairs between them."""
        (big, of_big), (small, of_small) = (one, two) if one[0].n >= two[0].n else (two, one)
        if of_big == MIXED or of_big != of_small:
            near = depth // (times - 1)
            for place in small:
                word = before[place]
                other = big.from_on(place - near)
                if other is not None and other < place and before[other] != word and depth + place - other >= least:
                    found.append((other, place - other, depth))
                other = big.from_on(place + 1)
                if other is not None and other - place <= near and before[other] != word \
                        and depth + other - place >= least:
                    found.append((place, other - place, depth))
        for place in small:
            big.add(place)
        return big, of_big if of_big == of_small else MIXED

    def leaf(place: int) -> tuple:
        return Places([place]), before[place]

    order, shared = order.tolist(), shared.tolist()
    stack: list[tuple[int, tuple]] = []
    last = None  # the suffix whose place in the tree is still open
    for at in ends.tolist():
        if last is not None and at != last + 1:
            node = leaf(order[last])
            while stack:
                depth, sibling = stack.pop()
                node = meet(sibling, node, depth)
        node, depth = leaf(order[at - 1]), shared[at]
        while stack and stack[-1][0] > depth:
            deeper, sibling = stack.pop()
            node = meet(sibling, node, deeper)
        if stack and stack[-1][0] == depth:
            stack[-1] = depth, meet(stack[-1][1], node, depth)
        else:
            stack.append((depth, node))
        last = at
        yield from found
        found.clear()
    node = leaf(order[last])
    while stack:
        depth, sibling = stack.pop()
        node = meet(sibling, node, depth)
    yield from found


def runs_of(ids: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run of numbers, by start, then period.

    ``times`` is 3 or more: pairs at a multiple of the period cover the same stretch, so the least distance counts.
    """
    if times < 3 or least < 1:
        raise ValueError("runs of three periods or more")
    if len(ids) < least or not recurs(ids, max(times - 1, -(-least * (times - 1) // times))):
        return []
    best: dict[tuple[int, int], int] = {}
    for start, distance, depth in maximal_pairs(ids, least, times):
        key = start, depth + distance
        best[key] = min(distance, best.get(key, distance))
    return sorted(((start, length, period) for (start, length), period in best.items()),
                  key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut to its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods, compared exactly; then the first, then the shortest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2] or (
                run[1] * best[2] == best[1] * run[2] and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return best


RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
    *(T.StructField(name, T.StringType()) for name in ("collapsed", "collapsed_sha256", "runs_sha256")),
    T.StructField("strongest", RUN)])


def with_runs(docs: DataFrame, out_col: str = "found", text_col: str = "text", least: int = LEAST_WORDS,
              times: int = LEAST_TIMES, words_of: Callable[[list[bytes], object], list[bytes]] | None = None,
              given: Column | None = None, with_text: bool = True) -> DataFrame:
    """``docs`` with a column of its words' runs: ``n_words, runs, collapsed, collapsed_sha256, runs_sha256, strongest``.

    Words are what spaces and 0x09-0x0D part, compared as they are. A run is a stretch of at least ``least`` words
    and ``times`` times its smallest period that no neighbour continues. ``collapsed`` are the words outside
    every run's repeats, joined by a space (null with ``with_text=False``); the hashes are sha256 of it and of a line
    ``start,length,period`` for each run. A null or empty text has no words: no runs, an empty text. Rows are
    looked at one by one, so repeated rows give equal results. A column called like the result is replaced.
    ``words_of`` changes the words of a text before that, by the value of ``given``.
    """
    kept = [c for c in docs.columns if c != out_col]
    value = F.lit(None).cast("bigint") if given is None else given
    # the other columns travel as one, so that none can have the name of another
    rows = long_texts(docs).select(F.col(text_col).cast("string").alias("text"), value.alias("given"),
                                   F.struct(F.lit(0).alias("__"), *kept).alias("row"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, value in zip(binary(batch.column(0)), batch.column(1)):
                words = (text.as_py() or b"").split()
                if words_of is not None:
                    words = words_of(words, value.as_py())
                found = runs_of(numbered(words), least, times) if len(words) >= least else []
                if found:
                    collapsed = b" ".join([words[k] for k in np.flatnonzero(kept_words(len(words), found)).tolist()])
                else:
                    collapsed = b" ".join(words)
                lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
                best = strongest(found)
                out.append({
                    "n_words": len(words), "runs": [dict(zip(("start", "length", "period"), run)) for run in found],
                    "collapsed": collapsed.decode(errors="replace") if with_text else None,
                    "collapsed_sha256": hashlib.sha256(collapsed).hexdigest(),
                    "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
                    "strongest": None if best is None else dict(zip(("start", "length", "period"), best))})
            run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            kind = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string()),
                              ("collapsed_sha256", pa.string()), ("runs_sha256", pa.string()), ("strongest", run)])
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, kind)], names=["row", "found"])

    schema = T.StructType([rows.schema["row"], T.StructField("found", FOUND)])
    return rows.mapInArrow(find, schema).select(
        *[F.col("row")[c].alias(c) for c in kept], F.col("found").alias(out_col))


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST_WORDS,
                  times: int = LEAST_TIMES) -> DataFrame:
    """``docs`` with the repeats of every run cut from its text; texts without runs stay as they are."""
    inner = docs.select(F.col(text_col).alias("text"), F.struct(F.lit(0).alias("__"), *docs.columns).alias("row"))
    found = with_runs(inner, "found", "text", least, times)
    text = F.when(F.size("found.runs") > 0, F.col("found.collapsed")).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
