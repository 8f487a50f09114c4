"""Ranked lexical search by exact inner products, with trees of balls over sparse vectors.

A document is the vector of its terms' parts of the score, an item the set of its terms, and a score the sum of the
document's parts over that set: an inner product. Only coordinates that some item has matter, so documents are
projected on the items' terms once and written; the texts are read only for that.

Each task puts the vectors it reads into balls: a block of them is halved along the line between two far apart ones
until a leaf has few, and every node knows its centroid and a radius. By Cauchy and Schwarz no document below a
node has a score above centroid * item + radius * |item| (after Ram and Gray, Maximum Inner-Product Search Using
Tree Data-Structures, 2012). The bound is rounded up by more than the sums can be off. An item goes through a
block's nodes in the order of their bounds and stops at the first that cannot reach its worst result so far, which
it carries on from block to block. Scores at leaves are sums of 64-bit integers, so they are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from linkgraph.llm.batches import long_texts
from linkgraph.llm.scratch import Scratch
from linkgraph.llm.words import binary, hash_words, letters_apart, lowered
from linkgraph.session import scratch_path, written

ITEM_TERMS = 1 << 16  # terms of the items that are searched at once; more items are searched in turns
BLOCK_NUMBERS = 1 << 22  # numbers of a block's matrix
LEAF = 32
ROUNDING = 2.0 ** -52

# Fixed values of the score, all integers but the logarithm.
UNIT = 1_000_000_000
TF_SCALE = 1_000
LENGTH_SCALE = 8
LENGTH_SHARE = 90
WEIGHT_SCALE = 1_000


def terms(text: bytes | None) -> np.ndarray:
    """Hashes of the terms of a text in order: runs of letters, digits and anything beyond ASCII, A-Z lower-cased."""
    return hash_words(lowered(text), letters_apart())


def weights(docs: int, holding: np.ndarray) -> np.ndarray:
    """The weight of a term that so many of all documents hold."""
    return np.floor(WEIGHT_SCALE * np.log((2 * docs + 2) / (2 * holding + 1))).astype(np.int64)


def parts(times: np.ndarray, length: np.ndarray, docs: int, all_terms: int) -> np.ndarray:
    """What a term that occurs so often in a document of that length adds, before its weight."""
    times, length = times.astype(np.int64), length.astype(np.int64)
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * length * docs) // all_terms
    return (UNIT * times) // (TF_SCALE * times + LENGTH_SCALE * norm)


class Balls:
    """The tree over the rows of a matrix of whole numbers; ``rows`` is the matrix in the order of the leaves."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(rows))
        centers, radii, self.children, self.span = [], [], [], []
        slack = 1 + (rows.shape[1] + 8) * ROUNDING
        todo = [(0, len(rows), -1)]
        while todo:
            low, high, parent = todo.pop()
            own = rows[self.order[low:high]]
            center = own.mean(axis=0)
            away = own - center
            far = np.einsum("ij,ij->i", away, away)
            node = len(centers)
            centers.append(center)
            radii.append(math.sqrt(far.max()) * slack * slack)
            self.children.append([])
            self.span.append((low, high))
            if parent >= 0:
                self.children[parent].append(node)
            if high - low > leaf and far.max() > 0:
                one = away[far.argmax()]
                apart = away - one
                two = away[np.einsum("ij,ij->i", apart, apart).argmax()]
                along = np.argsort(away @ (one - two), kind="stable")
                self.order[low:high] = self.order[low:high][along]
                middle = (low + high) // 2
                todo += [(low, middle, node), (middle, high, node)]
        self.rows, self.centers, self.radii = rows[self.order], np.array(centers), np.array(radii)

    def bounds(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For every node and item no less than the best score below; items are runs of ``flat`` coordinates."""
        sums = np.add.reduceat(self.centers[:, flat], starts, axis=1)
        slack = 1 + (int(sizes.max()) + 8) * ROUNDING
        return (sums * slack + self.radii[:, None] * (np.sqrt(sizes) * slack)[None, :]) * slack + 1


def search_block(balls: Balls, ids: list, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, best: list[list],
                 k: int) -> int:
    """Bring the best ``k`` rows of every item up to date; the count of leaves that were looked at.

    ``best`` has a heap of (score, whether the id is known, -id) for each item.
    """
    bounds = balls.bounds(flat, starts, sizes).T.tolist()
    looked = 0
    for item, (bound, heap) in enumerate(zip(bounds, best)):
        own = flat[starts[item]:starts[item] + sizes[item]]
        limit = heap[0][0] if len(heap) == k else 1
        queue = [(-bound[0], 0)]
        while queue:
            most, node = heappop(queue)
            if -most < limit:
                break
            if balls.children[node]:
                for child in balls.children[node]:
                    if bound[child] >= limit:
                        heappush(queue, (-bound[child], child))
                continue
            looked += 1
            low, high = balls.span[node]
            scores = balls.rows[low:high].take(own, axis=1).astype(np.int64).sum(axis=1)
            for at in np.flatnonzero(scores >= limit).tolist():
                doc_id = ids[balls.order[low + at]]
                entry = (int(scores[at]), doc_id is not None, -(doc_id or 0))
                if len(heap) < k:
                    heappush(heap, entry)
                elif entry > heap[0]:
                    heapreplace(heap, entry)
                limit = heap[0][0] if len(heap) == k else 1
    return looked


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``number, item, terms``: a number for each row, its id and its distinct terms; rows without terms are left out."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(terms(text.as_py())).view(np.int64) for text in binary(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))],
                                             names=["number", "item", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("item"),
                        F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([*rows.select("number", "item").schema.fields,
                           T.StructField("terms", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(take, schema).where(F.size("terms") > 0)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values).astype(np.int32)))


def _projected(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """``id``, ``n`` (terms of the whole text), ``at`` and ``times`` (its terms in the vocabulary) of every document."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            lengths, at, times = [], [], []
            for text in binary(batch.column(1)):
                found = terms(text.as_py())
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                own, count = np.unique(place[known[place] == found], return_counts=True)
                lengths.append(len(found))
                at.append(own)
                times.append(count)
            if lengths:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(lengths, pa.int64()), _lists(at), _lists(times)],
                    names=["id", "n", "at", "times"])

    rows = long_texts(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(project, "id bigint, n bigint, at array<int>, times array<int>")


def _holding(projected: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary; a task passes on its sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, dtype=np.int64)
        for batch in batches:
            sums += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(sums[held], pa.int64())], names=["at", "n"])

    found = projected.select("at").mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(size, dtype=np.int64)
    held[found["at"].to_numpy()] = found["n"].to_numpy()
    return held


def _best(projected: DataFrame, corpus, k: int) -> DataFrame:
    """``item`` (its place in the group), ``doc_id``, ``score``: the best ``k`` of every task."""

    leaf = LEAF

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, all_terms, weight, flat, starts, sizes = corpus.value
        best: list[list] = [[] for _ in starts]
        rows = int(max(2 * leaf, min(4096, BLOCK_NUMBERS // len(weight))))
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                own = batch.slice(low, rows)
                ids, length = own.column(0).to_pylist(), own.column(1).to_numpy()
                counts = own.column(2).value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(own.num_rows), counts)
                at = own.column(2).flatten().to_numpy(zero_copy_only=False)
                times = own.column(3).flatten().to_numpy(zero_copy_only=False)
                matrix = np.zeros((own.num_rows, len(weight)))
                matrix[row, at] = weight[at] * parts(times, length[row], docs, all_terms)
                search_block(Balls(matrix, leaf), ids, flat, starts, sizes, best, k)
        found = [(item, -negative if known else None, score) for item, heap in enumerate(best)
                 for score, known, negative in heap]
        item, doc_id, score = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (item, doc_id, score)],
                                         names=["place", "doc_id", "score"])

    return projected.where(F.size("at") > 0).mapInArrow(search, "place bigint, doc_id bigint, score bigint")


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", item_terms: int = ITEM_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents above 0 of every item, all if there are fewer.

    Terms are maximal runs of characters other than ASCII signs, A-Z lower-cased. With N documents that have a term, L
    terms in all, n in the document, df documents that hold a term and tf of it in the document, a score sums
    w * (10^9 tf div (1000 tf + 8 m)) over the item's distinct terms, w = floor(1000 ln((2N + 2) / (2 df + 1))) and
    m = 10 + 90 n N div L. Equal scores go by ascending document id, an unknown id last. Every row is a document
    and every row an item of its own, repeats included; a null text or one without terms is found by nothing and
    finds nothing. An empty table on either side gives no rows. Items are searched in groups of about ``item_terms``
    terms, so that what is broadcast is bounded.
    """
    spark = docs.sparkSession
    scratch, result = Scratch(spark), Scratch(spark)
    wanted = scratch.write(_item_terms(items, item_id_col, item_text_col), "items")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, math.ceil(total / item_terms))
    named = wanted.select("number", F.col("item").alias("item_id"))
    found = None
    for group in range(groups):
        own = wanted.where(F.pmod(F.xxhash64("number"), F.lit(groups)) == group).select("number", "terms").toArrow()
        if not own.num_rows:
            continue
        flat = own["terms"].combine_chunks().flatten().to_numpy().view(np.uint64)
        sizes = own["terms"].combine_chunks().value_lengths().to_numpy().astype(np.int64)
        vocabulary, flat = np.unique(flat, return_inverse=True)
        projected = scratch.write(_projected(docs, id_col, text_col, spark.sparkContext.broadcast(vocabulary)), "projected")
        n_docs, all_terms = projected.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        weight = weights(n_docs, _holding(projected, len(vocabulary)))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        corpus = spark.sparkContext.broadcast((n_docs, all_terms, weight, flat, starts, sizes))
        numbers = spark.createDataFrame(
            [(at, number) for at, number in enumerate(own["number"].to_pylist())], "place bigint, number bigint")
        best = result.write(_best(projected, corpus, k).join(F.broadcast(numbers), "place").drop("place"), "best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        scratch.drop()
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", items.schema[item_id_col].dataType),
            *T.StructType.fromDDL("rank int, doc_id bigint, score bigint").fields]))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                     .join(named, "number").select("item_id", "rank", "doc_id", "score"),
                     scratch_path(spark, "ranked"))
    scratch.drop()
    result.drop()
    return ranked
