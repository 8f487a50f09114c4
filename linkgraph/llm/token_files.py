"""Texts as token ids in binary files that give any token by its number.

Documents are dealt by ranges of their ids, encoded where they lie, and written as segments of directly
addressable codes (``direct_codes``). A file is a few segments, each closed by a line feed, and goes through
Spark's text writer: it appears on any file system, whole, once its task has succeeded. Files are read back with
the ``binaryFile`` source.

A tokenizer whose pieces never cross a single space between two visible characters (byte-level, split by its
pattern, no normaliser) is asked once for every distinct piece at hand rather than for every text: the ids are
the same, and most pieces repeat. Any other tokenizer gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linkgraph.llm.batches import long_texts
from linkgraph.llm.direct_codes import Segment, encode_segment, segments
from linkgraph.session import drop_path, scratch_path, written

SEGMENT_IDS = 1 << 20  # a segment ends with the document that reaches so many ids
SEGMENTS_PER_FILE = 8
MEMO = 1 << 20  # pieces a worker remembers, about 200 MB; beyond, it forgets all and goes on
FILES_BY_NAME = 10_000  # files that are opened by name; more are found by a join

_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# Stretches that the byte-level pattern takes as one wherever they stand, but for apostrophes and wide white space.
_STRETCH = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]++|[0-9]++|[!-&(-/:-@\\[-`{-~]++|\n(?=[!-~])"
_STRETCHES = re.compile(_STRETCH)
_SIMPLE = re.compile(f"(?:{_STRETCH})++")


def _spelling() -> dict[int, int]:
    """How a byte-level vocabulary spells bytes: visible ones as themselves, the others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [byte for byte in range(256) if byte not in visible]
    return {byte: byte if byte in visible else 256 + hidden.index(byte) for byte in range(256)}


class _SplitElsewhere(Exception):
    """A space beside other white space: the text cannot be cut there."""


def _worker_memory() -> dict:
    """What a Python worker keeps from task to task."""
    return vars(sys.modules.setdefault("linkgraph_worker_memory", types.ModuleType("linkgraph_worker_memory")))


def _cuts_at_spaces(settings: dict) -> bool:
    """Whether a tokenizer's pieces never cross a single space between two visible characters."""
    split = settings.get("pre_tokenizer") or {}
    added = settings.get("added_tokens") or []
    return (split.get("type") == "ByteLevel" and split.get("use_regex", True) is True
            and not split.get("add_prefix_space", True)
            and settings.get("normalizer") is None and settings.get("truncation") is None
            and settings.get("padding") is None and (settings.get("model") or {}).get("type") == "BPE"
            and not (settings["model"].get("dropout") or 0)
            and not any(re.search(r"\s|^[A-Za-z.,;:!?]+$", t["content"]) or t["lstrip"] or t["rstrip"]
                        or t["single_word"] for t in added))


def text_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids (32 bits each, little-endian) by the tokenizer file at ``path``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of parallel work
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        settings = json.load(file)
    tokenizer = Tokenizer.from_file(path)

    def ids(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    if not _cuts_at_spaces(settings):
        return ids

    model, spelling = tokenizer.model, _spelling()
    marks = [token["content"] for token in settings.get("added_tokens") or []]

    def bounded(memo: dict, key: str, value: bytes) -> bytes:
        if len(memo) >= MEMO:
            memo.clear()
        memo[key] = value
        return value

    def stretch_ids(stretch: str) -> bytes:
        """The ids of one stretch as the model spells it."""
        return array("I", [token.id for token in model.tokenize(stretch)]).tobytes()

    def spelled(stretch: str) -> str:
        if stretch.isascii() and stretch != "\n":
            return stretch
        return stretch.encode().decode("latin-1").translate(spelling)

    class Bare(dict):
        """The ids of a stretch without a space before it."""

        def __missing__(self, stretch: str) -> bytes:
            return bounded(self, stretch, stretch_ids(spelled(stretch)))

    bare = Bare()

    def is_simple(piece: str) -> bool:
        return _SIMPLE.fullmatch(piece) is not None and not any(mark in piece for mark in marks)

    def first_ids(piece: str) -> bytes:
        """The ids of the beginning of a text, up to its first space."""
        return b"".join(map(bare.__getitem__, _STRETCHES.findall(piece))) if is_simple(piece) else ids([piece])[0]

    def piece_ids(piece: str) -> bytes:
        """The ids of a space and what follows it, up to the next one."""
        if piece.isalpha() and piece.isascii():
            return stretch_ids("\u0120" + piece)
        if not is_simple(piece) or piece[0] == "\n":
            return ids([" " + piece])[0]
        first, *rest = _STRETCHES.findall(piece)
        if not rest:
            return stretch_ids("\u0120" + spelled(first))
        return known[first] + b"".join(map(bare.__getitem__, rest))

    class Pieces(dict):
        """The ids of what follows a space, up to the next one, and of the space."""

        def __missing__(self, piece: str) -> bytes:
            if not piece or piece[0].isspace() or piece[-1].isspace():
                raise _SplitElsewhere
            return bounded(self, piece, piece_ids(piece))

    known = Pieces()

    def remembered(texts: list[str]) -> list[bytes]:
        out = []
        for text in texts:
            first, *rest = text.split(" ")
            try:
                if not first or first[-1].isspace():
                    raise _SplitElsewhere
                out.append(first_ids(first) + b"".join(map(known.__getitem__, rest)))
            except _SplitElsewhere:
                first, *rest = _SAFE_CUT.split(text)
                out.append((first_ids(first) if first else b"") + b"".join(
                    piece_ids(piece) if piece[-1].isspace() else known[piece] for piece in rest))
        return out

    return remembered


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", parts: int | None = None) -> None:
    """Write the token ids of whole texts, each followed by ``end_id``, in ascending order of ids.

    A null text is empty. Documents with a null id come first; rows of equal ids are ordered by a hash of their
    text, and equal rows are each written. An empty table gives files without segments. ``parts`` (default: the
    session's shuffle partitions) is the number of ranges; a range of many ids becomes several files. The
    tokenizer file must be at the same path on every machine.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, held, offsets = [], [], [0]
        encoder, memory = None, _worker_memory()

        def segment() -> pa.RecordBatch:
            values = np.frombuffer(b"".join(held), dtype="<u4")
            data = encode_segment(values, doc_ids, offsets, part, number, first)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["segment"])

        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            encoder = encoder or memory.setdefault(tokenizer, None) or text_encoder(tokenizer)
            memory[tokenizer] = encoder
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = encoder([text.as_py() or ""])[0]
                doc_ids.append(doc_id.as_py())
                held += [ids, end]
                offsets.append(offsets[-1] + len(ids) // 4 + 1)
                if offsets[-1] >= SEGMENT_IDS:
                    yield segment()
                    number, first = number + 1, first + offsets[-1]
                    doc_ids, held, offsets = [], [], [0]
        if doc_ids:
            yield segment()

    rows = long_texts(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    # the last key only spreads equal rows
    keyed = rows.withColumns({"place": F.xxhash64("text"), "spread": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(parts, "id", "place", "spread")
    (dealt.sortWithinPartitions("id", "place").select("id", "text").mapInArrow(encode, "segment binary")
     .select(F.col("segment").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\n").option("compression", "none")
     .option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path))


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, file, segment, part, first, n_tokens, ids_crc32`` of every document, read from the files.

    ``segment`` is the place of its segment in the file, ``first`` the number of its first id within the part.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "file", "segment", "part", "first", "n_tokens", "ids_crc32"]
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                buffer, at = content.as_py(), 0
                for found in segments(buffer):
                    rows = [(doc_id, found.first + start, len(ids), zlib.crc32(ids.tobytes()))
                            for doc_id, start, ids in found.documents()]
                    ids, first, n, crc = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array([file.as_py()] * len(rows), pa.string()),
                         *(pa.array([x] * len(rows), pa.int64()) for x in (at, found.part)),
                         *(pa.array(x, pa.int64()) for x in (first, n, crc))], names=names)
                    at += found.size + 1

    return _files(spark, path).select("path", "content").mapInArrow(
        index, "doc_id bigint, file string, segment bigint, part bigint, first bigint, n_tokens bigint, "
               "ids_crc32 bigint")


def with_starts(index: DataFrame) -> DataFrame:
    """An index (a written table) with ``start``: the ids of all documents before.

    The totals have a row for each part, so their running sum is a small table.
    """
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    return index.join(starts, "part").withColumn("start", F.col("before") + F.col("first")).drop("before")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, ids`` of every document in the files; ``ids`` ends with the end id."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for found in segments(content.as_py()):
                    ids, values = zip(*((doc_id, ids.astype(np.int64)) for doc_id, _, ids in found.documents()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return _files(spark, path).select("content").mapInArrow(read, "doc_id bigint, ids array<bigint>")


def tokens_at(index: DataFrame, positions: DataFrame, column: str = "position") -> DataFrame:
    """``position, doc_id, token`` for numbers of tokens in the whole corpus, each read by itself.

    ``index`` is what ``with_starts`` gives. Numbers outside the corpus and nulls give no row, repeated ones a row
    each time. Only the files that hold asked tokens are opened, as long as they are few enough to be named.
    """
    spark = index.sparkSession
    # ranges of documents and numbers meet by blocks of numbers, so that this is a join by equality
    block = 1 << 16
    spans = index.select("doc_id", "file", "segment", "first", "start", "n_tokens", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n_tokens") - 1) / block))).alias("block"))
    segment_first = index.groupBy("file", "segment").agg(F.min("first").alias("segment_first"))
    asked = positions.select(F.col(column).cast("bigint").alias("position")).where("position >= 0").groupBy(
        "position").agg(F.count(F.lit(1)).alias("times")).withColumn("block", F.floor(F.col("position") / block))
    found = (asked.join(spans, "block")
             .where((F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens")))
             .join(segment_first, ["file", "segment"])
             .select("file", "segment", "position", "times", "doc_id",
                     (F.col("first") - F.col("segment_first") + F.col("position") - F.col("start")).alias("at")))
    found = written(found, scratch_path(spark, "asked"))
    wanted = found.groupBy("file").agg(F.collect_list(F.struct("segment", "at", "position", "times", "doc_id")).alias("asked"))
    names = [row["file"] for row in wanted.select("file").limit(FILES_BY_NAME + 1).collect()]
    if not names:
        return found.select("position", "doc_id", F.lit(None).cast("bigint").alias("token"))
    files = _files(spark, names if len(names) <= FILES_BY_NAME else os.path.dirname(names[0]))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, asked in zip(batch.column(0), batch.column(1)):
                buffer, rows, opened = content.as_py(), [], {}
                for want in asked.as_py():
                    at = want["segment"]
                    if at not in opened:
                        opened[at] = Segment(buffer, at)
                    rows += [(want["position"], want["doc_id"], opened[at].get(want["at"]))] * want["times"]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)],
                                                 names=["position", "doc_id", "token"])

    return (files.select(F.col("path").alias("file"), "content").join(wanted, "file").select("content", "asked")
            .mapInArrow(fetch, "position bigint, doc_id bigint, token bigint"))


def token_digest(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from files that are written, read back and deleted."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end_id, id_col, text_col)
    index = written(token_index(spark, path).drop("file", "segment"), scratch_path(spark, "token-index"))
    drop_path(spark, path)
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")
