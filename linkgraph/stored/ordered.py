"""Queues as stored tables: rows in the order of a key, in folders by a part of that order.

The manifest counts the rows of every folder (a time slot, a prefix of the key, or a range of them where there are
many), so it is known before a row is read in which folders the n-th row may lie, and a pop opens these and no others.
Rows are put by writing them, and taken by leaving their folders out of the next manifest; only what stays of the
opened folders is written again. How many folders a change writes follows from the rows, not from the parts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from linkgraph.operators.frontier import DUE_HORIZON_MS, nth_key
from linkgraph.session import drop_path, scratch_path, written
from linkgraph.stored.live import PART, LiveFolders

NO_TIME = -(1 << 62)  # the slot of rows without a time: before all others, so they are due at once
MANY_FOLDERS = 16  # a part in so many folders is written as one when its queue next changes
MANY_PARTS = 64  # a change of more parts writes ranges of them: so many, or one for FOLDER_ROWS rows
FOLDER_ROWS = 2_000_000


class Taken(NamedTuple):
    """``rows`` that leave a queue, ``rest`` of the parts that were opened, and the ``opened`` folders."""
    rows: DataFrame
    rest: DataFrame
    opened: list[Row]


class OrderedTable:
    """A queue in the order of ``order_cols``; ``part`` must not fall where they rise.

    Text parts must be fit for a path (``prefix_part``).
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, order_cols: tuple[str, ...], part: Column,
                 part_type: str = "bigint"):
        self.spark, self.order_cols, self.part = spark, order_cols, part
        self.folders = LiveFolders(spark, path, schema, part_type)

    def latest(self) -> int:
        return self.folders.latest()

    def read(self, version: int | None = None) -> DataFrame:
        """All rows."""
        version = self.latest() if version is None else version
        return self.folders.read(self.folders.live(version).collect())

    def entries_until(self, part: Column, version: int) -> list[Row]:
        """The folders that may hold parts up to a given one."""
        return self.folders.live(version).where(F.col("part") <= part).collect()

    def take_first(self, n: int, version: int | None = None) -> Taken:
        """The first ``n`` rows of the queue; rows with the key of the last one go with it."""
        version = self.latest() if version is None else version
        entries = self.folders.live(version).collect()  # a row for each folder
        # rows without a key come before all others; they are counted and stay
        unnamed = sum(e["n"] for e in entries if e["part"] is None)
        return self._first([e for e in entries if e["part"] is not None], n - unnamed)

    def _first(self, entries: list[Row], n: int) -> Taken:
        """The first ``n`` rows of some folders."""
        if n <= 0 or not entries:
            return Taken(self.folders.read([]), self.folders.read([]), [])
        # n rows lie in folders that end no later than ``until``, so the n-th row lies no later either
        held, until = 0, None
        for entry in sorted(entries, key=lambda e: e["last"]):
            held, until = held + entry["n"], entry["last"]
            if held >= n:
                break
        opened = sorted((e for e in entries if e["part"] <= until), key=lambda e: e["part"])
        # a folder is taken whole if it and all that may come before its last row are n rows at most
        whole, split, reach, k = [], [], 0, 0
        for entry in sorted(opened, key=lambda e: e["last"]):
            while k < len(opened) and opened[k]["part"] <= entry["last"]:
                reach, k = reach + opened[k]["n"], k + 1
            (whole if reach <= n else split).append(entry)
        rows, open_part = self.folders.read(whole), self.folders.read(split)
        if not split:
            return Taken(rows, open_part, opened)
        key = nth_key(open_part, n - sum(e["n"] for e in whole), *self.order_cols)
        if key is None:
            return Taken(rows.unionByName(open_part), self.folders.read([]), opened)
        schema = self.folders.schema
        until = F.struct(*[F.lit(key[c]).cast(schema[c].dataType).alias(c) for c in self.order_cols])
        inside = F.struct(*self.order_cols) <= until
        return Taken(rows.unionByName(open_part.where(inside)), open_part.where(~inside), opened)

    def _lows(self, rows: DataFrame) -> list | None:
        """The first parts of ranges with about as many rows each; None if there are so few parts that each is one."""
        parts = rows.select(self.part.cast(self.folders.part_type).alias(PART))
        held = parts.groupBy(PART).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"),
                                               F.count(F.lit(1)).alias("parts")).first()
        ranges = max(MANY_PARTS, math.ceil(held["rows"] / FOLDER_ROWS))
        if held["parts"] <= ranges:
            return None
        dealt = parts.repartitionByRange(ranges, PART).withColumn("range", F.spark_partition_id())
        lows = dealt.where(F.col(PART).isNotNull()).groupBy("range").agg(F.min(PART).alias("low"))
        return sorted(row["low"] for row in lows.collect())

    def _crowded(self, live: DataFrame) -> list[Row]:
        """The folders over a part that lies in too many of them."""
        parts = live.select(F.col("part").alias("at")).distinct()
        over = live.join(F.broadcast(parts), F.col("at").between(F.col("part"), F.col("last")))
        crowded = over.groupBy("at").agg(F.count(F.lit(1)).alias("folders")).where(F.col("folders") >= MANY_FOLDERS)
        return live.join(F.broadcast(crowded), F.col("at").between(F.col("part"), F.col("last")), "left_semi").collect()

    def change(self, added: DataFrame | None = None, taken: Taken | None = None, version: int | None = None,
               before: int | None = None) -> int:
        """Write a version with the rows ``added`` and without those ``taken``; its number.

        ``before`` is the version that was read (the latest), ``version`` the one that is made (the next).
        Parts that have come to lie in many folders are written as one on the way.
        """
        before = self.latest() if before is None else before
        version = before + 1 if version is None else version
        live = self.folders.live(before)
        opened = list(taken.opened) if taken is not None else []
        rows = [frame for frame in (added, taken.rest if taken is not None else None) if frame is not None]
        done = {(e["version"], e["part"]) for e in opened}
        merged = [e for e in self._crowded(live) if (e["version"], e["part"]) not in done]
        if merged:
            rows.append(self.folders.read(merged))
        gone = self.spark.createDataFrame(
            [(e["version"], e["part"]) for e in (*opened, *merged)], f"version bigint, part {self.folders.part_type}")
        kept = live.join(F.broadcast(gone), ["version", "part"], "left_anti").select(*live.columns)
        if rows:
            together = rows[0].select(*self.folders.schema.names)
            for frame in rows[1:]:
                together = together.unionByName(frame.select(*self.folders.schema.names))
            path = scratch_path(self.spark, "queued")
            together = written(together, path)  # read for the ranges and for the folders
            kept = kept.unionByName(self.folders.write(together, version, self.part, lows=self._lows(together)))
            drop_path(self.spark, path)
        self.folders.commit(version, kept)
        return version

    def put(self, rows: DataFrame) -> int:
        return self.change(added=rows)

    def pop_first(self, n: int) -> DataFrame:
        """The first ``n`` rows, which leave the queue."""
        before = self.latest()
        taken = self.take_first(n, before)
        self.change(taken=taken, before=before)
        return taken.rows

    def clear(self) -> int:
        """An empty queue."""
        version = self.latest() + 1
        self.folders.commit(version, self.folders.live(0))
        return version


def prefix_part(column: str, length: int) -> Column:
    """The part of a text key: its first bytes in hexadecimal, whose order is that of the key."""
    return F.hex(F.substring(F.col(column).cast("binary"), 1, length))


class SlotTable(OrderedTable):
    """A queue of URLs by ``next_request_ms``, in slots of time. A row without a time is due at once."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, slot_ms: int = 60_000):
        self.slot_ms = slot_ms
        slot = F.coalesce(F.floor(F.col("next_request_ms") / slot_ms), F.lit(NO_TIME))
        super().__init__(spark, path, schema, ("next_request_ms", "url"), slot)

    def take_due(self, now_ms: int, horizon_ms: int = DUE_HORIZON_MS, version: int | None = None) -> Taken:
        """All rows due at ``now_ms``; folders that begin later are not opened."""
        version = self.latest() if version is None else version
        until = now_ms + horizon_ms
        last = (until - 1) // self.slot_ms
        opened = self.entries_until(F.lit(last), version)
        is_due = F.coalesce(F.col("next_request_ms") < until, F.lit(True))
        open_slot = self.folders.read([e for e in opened if e["last"] >= last])
        whole = self.folders.read([e for e in opened if e["last"] < last])
        return Taken(whole.unionByName(open_slot.where(is_due)), open_slot.where(~is_due), opened)

    def pop_due(self, now_ms: int, n: int | None = None, horizon_ms: int = DUE_HORIZON_MS) -> DataFrame:
        """The earliest rows as far as they are due (all of them without ``n``), which leave the queue."""
        before = self.latest()
        taken = self.take_due(now_ms, horizon_ms, before)
        if n is not None:
            # due rows come before all others of these folders
            first, until = self._first(taken.opened, n), now_ms + horizon_ms
            late = ~F.coalesce(F.col("next_request_ms") < until, F.lit(True))
            taken = Taken(first.rows.where(~late), first.rest.unionByName(first.rows.where(late)), first.opened)
        self.change(taken=taken, before=before)
        return taken.rows
