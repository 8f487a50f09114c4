"""Keyed tables changed in place: a base in buckets of the key, numbered changes, merged when read.

A put or a delete writes its own rows and nothing else. A read takes the base without the keys that have changed
since, and the last change of each. Buckets with many changes are written anew by ``compact``; the others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from linkgraph.operators.tables import latest as last_changes
from linkgraph.stored.live import LiveFolders

GONE = "gone__"
VERSION = "version__"


class KeyedTable:
    """Rows of ``schema`` with one row for each value of ``key``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, buckets: int = 16):
        self.spark, self.key, self.buckets, self.schema = spark, key, buckets, schema
        self.base = LiveFolders(spark, path, schema)
        self.changes = LiveFolders(spark, path, StructType([
            *schema.fields, StructField(GONE, BooleanType()), StructField(VERSION, LongType())]))

    def latest(self) -> int:
        return self.base.latest()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets))

    def _changes(self, entries: list) -> DataFrame:
        """The last change of every key among folders of changes."""
        found = self.changes.read([e for e in entries if e["kind"] == "changes"])
        rest = [c for c in self.changes.schema.names if c != self.key]
        last = F.max_by(F.struct(*rest), VERSION).alias("last")
        return found.groupBy(self.key).agg(last).select(self.key, *[F.col("last")[c].alias(c) for c in rest])

    def _merged(self, entries: list) -> DataFrame:
        base = self.base.read([e for e in entries if e["kind"] == "base"])
        changed = self._changes(entries)
        return base.join(changed.select(self.key), self.key, "left_anti").select(*self.schema.names).unionByName(
            changed.where(~F.col(GONE)).select(*self.schema.names))

    def read(self, version: int | None = None) -> DataFrame:
        """All rows as of a version (the latest)."""
        return self._merged(self.base.live(self.latest() if version is None else version).collect())

    def _write(self, rows: DataFrame, gone: bool, version: int | None, before: int | None) -> int:
        before = self.latest() if before is None else before
        version = before + 1 if version is None else version
        marked = rows.withColumns({GONE: F.lit(gone), VERSION: F.lit(version).cast("bigint")})
        entries = self.changes.write(marked, version, self.bucket(), "changes")
        self.base.commit(version, self.base.live(before).unionByName(entries))
        return version

    def put(self, rows: DataFrame, order_col: str | None = None, version: int | None = None,
            before: int | None = None) -> int:
        """Put rows: a known key is replaced, a new one added; with ``order_col`` the last row of a key wins.

        Without it keys must be unique among ``rows``.
        """
        if order_col is not None:
            rows = last_changes(rows, self.key, order_col)
        if not (self.latest() if before is None else before):
            version = 1 if version is None else version
            self.base.commit(version, self.base.write(rows, version, self.bucket(), "base"))
            return version
        return self._write(rows.select(*self.schema.names), False, version, before)

    def delete(self, keys: DataFrame, version: int | None = None, before: int | None = None) -> int:
        """Delete the rows of some keys; unknown keys do no harm."""
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields if f.name != self.key]
        marks = keys.select(self.key).distinct().select(self.key, *empty).select(*self.schema.names)
        return self._write(marks, True, version, before)

    def clear(self) -> int:
        version = self.latest() + 1
        self.base.commit(version, self.base.live(0))
        return version

    def compact(self, share: float = 0.2) -> int:
        """Write the buckets anew whose changes are more than ``share`` of their base; the number of the version."""
        before = self.latest()
        live = self.base.live(before)
        sizes = live.groupBy("part").agg(
            F.sum(F.when(F.col("kind") == "base", F.col("n")).otherwise(0)).alias("held"),
            F.sum(F.when(F.col("kind") == "changes", F.col("n")).otherwise(0)).alias("changed"))
        worn = [row["part"] for row in sizes.where(F.col("changed") > F.col("held") * share).collect()]
        if not worn:
            return before
        entries = live.where(F.col("part").isin(worn)).collect()
        made = self.base.write(self._merged(entries), before + 1, self.bucket(), "base")
        self.base.commit(before + 1, live.where(~F.col("part").isin(worn)).unionByName(made))
        return before + 1
