"""All URLs ever seen, as one stored table for batches and streams, with an index of membership.

URLs lie in folders by a bucket of their hash, and next to them as bits: a URL sets a few bits in one of many
bitmaps (a Bloom filter in pieces, from built-in bitmap functions). A candidate whose bits are not all set was
never seen; only the others are compared exactly, and only with the buckets they fall in. Every admission writes
its URLs and their bits as one version, so a batch that is tried again finds the table as it was and adds nothing twice.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linkgraph.operators.frontier import drop_trap_urls, first_occurrence
from linkgraph.session import drop_path, scratch_path, written
from linkgraph.stored.live import LiveFolders, complete_versions

BITS = 32_768  # fixed value: the bits of a bitmap of the built-in functions
HASHES = 3
URLS = StructType([StructField("url", StringType())])
MANY_VERSIONS = 32  # bits of so many versions are made one


class Unseen(NamedTuple):
    """``new`` URLs, each once; ``path`` holds them until the caller is done."""
    new: DataFrame
    path: str


class SeenTable:
    """``cells`` bitmaps make the index: one for about 3,000 URLs keeps false alarms below two in a hundred."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, cells: int = 1024):
        self.spark, self.path, self.buckets, self.cells = spark, path.rstrip("/"), buckets, cells
        self.folders = LiveFolders(spark, self.path, URLS)

    def latest(self) -> int:
        return self.folders.latest()

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("url"), F.lit(self.buckets))

    def cell(self) -> Column:
        return F.pmod(F.xxhash64("url", F.lit("cell")), F.lit(self.cells))

    def bits(self) -> list[Column]:
        return [F.pmod(F.xxhash64("url", F.lit(k)), F.lit(BITS)) for k in range(HASHES)]

    def read(self, version: int | None = None) -> DataFrame:
        return self.folders.read(self.folders.live(self.latest() if version is None else version).collect())

    def _index(self, version: int) -> DataFrame:
        """``cell, bitmap`` of all URLs up to a version; a cell has a row for each version that set bits in it."""
        base = max([v for v in self._index_versions("index") if v <= version], default=0)
        paths = [f"{self.path}/index/version={base}"] if base else []
        live = {row["version"] for row in self.folders.live(version).select("version").distinct().collect()}
        paths += [f"{self.path}/bits/version={v}" for v in self._index_versions("bits") if base < v <= version and v in live]
        if not paths:
            return self.spark.createDataFrame([], "cell bigint, bitmap binary")
        return self.spark.read.schema("cell bigint, bitmap binary").parquet(*paths)

    def _index_versions(self, kind: str) -> list[int]:
        return complete_versions(self.spark, f"{self.path}/{kind}")

    def maybe_seen(self, candidates: DataFrame, version: int | None = None) -> DataFrame:
        """The candidates whose bits are all set: every one seen before, and few others."""
        version = self.latest() if version is None else version
        marked = candidates.withColumns({"cell__": self.cell(), **{f"bit{k}__": bit for k, bit in enumerate(self.bits())}})
        is_set = F.lit(True)
        for k in range(HASHES):
            byte = f"cast(conv(hex(substring(bitmap, cast(bit{k}__ div 8 as int) + 1, 1)), 16, 10) as int)"
            is_set &= F.expr(f"getbit({byte}, cast(bit{k}__ % 8 as int))") == 1
        index = self._index(version)
        return marked.join(index, (F.col("cell__") == F.col("cell")) & is_set, "left_semi").select(*candidates.columns)

    def unseen(self, candidates: DataFrame, *order_cols: str, version: int | None = None) -> Unseen:
        """The candidates that are no trap and not in the table, each URL once (the first by ``order_cols``).

        Buckets in which no candidate may lie are not read.
        """
        version = self.latest() if version is None else version
        kept = drop_trap_urls(candidates)
        once = first_occurrence(kept, *order_cols) if order_cols else kept.dropDuplicates(["url"])
        path = scratch_path(self.spark, "candidates")
        once = written(once.select(*candidates.columns), f"{path}/once")
        maybe = written(self.maybe_seen(once.select("url"), version).withColumn("bucket", self.bucket()), f"{path}/maybe")
        asked = [row["bucket"] for row in maybe.select("bucket").distinct().collect()]  # at most one for each bucket
        entries = self.folders.live(version).where(F.col("part").isin(asked)).collect() if asked else []
        if not entries:
            return Unseen(once, path)
        known = maybe.select("url").join(self.folders.read(entries), "url", "left_semi")
        return Unseen(once.join(known, "url", "left_anti").select(*candidates.columns), path)

    def add(self, new: DataFrame, version: int | None = None, before: int | None = None) -> int:
        """Write URLs that are not in the table as a version; its number."""
        before = self.latest() if before is None else before
        version = before + 1 if version is None else version
        entries = self.folders.write(new.select("url"), version, self.bucket())
        added = self.folders.read(entries.collect())
        bits = added.select(self.cell().alias("cell"), F.explode(F.array(*self.bits())).alias("bit"))
        bits.groupBy("cell").agg(F.bitmap_construct_agg("bit").alias("bitmap")).write.mode("overwrite").parquet(
            f"{self.path}/bits/version={version}")
        if version % MANY_VERSIONS == 0:
            (self._index(before).unionByName(self.spark.read.parquet(f"{self.path}/bits/version={version}"))
             .groupBy("cell").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
             .write.mode("overwrite").parquet(f"{self.path}/index/version={version}"))
        self.folders.commit(version, self.folders.live(before).unionByName(entries))
        return version

    def admit(self, candidates: DataFrame, *order_cols: str, version: int | None = None) -> DataFrame:
        """Add the unseen candidates to the table; they are returned, read from there on."""
        before = self.latest()
        if version is not None and before >= version:
            raise ValueError(f"version {version} is complete")
        found = self.unseen(candidates, *order_cols, version=before)
        path = scratch_path(self.spark, "admitted")
        new = written(found.new, path)
        drop_path(self.spark, found.path)
        self.add(new, version, before)
        return new
