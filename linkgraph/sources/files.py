"""Files of a watched folder: listing, and an archive that takes each file once and keeps a log of it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkgraph.session import drop_path, written
from linkgraph.sources.urls import files_to_copy
from linkgraph.stored.keyed import KeyedTable

BROADCAST_KEYS = 1_000_000  # file names that may be broadcast; more are joined by a shuffle


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """All files under a folder, with ``key``, their path within it; ``content`` is read only if it is used."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    start = len(system.makeQualified(root).toString()) + 2
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.withColumn("key", F.substr("path", F.lit(start)))


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """``key, is_dir, modified_ms, length`` of the files of a folder, or of all folders under it.

    Files without a byte and names that begin with ``_`` or ``.`` are left out, as Spark does for all sources; a
    file that gets its first byte later is listed then. No file is opened.
    """
    files = _files(spark, folder)
    if not recursive:
        files = files.where(~F.col("key").contains("/"))
    return files.select("key", F.lit(False).alias("is_dir"), F.unix_millis("modificationTime").alias("modified_ms"),
                        "length")


class Copied(NamedTuple):
    """``version`` of the archive after a run, and the ``key``, ``modified_ms`` and ``length`` of what it took."""
    version: int
    files: DataFrame


class FileArchive:
    """Small files packed into Parquet under ``path``, and the log of those that were taken.

    A run lists the folder, takes the files that have settled and are not in the log, and then writes the
    log. A run that was cut off before that is done again under the same number and replaces what it left.
    A file is one row, so it must be below ``spark.sql.sources.binaryFile.maxLength``. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path = spark, path.rstrip("/")
        schema = spark.createDataFrame([], "key string, modified_ms bigint, length bigint, taken bigint").schema
        self.taken = KeyedTable(spark, f"{self.path}/log", schema, "key", buckets)

    def log(self) -> DataFrame:
        """``key, modified_ms, length, taken``: every file, and the number of the run that took it."""
        return self.taken.read()

    def read(self) -> DataFrame:
        """``key, content`` of every file in the log, with ``taken``."""
        versions = [row["taken"] for row in self.log().select("taken").distinct().collect()]  # one a run
        schema = "key string, modified_ms bigint, length bigint, content binary, taken bigint"
        if not versions:
            return self.spark.createDataFrame([], schema).select("key", "content", "taken")
        return self.spark.read.schema(schema).parquet(*[self._content(v) for v in versions]).select(
            "key", "content", "taken")

    def _content(self, version: int) -> str:
        return f"{self.path}/content/version={version}"

    def copy_new(self, folder: str, now_ms: int, settle_ms: int = 60_000, recursive: bool = False) -> Copied:
        """Take the new files of a folder.

        Their names are found from the listing alone. Then only files between the first and the last change
        of these are opened, and of them only the new ones are kept. What is deleted meanwhile is not logged.
        """
        before, version = self.taken.latest(), self.taken.latest() + 1
        pending_path = f"{self.path}/pending/version={version}"
        listed = list_files(self.spark, folder, recursive)
        pending = written(files_to_copy(listed, self.log(), now_ms, settle_ms).select("key", "modified_ms"), pending_path)
        found = pending.agg(F.count("*").alias("n"), F.min("modified_ms").alias("first"),
                            F.max("modified_ms").alias("last")).first()
        nothing = self.spark.createDataFrame([], "key string, modified_ms bigint, length bigint")
        if not found["n"]:
            drop_path(self.spark, pending_path)
            return Copied(before, nothing)
        keys = pending.select("key")
        keys = F.broadcast(keys) if found["n"] <= BROADCAST_KEYS else keys
        changed = F.col("modificationTime")
        rows = _files(self.spark, folder).where(
            (changed >= F.timestamp_millis(F.lit(found["first"])))
            & (changed < F.timestamp_millis(F.lit(found["last"] + 1)))).join(keys, "key", "left_semi")
        copied = written(rows.select(
            "key", F.unix_millis("modificationTime").alias("modified_ms"), "length", "content",
            F.lit(version).cast("bigint").alias("taken")), self._content(version))
        self.taken.put(copied.select("key", "modified_ms", "length", "taken"), version=version)
        drop_path(self.spark, pending_path)
        return Copied(version, copied.select("key", "modified_ms", "length"))
