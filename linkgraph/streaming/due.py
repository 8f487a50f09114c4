"""Release of scheduled URLs when their time comes.

URLs that wait are written once, in folders by time, and never rewritten: a batch releases the time range that has
passed since the batch before, and reads only the folders of that range, by path. A folder holds one slot of the near
future, and the further off the more slots, so a batch writes few folders however far its URLs reach. A clock tick
next to the URLs makes a batch also while none arrive.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from linkgraph.operators.frontier import DUE_HORIZON_MS
from linkgraph.operators.skew import balanced_by
from linkgraph.stored.live import names_in
from linkgraph.streaming.admit import ROTATION
from linkgraph.streaming.sinks import trigger_options

BY_SLOT_AND_BATCH = (StructField("slot", LongType()), StructField("batch", LongType()))
TICK = "is_tick"

# Slots up to 64 ahead have folders of their own, up to 64 times 64 ahead one for 64 of them, and so on.
SPAN = 64
LEVELS = 6
MANY_SLOTS = 4096  # a clock that goes on by more is served from a listing


def wall_clock(batch_id: int) -> int:
    return int(time.time() * 1000)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that are there, on whatever file system."""
    found = []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
            found.append(path)
    return found


def falls_due(until: int) -> Column:
    """Whether a URL's time lies before ``until``; one without a time falls due at once."""
    return F.coalesce(F.col("next_request_ms") < until, F.lit(True))


def folder_slot(base: int, slot_ms: int) -> Column:
    """The first slot of the folder in which a URL waits, by how far its time lies ahead of ``base``."""
    slot = F.floor(F.col("next_request_ms") / slot_ms)
    ahead = slot - base // slot_ms
    first = slot - F.pmod(slot, F.lit(SPAN ** (LEVELS - 1)))
    for level in reversed(range(LEVELS - 1)):
        first = F.when(ahead < SPAN ** (level + 1), slot - F.pmod(slot, F.lit(SPAN ** level))).otherwise(first)
    return first


def folders_of_range(spark: SparkSession, path: str, since: int, until: int, slot_ms: int) -> list[str]:
    """The folders under ``path`` in which URLs with times from ``since`` to ``until`` may wait."""
    first, last = since // slot_ms, until // slot_ms
    reaching = {first - first % SPAN ** level for level in range(LEVELS)}
    if last - first > MANY_SLOTS:
        there = {int(name.split("=")[1]) for name in names_in(spark, path) if name.startswith("slot=")}
        return [f"{path}/slot={slot}" for slot in sorted(there) if slot in reaching or first <= slot <= last]
    return existing(spark, [f"{path}/slot={slot}" for slot in sorted(reaching | {*range(first, last + 1)})])


def with_ticks(rows: DataFrame) -> DataFrame:
    """A stream with a row of NULLs in every batch, marked in ``is_tick``, so that batches never cease."""
    ticks = (rows.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", 1)
             .option("startTimestamp", 0).load())
    empty = ticks.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields],
                         F.lit(True).alias(TICK))
    return rows.withColumn(TICK, F.lit(False)).unionByName(empty)


def start_due(scheduled: DataFrame, path: str, checkpoint: str,
              clock: Callable[[int], int] = wall_clock, horizon_ms: int = DUE_HORIZON_MS,
              slot_ms: int = 60_000, every: str = ROTATION,
              available_now: bool = False) -> StreamingQuery:
    """Write the URLs of a frontier stream that fall due in a batch to ``due/batch=N``.

    ``clock`` gives the present, in milliseconds, for a batch number. The end of the released range
    is stored with every batch; it never goes back. A batch looks at the slots between the two ends and at the
    folders of many slots that reach into them, so what it lists does not grow with the age of the stream.
    """
    waiting_schema = StructType([*scheduled.schema.fields, *BY_SLOT_AND_BATCH])

    def late(spark: SparkSession, since: int, until: int, batch_id: int) -> DataFrame | None:
        paths = folders_of_range(spark, f"{path}/waiting", since, until, slot_ms)
        if not paths:
            return None
        waiting = spark.read.schema(waiting_schema).option("basePath", f"{path}/waiting").parquet(*paths)
        return waiting.where((F.col("batch") < batch_id) & (F.col("next_request_ms") >= since)
                             & (F.col("next_request_ms") < until)).select(*scheduled.columns)

    def first_base(spark: SparkSession, until: int) -> int:
        """What the first batch counts slots from, the same whenever it is tried."""
        if "_SUCCESS" not in names_in(spark, f"{path}/begin"):
            spark.createDataFrame([(until,)], "until bigint").write.mode("overwrite").parquet(f"{path}/begin")
        return spark.read.schema("until bigint").parquet(f"{path}/begin").first()["until"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        until = clock(batch_id) + horizon_ms
        urls = batch.where(~F.col(TICK)).drop(TICK).persist()
        try:
            due = urls.where(falls_due(until))
            if batch_id > 0:
                since = spark.read.schema("until bigint").parquet(
                    f"{path}/ends/batch={batch_id - 1}").first()["until"]
                until = max(until, since)
                due = urls.where(falls_due(until))
                released = late(spark, since, until, batch_id)
                if released is not None:
                    due = due.unionByName(released)
            # a batch that is tried again puts URLs into the same folders and replaces them; what an earlier try left
            # in others lies before the end of the range and is not read
            base = since if batch_id > 0 else first_base(spark, until)
            waiting = urls.where(F.col("next_request_ms") >= until).withColumns(
                {"slot": folder_slot(base, slot_ms), "batch": F.lit(batch_id)})
            (balanced_by(waiting, "slot").sortWithinPartitions("slot", "batch", "next_request_ms")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("slot", "batch").parquet(f"{path}/waiting"))
            due.write.mode("overwrite").parquet(f"{path}/due/batch={batch_id}")
            spark.createDataFrame([(until,)], "until bigint").write.mode("overwrite").parquet(
                f"{path}/ends/batch={batch_id}")
        finally:
            urls.unpersist()

    return (with_ticks(scheduled).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(every, available_now)).start())
