"""Admission of URL arrivals by the stored table of all URLs ever seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from linkgraph.session import drop_path
from linkgraph.stored.live import names_in
from linkgraph.stored.seen import SeenTable
from linkgraph.streaming.admit import ROTATION
from linkgraph.streaming.sinks import trigger_options


def start_admission(arrivals: DataFrame, seen: SeenTable, path: str, checkpoint: str, *order_cols: str,
                    every: str = ROTATION, available_now: bool = False) -> StreamingQuery:
    """Write the URLs of every batch that ``seen`` does not hold to ``admitted/batch=N``, and add them to it.

    The table is the only memory, shared with batch rounds between two runs of the stream. A batch makes the version
    after that of the batch before; one that is tried again finds its version or, if it was cut off, what was
    there before it, so nothing is let through twice. There must be one writer of the table at a time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/admitted/batch={batch_id}"
        spark = batch.sparkSession
        done = names_in(spark, f"{path}/versions")
        if f"batch={batch_id}" in done and "_SUCCESS" in names_in(spark, f"{path}/versions/batch={batch_id}"):
            before = spark.read.schema("version bigint").parquet(f"{path}/versions/batch={batch_id}").first()["version"]
        else:
            before = seen.latest()
            spark.createDataFrame([(before,)], "version bigint").write.mode("overwrite").parquet(
                f"{path}/versions/batch={batch_id}")
        found = seen.unseen(batch, *order_cols, version=before)
        found.new.write.mode("overwrite").parquet(target)
        drop_path(spark, found.path)
        if seen.latest() == before:
            seen.add(spark.read.schema(batch.schema).parquet(target), before + 1, before)

    return (arrivals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(every, available_now)).start())
