"""Stream outputs: rolled files, and documents with links from one page stream.

Every batch writes a folder named by its number and replaces what an earlier try left there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from linkgraph.operators.pages import crawl_outputs, page_links
from linkgraph.operators.skew import balanced_by
from linkgraph.streaming.admit import ROTATION


def trigger_options(every: str, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": every}


def start_rolling_sink(stream: DataFrame, path: str, checkpoint: str, every: str = ROTATION,
                       format: str = "parquet", available_now: bool = False) -> StreamingQuery:
    """Append the stream to new files every ``every``."""
    return (stream.writeStream.format(format).outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(every, available_now)).start())


def with_rolling_window(rows: DataFrame, ts: str = "ts", every: str = ROTATION) -> DataFrame:
    """Add ``window_start``, the file a row falls into when a batch is cut by time."""
    return rows.withColumn("window_start", F.window(ts, every)["start"])


def write_rolled(rows: DataFrame, path: str, ts: str = "ts", every: str = ROTATION,
                 mode: str = "error") -> None:
    """Batch twin of the rolling sink: one folder per window."""
    balanced_by(with_rolling_window(rows, ts, every), "window_start").write.mode(mode).partitionBy("window_start").parquet(path)


def start_crawl_outputs(pages: DataFrame, path: str, checkpoint: str, every: str = ROTATION,
                        available_now: bool = False) -> StreamingQuery:
    """Write ``documents/batch=N`` and ``links/batch=N`` under ``path`` from a page stream.

    The two writes prune each other's columns, so each does only its own work on the HTML.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        outputs = crawl_outputs(batch)
        outputs.select("url", "body").write.mode("overwrite").parquet(
            f"{path}/documents/batch={batch_id}")
        page_links(outputs).write.mode("overwrite").parquet(f"{path}/links/batch={batch_id}")

    return (pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(every, available_now)).start())
