"""URL arrivals as a stream: admission and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkgraph.operators.frontier import drop_trap_urls

# Fixed value: how often output files are rotated.
ROTATION = "30 seconds"


def stream_admit(arrivals: DataFrame, seen: DataFrame | None = None,
                 watermark: tuple[str, str] | None = None) -> DataFrame:
    """Let every URL through once, as a stream that other operators can follow (``start_admission`` writes tables).

    URLs are remembered for good (RocksDB keeps that state off the heap), or with ``watermark``, a
    time column and a delay, only that long. ``seen`` holds URLs known before the stream began.
    Repeats close to each other go before the shuffle, as the stateful operator does not combine
    them and a much-repeated URL would all land in one task.
    """
    def drop_near_repeats(batches):
        for batch in batches:
            yield batch.drop_duplicates("url")

    kept = drop_trap_urls(arrivals).mapInPandas(drop_near_repeats, arrivals.schema)
    if seen is not None:
        kept = kept.join(seen.select("url"), "url", "left_anti")
    if watermark is not None:
        return kept.withWatermark(*watermark).dropDuplicatesWithinWatermark(["url"])
    return kept.dropDuplicates(["url"])


def arrivals_per_window(events: DataFrame, ts: str = "ts", every: str = ROTATION,
                        delay: str = "1 minute") -> DataFrame:
    """``window_start, window_end, n``: how many arrivals a rolled file holds.

    The watermark bounds the state of a stream and does nothing in a batch.
    """
    events = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return (events.withWatermark(ts, delay).groupBy(F.window(ts, every)).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n"))
