"""Politeness over a stream: host times carried from batch to batch.

Each batch is scheduled like a table, so a hot host is spread over tasks, and writes the hosts whose
time moved or that were registered. Every few batches all hosts are written, so a batch reads a bounded number
of folders; it joins only the hosts it has URLs of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from linkgraph.operators.frontier import schedule
from linkgraph.streaming.admit import ROTATION
from linkgraph.streaming.sinks import trigger_options

HOST_COLUMNS = ("host", "crawl_delay", "next_request_ms")


REGISTERED = "is_registration"


def host_times(host_state: DataFrame, path: str, batch_id: int, snapshot: int,
               wanted: DataFrame | None = None, entered: DataFrame | None = None) -> DataFrame:
    """Host state before batch ``batch_id``, from the snapshot of a batch (0: none) and later moves.

    ``wanted`` (``host``) limits it to some hosts before anything is grouped; ``entered`` has further host rows.
    A host's time only grows, so the latest state of a host is the one with the greatest time.
    """
    base = host_state.select(*HOST_COLUMNS)
    reader = host_state.sparkSession.read.schema(base.schema)
    if snapshot > 0:
        base = reader.parquet(f"{path}/snapshots/batch={snapshot}")
    first = snapshot + 1 if snapshot > 0 else 0
    moved = [f"{path}/hosts/batch={b}" for b in range(first, batch_id)]
    later = [reader.parquet(*moved)] if moved else []
    later += [entered.select(*HOST_COLUMNS)] if entered is not None else []
    if wanted is not None:
        base, *later = (rows.join(wanted.select("host").distinct(), "host", "left_semi") for rows in (base, *later))
    for rows in later:
        base = base.unionByName(rows)
    if not later:
        return base
    return base.groupBy("host").agg(
        F.max_by("crawl_delay", "next_request_ms").alias("crawl_delay"),
        F.max("next_request_ms").alias("next_request_ms"))


def with_registrations(arrivals: DataFrame, registrations: DataFrame | None) -> DataFrame:
    """One stream of URLs and of host rows, which are marked in ``is_registration``."""
    plain = arrivals.withColumn(REGISTERED, F.lit(False))
    missing = [c for c in HOST_COLUMNS if c not in arrivals.columns]
    types = {"host": "string", "crawl_delay": "double", "next_request_ms": "bigint"}
    plain = plain.withColumns({c: F.lit(None).cast(types[c]) for c in missing})
    if registrations is None:
        return plain
    return plain.unionByName(registrations.select(*HOST_COLUMNS).withColumn(REGISTERED, F.lit(True)),
                             allowMissingColumns=True)


def start_schedule(arrivals: DataFrame, host_state: DataFrame, path: str, checkpoint: str,
                   order_col: str = "arrival", snapshot_every: int = 100, every: str = ROTATION,
                   available_now: bool = False, registrations: DataFrame | None = None) -> StreamingQuery:
    """Schedule a stream of new URLs (``url, host`` and ``order_col``) to ``frontier/batch=N``.

    ``registrations`` is a stream of hosts (``host, crawl_delay, next_request_ms``) that become known while this
    one runs; the URLs of the same batch already see them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            urls = batch.where(~F.col(REGISTERED)).select(*arrivals.columns)
            entered = batch.where(F.col(REGISTERED)).select(*HOST_COLUMNS)
            last = max(batch_id - 1, 0) // snapshot_every * snapshot_every
            known = host_times(host_state, path, batch_id, last, wanted=batch, entered=entered)
            result = schedule(urls, known, order_col)
            result.frontier.write.mode("overwrite").parquet(f"{path}/frontier/batch={batch_id}")
            moved = result.moved.select(*HOST_COLUMNS).unionByName(entered)
            moved.write.mode("overwrite").parquet(f"{path}/hosts/batch={batch_id}")
            if batch_id > 0 and batch_id % snapshot_every == 0:
                host_times(host_state, path, batch_id + 1, last).write.mode(
                    "overwrite").parquet(f"{path}/snapshots/batch={batch_id}")
        finally:
            batch.unpersist()

    stream = with_registrations(arrivals, registrations)
    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(every, available_now)).start())
