"""The crawl frontier as stored tables: two timed queues, one memory of seen URLs, host times.

A round reads the slots that are due and the hosts and buckets it needs, and writes what changed. HEAD requests wait
in one queue, pages to download in the other. All tables take the number of the round, and a round counts once its
own mark is written: a round that was cut off is tried again with the same number and finds everything as it was.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from linkgraph.functions.urls import host_of
from linkgraph.operators.frontier import BYTES_PER_MB, DUE_HORIZON_MS, registered, route_fetches, schedule
from linkgraph.operators.pages import candidate_urls
from linkgraph.operators.robots import host_policy, is_excluded, search_list, tested_text
from linkgraph.session import drop_path, written
from linkgraph.stored.keyed import KeyedTable
from linkgraph.stored.live import complete_versions
from linkgraph.stored.ordered import SlotTable
from linkgraph.stored.seen import SeenTable

HEAD_SCHEMA = StructType([StructField("url", StringType()), StructField("host", StringType()),
                          StructField("next_request_ms", LongType())])
GET_SCHEMA = StructType([*HEAD_SCHEMA.fields, StructField("content_type", StringType())])
HOST_SCHEMA = StructType([StructField("host", StringType()), StructField("crawl_delay", DoubleType()),
                          StructField("next_request_ms", LongType())])
HEAD_COLUMNS = ("url", "host", "next_request_ms")
GET_COLUMNS = (*HEAD_COLUMNS, "content_type")


class StoredRound(NamedTuple):
    """What a round did: ``fetch`` pages to download now, ``due`` URLs to send HEAD requests for now, and the changes:
    ``new`` URLs admitted, with their times; URLs ``removed`` from the HEAD queue for good (``state`` due or excluded);
    hosts ``moved`` or entered, with their new times."""
    version: int
    fetch: DataFrame
    due: DataFrame
    new: DataFrame
    removed: DataFrame
    moved: DataFrame


class StoredFrontier:
    """The tables of one crawl under ``path``."""

    def __init__(self, spark: SparkSession, path: str, slot_ms: int = 60_000, buckets: int = 64, cells: int = 1024):
        self.spark, self.path = spark, path.rstrip("/")
        self.head = SlotTable(spark, f"{self.path}/head", HEAD_SCHEMA, slot_ms)
        self.get = SlotTable(spark, f"{self.path}/get", GET_SCHEMA, slot_ms)
        self.seen = SeenTable(spark, f"{self.path}/seen", buckets, cells)
        self.hosts = KeyedTable(spark, f"{self.path}/hosts", HOST_SCHEMA, "host", buckets)

    def version(self) -> int:
        """The number of the last complete round."""
        return max(complete_versions(self.spark, f"{self.path}/rounds"), default=0)

    def _complete(self, version: int) -> None:
        self.spark.range(version, version + 1).write.mode("overwrite").parquet(f"{self.path}/rounds/version={version}")

    def begin(self, frontier: DataFrame, host_state: DataFrame, seen: DataFrame | None = None,
              get_queue: DataFrame | None = None) -> int:
        """Fill an empty store; the URLs of both queues count as seen."""
        if self.version():
            raise ValueError(f"{self.path} is not empty")
        urls = frontier.select("url")
        for more in (seen, get_queue):
            if more is not None:
                urls = urls.unionByName(more.select("url"))
        self.head.change(added=frontier.select(*HEAD_COLUMNS), version=1, before=0)
        self.get.change(added=None if get_queue is None else get_queue.select(*GET_COLUMNS), version=1, before=0)
        self.seen.add(urls.distinct(), version=1, before=0)
        self.hosts.put(host_state.select("host", "crawl_delay", "next_request_ms"), version=1, before=0)
        self._complete(1)
        return 1

    def clear(self) -> int:
        """Empty both queues; what was seen and the hosts stay."""
        before = self.version()
        version = before + 1
        for queue in (self.head, self.get):
            queue.folders.commit(version, queue.folders.live(0))
        for folders in (self.seen.folders, self.hosts.base):
            folders.commit(version, folders.live(before))
        self._complete(version)
        return version

    def forget(self, rounds: int = 2) -> None:
        """Delete what only rounds before the last few read."""
        before = self.version() - rounds + 1
        for folders in (self.head.folders, self.get.folders, self.seen.folders, self.hosts.base):
            folders.forget(before)

    def round(self, fetch_log: DataFrame, pages: DataFrame, robots_rules: DataFrame, now_ms: int, agent: str,
              max_bytes: int = BYTES_PER_MB, match_on: str = "path", horizon_ms: int = DUE_HORIZON_MS) -> StoredRound:
        """Route responses, admit and schedule new URLs, take what is due from both queues.

        ``pages`` holds HTML, or the ``targets`` that ``crawl_outputs`` already made of it. A response that is to be
        fetched waits in the GET queue for the time of its host. The rest is as in ``frontier_round``; as all
        URLs of the queues have been seen, a URL that is admitted is in neither.
        """
        before = self.version()
        version = before + 1
        out = f"{self.path}/changes/version={version}"
        hosts = self.hosts.read(before)
        routed = route_fetches(fetch_log, hosts, max_bytes)
        redirects = routed.where(F.col("action") == "redirect").select(
            F.col("target").alias("url"), host_of(F.col("target")).alias("host"), F.lit(0).alias("kind"),
            F.lit(0).cast("bigint").alias("page_id"), F.lit(0).alias("ord"), "next_request_ms")
        links = candidate_urls(pages).select(
            "url", "host", F.lit(1).alias("kind"), "page_id", "ord", F.lit(None).cast("bigint").alias("next_request_ms"))
        found = self.seen.unseen(redirects.unionByName(links), "kind", "page_id", "ord", "next_request_ms", version=before)
        admitted = written(found.new, f"{out}/admitted")
        drop_path(self.spark, found.path)
        timed = schedule(admitted.where(F.col("kind") == 1).select("url", "host", "page_id", "ord"), hosts, "page_id", "ord")
        new = written(timed.frontier.select(*HEAD_COLUMNS).unionByName(
            admitted.where(F.col("kind") == 0).select(*HEAD_COLUMNS)), f"{out}/new")

        is_due = F.coalesce(F.col("next_request_ms") < now_ms + horizon_ms, F.lit(True))
        taken = self.head.take_due(now_ms, horizon_ms, before)
        ready = taken.rows.select(*HEAD_COLUMNS).unionByName(new.where(is_due))
        policy = hosts.select("host", F.lit(True).alias("known")).join(
            host_policy(robots_rules, agent).withColumn("prefixes", search_list("prefixes", match_on)),
            "host", "full_outer")
        state = (F.when(F.col("known").isNull(), "unknown")
                 .when(is_excluded("tested", "prefixes"), "excluded").otherwise("due"))
        outcome = written(
            ready.withColumn("tested", tested_text(F.col("url"), match_on)).join(policy, "host", "left")
            .select(*HEAD_COLUMNS, "crawl_delay", state.alias("state")), f"{out}/outcome")
        entered = registered(outcome.where(F.col("state") == "unknown").select("url", "host", "crawl_delay"), now_ms)
        self.head.change(entered.requeued.select(*HEAD_COLUMNS).unionByName(new.where(~is_due)), taken, version, before)

        responses = routed.where(F.col("action") == "fetch").groupBy("url").agg(
            F.min(F.struct("next_request_ms", "content_type")).alias("first")).select(
            "url", host_of(F.col("url")).alias("host"), "first.next_request_ms", "first.content_type")
        responses = written(responses, f"{out}/responses")
        pulled = self.get.take_due(now_ms, horizon_ms, before)
        fetch = written(pulled.rows.unionByName(responses.where(is_due)), f"{out}/fetch")
        self.get.change(responses.where(~is_due), pulled, version, before)

        moved = written(timed.moved.select("host", "crawl_delay", "next_request_ms").unionByName(
            entered.new_hosts.select("host", "crawl_delay", "next_request_ms")), f"{out}/moved")
        self.hosts.put(moved, version=version, before=before)
        self.seen.add(new, version, before)
        self._complete(version)
        return StoredRound(
            version, fetch, outcome.where(F.col("state") == "due").select(*HEAD_COLUMNS), new,
            outcome.where(F.col("state") != "unknown").select(*HEAD_COLUMNS, "state"), moved)
