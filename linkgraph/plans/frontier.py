"""One round of the crawl frontier: responses and links in, due URLs and new tables out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from linkgraph.functions.urls import host_of
from linkgraph.operators.frontier import (
    BYTES_PER_MB, admit, pop_due, registered, route_fetches, schedule)
from linkgraph.operators.pages import candidate_urls
from linkgraph.operators.robots import host_policy, is_excluded, search_list, tested_text
from linkgraph.operators.tables import upsert
from linkgraph.session import checkpointed

FRONTIER_COLUMNS = ("url", "host", "next_request_ms")


class Round(NamedTuple):
    """``fetch``: pages to download; ``due``: URLs to request now; the rest: the tables afterwards."""
    fetch: DataFrame
    due: DataFrame
    frontier: DataFrame
    seen: DataFrame
    host_state: DataFrame


def frontier_round(fetch_log: DataFrame, pages: DataFrame, frontier: DataFrame, seen: DataFrame,
                   host_state: DataFrame, robots_rules: DataFrame, now_ms: int, agent: str,
                   max_bytes: int = BYTES_PER_MB, match_on: str = "path") -> Round:
    """Route responses, admit and schedule new URLs, and take out what is due and allowed.

    ``pages`` holds HTML, or the ``targets`` that ``crawl_outputs`` already made of it.
    Redirect targets and page links go through the same admission, redirects first; a redirect
    keeps the time of the host that sent it. Due URLs of hosts not known yet enter the host and wait
    for its delay. The admitted URLs and the outcome of the round, which several branches read, are
    written once to the checkpoint folder. All that is known of a host is brought together first, so
    that due URLs are joined by host once.
    """
    routed = route_fetches(fetch_log, host_state, max_bytes)
    redirects = routed.where(F.col("action") == "redirect").select(
        F.col("target").alias("url"), host_of(F.col("target")).alias("host"),
        F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("page_id"), F.lit(0).alias("ord"),
        "next_request_ms")
    links = candidate_urls(pages).select(
        "url", "host", F.lit(1).alias("kind"), "page_id", "ord",
        F.lit(None).cast("bigint").alias("next_request_ms"))
    candidates = redirects.unionByName(links)
    new = checkpointed(admit(candidates, seen, "kind", "page_id", "ord", "next_request_ms").new)
    scheduled = schedule(
        new.where(F.col("kind") == 1).select("url", "host", "page_id", "ord"),
        host_state, "page_id", "ord")
    additions = scheduled.frontier.select(*FRONTIER_COLUMNS).unionByName(
        new.where(F.col("kind") == 0).select(*FRONTIER_COLUMNS))
    waiting = upsert(frontier.select(*FRONTIER_COLUMNS), additions, "url")
    ready, rest = pop_due(waiting, now_ms)
    hosts = checkpointed(host_state.select("host", F.lit(True).alias("known")).join(
        host_policy(robots_rules, agent).withColumn("prefixes", search_list("prefixes", match_on)),
        "host", "full_outer"))
    checked = ready.withColumn("tested", tested_text(F.col("url"), match_on)).join(hosts, "host", "left")
    state = (F.when(F.col("known").isNull(), "unknown")
             .when(is_excluded("tested", "prefixes"), "excluded").otherwise("due"))
    outcome = checkpointed(
        checked.select(*FRONTIER_COLUMNS, "crawl_delay", state.alias("state")).unionByName(
            rest.select(*FRONTIER_COLUMNS, F.lit(None).cast("double").alias("crawl_delay"),
                        F.lit("queued").alias("state"))))
    entered = registered(
        outcome.where(F.col("state") == "unknown").select("url", "host", "crawl_delay"), now_ms)
    queued = outcome.where(F.col("state") == "queued").select(*FRONTIER_COLUMNS)
    return Round(
        routed.where(F.col("action") == "fetch").select("url", "content_type", "next_request_ms"),
        outcome.where(F.col("state") == "due").select(*FRONTIER_COLUMNS),
        queued.unionByName(entered.requeued.select(*FRONTIER_COLUMNS)),
        seen.select("url").unionByName(new.select("url")),
        scheduled.host_state.unionByName(entered.new_hosts.select(*host_state.columns)))
