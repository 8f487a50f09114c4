"""Queries over the given tables, one or more for every operator."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import closing
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import linkgraph as lg
from catalog.inputs import AGENT, MAX_BYTES, NOW_MS, load
from linkgraph.functions.buckets import host_bucket
from linkgraph.functions.html import decode_references
from linkgraph.functions.text import normalise_body
from linkgraph.functions.urls import host_of, url_parts
from linkgraph.operators.edges import edge_pairs
from linkgraph.operators.ranking import contributions
from linkgraph.operators.skew import order_splits
from linkgraph.session import checkpointed, scratch_path, written
from linkgraph.sources.documents import read_documents, write_documents
from linkgraph.sources.links import link_lines, parse_links, write_links
from linkgraph.sources.urls import distinct_urls, files_to_copy, split_seeds
from linkgraph.streaming.sinks import with_rolling_window

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MARKER = "<<<end of document>>>"


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


def joined(name: str) -> Column:
    """An array as text, so that results compare as plain values."""
    return F.array_join(name, "|").alias(name)


def as_text(name: str) -> Column:
    """A time as text, the same with and without a time zone."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# Pages, links and URLs


@query
def flagship_page_ranks(spark, sf):
    """Pages to links, one rank step, rank order."""
    links = lg.page_links(lg.crawl_outputs(load(spark, sf, "pages")))
    return lg.pagerank(links, max_iter=1).select("node", rounded("rank"))


@query
def extract_links(spark, sf):
    return lg.extract_links(load(spark, sf, "pages"))


@query
def extract_links_hostile(spark, sf):
    """Pages wrapped in markup that is easy to get wrong, around their own anchors."""
    comments = F.lit("<!--><!-- <a href=/no> --!>")
    crowded = F.concat(F.lit("<a "), F.repeat(F.lit("u=a/b "), (F.col("page_id") % 90).cast("int")),
                       F.lit('class="k"href="/crowded?'), F.col("page_id"), F.lit('" title="<a href=/no>">'))
    ended = F.lit("<textarea><a href=/no></textarea ><a href = '/single'id=x><img alt='<a href=/no>'><a name=z>")
    html = F.concat(comments, crowded, F.col("html"), ended)
    return lg.extract_links(load(spark, sf, "pages").withColumn("html", html))


@query
def decode_references_pages(spark, sf):
    """References of every kind within the hrefs of pages."""
    tail = F.concat(F.lit("?a&#38;lt;&#00000065;&eacute;&amp;lt;&copy=1&NotEqualTilde;&#x20AC;&nope;&#128;"),
                    F.col("page_id"))
    return load(spark, sf, "pages").select("page_id", decode_references(F.concat("url", tail)).alias("href"))


@query
def resolve_links(spark, sf):
    return lg.resolve_links(lg.extract_links(load(spark, sf, "pages")))


@query
def resolve_link_shapes(spark, sf):
    """Hrefs of pages put into every shape an href can take, by page and position."""
    hrefs = lg.extract_links(load(spark, sf, "pages"))
    bare = F.substr("href", F.lit(2))
    shapes = F.array(
        F.col("href"), bare, F.concat(F.lit("//k.org"), F.col("href")),
        F.concat(F.lit("HTTPS://K.org"), F.col("href")), F.concat(F.lit("?q="), bare),
        F.concat(F.lit("#"), bare), F.concat(F.lit("mailto:"), bare, F.lit("@y.z")),
        F.concat(F.lit("javascript:"), bare), F.concat(bare, F.lit(" x")),
        F.concat(F.col("href"), F.lit("%zz")), F.concat(F.lit("../"), bare),
        F.concat(F.lit("http://h:80x"), F.col("href")), F.concat(F.lit("http://u@h:81"), F.col("href")),
        F.lit(""), F.concat(F.col("href"), F.lit("?a[]=1")), F.concat(F.col("href"), F.lit("[0]")))
    shaped = hrefs.select("page_id", "url", F.posexplode(shapes).alias("shape", "href"), "ord")
    return lg.resolve_links(shaped.select(
        "page_id", "url", (F.col("ord") * 100 + F.col("shape")).alias("ord"), "href"))


@query
def url_parts_of_pages(spark, sf):
    parts = url_parts(F.col("url"))
    return load(spark, sf, "pages").select(
        "page_id", parts["protocol"].alias("protocol"), parts["host"].alias("host"),
        parts["path"].alias("path"))


@query
def drop_trap_urls(spark, sf):
    trapped = load(spark, sf, "pages").select(
        "page_id", F.concat("url", F.repeat(F.lit("/.."), (F.col("page_id") % 5).cast("int"))).alias("url"))
    return lg.drop_trap_urls(trapped)


@query
def normalise_bodies(spark, sf):
    messy = F.concat(F.lit(" \r\n"), F.replace("html", F.lit("><"), F.lit(">\r\n\t<")), F.lit("\r \x01\n"))
    return load(spark, sf, "pages").select("page_id", normalise_body(messy).alias("body"))


@query
def crawl_outputs(spark, sf):
    return lg.crawl_outputs(load(spark, sf, "pages")).select("page_id", "url", "body", joined("targets"))


@query
def seed_urls(spark, sf):
    lists = load(spark, sf, "pages").select(
        F.concat_ws(",", "url", F.concat("url", F.lit("/a")), F.concat("url", F.lit("/b"))).alias("seeds"))
    return split_seeds(lists)


@query
def distinct_url_batch(spark, sf):
    padded = load(spark, sf, "arrivals").select(F.concat(F.lit("  "), F.col("url"), F.lit(" ")).alias("value"))
    return distinct_urls(padded)


@query
def url_batch_candidates(spark, sf):
    """Page URLs in shapes of which some can be fetched."""
    shapes = F.array(
        F.col("url"), F.replace("url", F.lit("://"), F.lit("://u@")), F.concat(F.lit("mailto:"), F.col("url")),
        F.concat(F.lit("ftp://x.org/"), F.col("page_id")), F.concat(F.lit("HTTP://H.org:8080/"), F.col("page_id")),
        F.concat(F.lit("http://h.org:port/"), F.col("page_id")), F.concat(F.lit("/"), F.col("page_id")))
    return lg.url_candidates(load(spark, sf, "pages").select(F.explode(shapes).alias("url")))


# Edges and ranks


def links_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("source"), F.array("dst").alias("targets"))


@query
def page_edges(spark, sf):
    return lg.drop_self_links(lg.to_edges(lg.page_links(lg.crawl_outputs(load(spark, sf, "pages")))))


@query
def link_list_round_trip(spark, sf):
    """Page links written as text lines and parsed back; commas in URLs end them."""
    links = lg.page_links(lg.crawl_outputs(load(spark, sf, "pages")))
    return parse_links(link_lines(links)).select("source", joined("targets"))


@query
def pair_counts(spark, sf):
    return edge_pairs(load(spark, sf, "event_edges"))


@query
def edge_weights(spark, sf):
    return lg.weighted_edges(load(spark, sf, "event_edges")).select("src", "dst", rounded("w"))


@query
def pagerank_init_parts(spark, sf):
    return lg.pagerank_init(links_of(load(spark, sf, "part_edges")))


@query
def pagerank_contributions_events(spark, sf):
    graph = lg.link_graph(load(spark, sf, "event_edges"))
    received = checkpointed(contributions(lg.initial_state(graph), graph))
    graph.release()
    return received.select(F.col("dst").alias("node"), rounded("received"))


def ranked(edges: DataFrame, steps: int, **options) -> DataFrame:
    return lg.rank_edges(edges, max_iter=steps, **options)


def kept_edges(spark, sf, name: str) -> DataFrame:
    """Edges that are read more than once, derived once."""
    return written(load(spark, sf, name), scratch_path(spark, "edges"))


@query
def pagerank_step_supply(spark, sf):
    state = ranked(load(spark, sf, "supply_edges"), 1)
    return state.select("node", "out_degree", rounded("rank"))


@query
def pagerank_3_iterations_parts(spark, sf):
    return ranked(load(spark, sf, "part_edges"), 3).select("node", "out_degree", rounded("rank"))


@query
def pagerank_3_iterations_supply(spark, sf):
    return ranked(load(spark, sf, "supply_edges"), 3, checkpoint_every=2).select(
        "node", "out_degree", rounded("rank"))


@query
def pagerank_3_iterations_events(spark, sf):
    return ranked(load(spark, sf, "event_edges"), 3).select("node", "out_degree", rounded("rank"))


@query
def pagerank_distinct_edges_parts(spark, sf):
    return ranked(load(spark, sf, "part_edges"), 2, distinct_edges=True).select(
        "node", "out_degree", rounded("rank"))


@query
def rank_states_union(spark, sf):
    edges = kept_edges(spark, sf, "supply_edges")
    return ranked(edges, 0).unionByName(ranked(edges, 1)).select("node", rounded("rank"))


@query
def read_rank_state_files(spark, sf):
    """Two states on disk, as Parquet (written over another one) and in their text form, read as one table."""
    path = scratch_path(spark, "states")
    edges = kept_edges(spark, sf, "supply_edges")
    first = ranked(edges, 0)
    lg.write_rank_state(first.limit(5), f"{path}/0")
    lg.write_rank_state(first, f"{path}/0", mode="overwrite")
    size = F.coalesce(F.col("out_degree").cast("string"), F.lit("null"))
    line = F.concat_ws(" ", F.concat("node", F.lit("\t"), "node"), size, "rank", F.lit("links"))
    ranked(edges, 1).select(line.alias("value")).write.text(f"{path}/1")
    states = lg.read_rank_states(spark, f"{path}/0").withColumn("step", F.lit(0)).unionByName(
        lg.read_rank_state(spark, f"{path}/1", format="text").withColumn("step", F.lit(1)))
    return states.select("step", "node", "out_degree", rounded("rank"))


@query
def rank_files_round_trip(spark, sf):
    """Final ranks as tab-separated text."""
    path = scratch_path(spark, "ranks")
    lg.write_ranks(lg.pagerank(links_of(load(spark, sf, "part_edges")), max_iter=2), path, format="csv")
    return spark.read.schema("node string, rank double").option("sep", "\t").csv(path).select("node", rounded("rank"))


@query
def rank_delta_supply(spark, sf):
    edges = kept_edges(spark, sf, "supply_edges")
    deltas = lg.rank_delta(ranked(edges, 0), ranked(edges, 1))
    return deltas.select("node", rounded("delta"))


@query
def max_delta_supply(spark, sf):
    """The first and the second state of one graph."""
    with closing(lg.rank_states(load(spark, sf, "supply_edges"))) as states:
        _, first, second = islice(states, 3)
        return checkpointed(lg.max_delta(lg.rank_delta(first, second))).select(rounded("max_delta"))


@query
def pagerank_finish_parts(spark, sf):
    return lg.pagerank(links_of(load(spark, sf, "part_edges")), max_iter=2).select("node", rounded("rank"))


@query
def pagerank_top_parts(spark, sf):
    """The ten highest ranks: a top-k report."""
    return lg.pagerank(links_of(load(spark, sf, "part_edges")), max_iter=2, limit=10).select(
        "node", rounded("rank"))


@query
def pagerank_until_converged_parts(spark, sf):
    """Iterates until no rank moves by more than 0.05."""
    return lg.pagerank(links_of(load(spark, sf, "part_edges")), max_iter=6, tol=0.05).select(
        "node", rounded("rank"))


@query
def pagerank_resumed_parts(spark, sf):
    """Two steps over a stored graph, and the third one by a later run."""
    path = scratch_path(spark, "ranking")
    first = lg.StoredRanking(spark, path)
    first.begin(load(spark, sf, "part_edges"))
    first.run(2)
    return lg.StoredRanking(spark, path).run(3).select("node", "out_degree", rounded("rank"))


@query
def pagerank_stored_until_converged_supply(spark, sf):
    """A stored ranking of a graph with nodes that link nowhere, until no rank moves by more than 0.3."""
    ranking = lg.StoredRanking(spark, scratch_path(spark, "ranking"))
    ranking.begin(load(spark, sf, "supply_edges"))
    return ranking.run(4, tol=0.3).select("node", "out_degree", rounded("rank"))


# Frontier


@query
def admit_unseen(spark, sf):
    arrivals = load(spark, sf, "arrivals")
    seen = load(spark, sf, "frontier").select("url").unionByName(
        arrivals.where(F.col("url").endswith("7")).select("url").distinct())
    return lg.admit(arrivals, seen, "arrival").new


@query
def seen_after_admission(spark, sf):
    arrivals = load(spark, sf, "arrivals")
    return lg.admit(arrivals, load(spark, sf, "frontier").select("url")).seen


@query
def first_occurrence(spark, sf):
    return lg.first_occurrence(load(spark, sf, "arrivals"), "arrival")


@query
def host_lookup(spark, sf):
    urls = load(spark, sf, "frontier").select("url", "host")
    return lg.with_host_state(urls, load(spark, sf, "host_state"))


def scheduled_arrivals(spark, sf, part):
    new = lg.first_occurrence(load(spark, sf, "arrivals"), "arrival")
    splits = order_splits(new, "arrival", rows_per_slot=1000)
    return getattr(lg.schedule(new, load(spark, sf, "arrival_hosts"), splits=splits), part)


@query
def politeness_schedule(spark, sf):
    return scheduled_arrivals(spark, sf, "frontier")


@query
def politeness_host_times(spark, sf):
    return scheduled_arrivals(spark, sf, "host_state")


@query
def route_fetches(spark, sf):
    return lg.route_fetches(load(spark, sf, "fetch_log"), load(spark, sf, "host_state"), MAX_BYTES)


@query
def register_hosts_urls(spark, sf):
    known = load(spark, sf, "host_state")
    urls = load(spark, sf, "frontier").select("url", "host").join(known, "host", "left_anti")
    rules = lg.parse_robots(load(spark, sf, "robots_bodies"))
    return lg.register_hosts(urls.select("url", "host"), rules, NOW_MS, AGENT).requeued


@query
def register_hosts_rows(spark, sf):
    rules = lg.parse_robots(load(spark, sf, "robots_bodies"))
    urls = load(spark, sf, "arrivals").unionByName(
        load(spark, sf, "frontier").select("url", "host", F.lit(0).cast("bigint").alias("arrival")))
    return lg.register_hosts(urls, rules, NOW_MS, AGENT).new_hosts


@query
def due_urls(spark, sf):
    return lg.due(load(spark, sf, "frontier"), NOW_MS)


@query
def pop_earliest(spark, sf):
    return lg.pop_earliest(load(spark, sf, "frontier"), 20).popped


@query
def pop_earliest_rest(spark, sf):
    return lg.pop_earliest(load(spark, sf, "frontier"), 20).rest


@query
def pop_due(spark, sf):
    return lg.pop_due(load(spark, sf, "frontier"), NOW_MS, 15).popped


@query
def pop_due_rest(spark, sf):
    return lg.pop_due(load(spark, sf, "frontier"), NOW_MS, 15).rest


@query
def pull_batch(spark, sf):
    return lg.pull_batch(load(spark, sf, "frontier"), 25).popped


@query
def pull_batch_rest(spark, sf):
    return lg.pull_batch(load(spark, sf, "frontier"), 25).rest


def stored_queue(spark, sf, name: str) -> lg.SlotTable:
    """The frontier as a queue in slots of four seconds, put in two parts."""
    frontier = load(spark, sf, "frontier")
    queue = lg.SlotTable(spark, scratch_path(spark, name), frontier.schema, slot_ms=4000)
    queue.put(frontier.where("next_request_ms % 3000 = 0"))
    queue.put(frontier.where("next_request_ms % 3000 <> 0"))
    return queue


@query
def pop_stored_earliest(spark, sf):
    return stored_queue(spark, sf, "pop").pop_first(20)


@query
def pop_stored_earliest_rest(spark, sf):
    queue = stored_queue(spark, sf, "pop")
    queue.pop_first(20)
    return queue.read()


@query
def pop_stored_due(spark, sf):
    return stored_queue(spark, sf, "pop").pop_due(NOW_MS, 15)


@query
def pop_stored_due_rest(spark, sf):
    queue = stored_queue(spark, sf, "pop")
    queue.pop_due(NOW_MS)
    return queue.read()


def stored_batches(spark, sf) -> lg.OrderedTable:
    """The frontier as a queue by URL, in parts by the first 22 bytes."""
    frontier = load(spark, sf, "frontier")
    queue = lg.OrderedTable(spark, scratch_path(spark, "pull"), frontier.schema, ("url",), lg.prefix_part("url", 22), "string")
    queue.put(frontier)
    return queue


@query
def pull_stored_batch(spark, sf):
    return stored_batches(spark, sf).pop_first(25)


@query
def pull_stored_batch_rest(spark, sf):
    queue = stored_batches(spark, sf)
    queue.pop_first(25)
    return queue.read()


@query
def frontier_in_time_order(spark, sf):
    return load(spark, sf, "frontier").orderBy("next_request_ms", "url")


def frontier_changes(spark, sf):
    """Every page URL and a longer one put again, twice, with later times."""
    pages = load(spark, sf, "frontier")
    longer = pages.withColumn("url", F.concat("url", F.lit("/again")))
    return pages.unionByName(longer).select(
        "url", "host", (F.col("next_request_ms") + 7).alias("next_request_ms"), "content_type",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("version")).withColumn(
        "next_request_ms", F.col("next_request_ms") * F.col("version"))


@query
def upsert_frontier(spark, sf):
    base = load(spark, sf, "frontier")
    base = base.unionByName(base.withColumn("url", F.concat("url", F.lit("/kept"))))
    return lg.upsert(base, frontier_changes(spark, sf), "url", "version")


def stored_rows(rows: DataFrame) -> lg.KeyedTable:
    table = lg.KeyedTable(rows.sparkSession, scratch_path(rows.sparkSession, "keyed"), rows.schema, "url", buckets=4)
    table.put(rows)
    return table


@query
def upsert_stored_frontier(spark, sf):
    """Two puts of changes, the later one first folded into its buckets."""
    base = load(spark, sf, "frontier")
    table = stored_rows(base.unionByName(base.withColumn("url", F.concat("url", F.lit("/kept")))))
    changes = frontier_changes(spark, sf)
    table.put(changes.where("version = 1").drop("version"))
    table.compact()
    table.put(changes, "version")
    return table.read()


@query
def delete_from_stored_frontier(spark, sf):
    routed = lg.route_fetches(load(spark, sf, "fetch_log"), load(spark, sf, "host_state"), MAX_BYTES)
    table = stored_rows(load(spark, sf, "frontier"))
    table.delete(routed.where(F.col("action") == "drop"))
    return table.read()


@query
def clear_frontier(spark, sf):
    """What is left of a cleared store: the seen URLs and the hosts."""
    store = filled_store(spark, sf)
    store.clear()
    version = store.version()
    waiting = store.head.read(version).select("url").unionByName(store.get.read(version).select("url"))
    kept = store.seen.read(version).unionByName(store.hosts.read(version).select(F.col("host").alias("url")))
    return kept.withColumn("state", F.lit("kept")).unionByName(waiting.withColumn("state", F.lit("waiting")))


@query
def delete_from_frontier(spark, sf):
    routed = lg.route_fetches(load(spark, sf, "fetch_log"), load(spark, sf, "host_state"), MAX_BYTES)
    return lg.delete_keys(load(spark, sf, "frontier"), routed.where(F.col("action") == "drop"), "url")


@query
def files_to_copy_documents(spark, sf):
    return files_to_copy(load(spark, sf, "manifest"), load(spark, sf, "copied"), NOW_MS, settle_ms=60_000)


@query
def list_and_copy(spark, sf):
    """Files written in two goes and copied by three runs, of which the last finds nothing: documents by folder and run."""
    path = scratch_path(spark, "watched")
    docs = load(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("value"), (
        F.col("doc_id") % 12).alias("part"))
    archive = lg.FileArchive(spark, f"{path}/archive", buckets=4)
    for part in (F.col("part") < 5, F.col("part") >= 5, F.lit(False)):
        docs.where(part).repartition("part").write.mode("append").partitionBy("part").text(f"{path}/files")
        archive.copy_new(f"{path}/files", int(time.time() * 1000) + 120_000, recursive=True)
    lines = F.explode(F.split(F.trim(F.decode("content", "UTF-8"), F.lit("\n")), "\n"))
    return archive.read().select(F.split_part("key", F.lit("/"), F.lit(1)).alias("folder"), "taken", lines.alias("line"))


@query
def host_bucket_3(spark, sf):
    return load(spark, sf, "page_hosts").select("host", host_bucket(F.col("host"), 3).alias("bucket"))


@query
def host_bucket_16_arrivals(spark, sf):
    hosts = load(spark, sf, "arrivals").select(host_of(F.col("url")).alias("host"))
    buckets = hosts.select(host_bucket(F.col("host"), 16).alias("bucket"))
    return buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query
def urls_per_node(spark, sf):
    outputs = lg.crawl_outputs(load(spark, sf, "pages"))
    spread = outputs.select("page_id", F.transform("targets", lambda u, i: F.when(
        i % 2 == 0, u).otherwise(F.replace(u, F.lit("://"), F.lit("://m")))).alias("targets"))
    return lg.urls_per_node(spread, 3).select("page_id", "node", joined("urls"))


# Robots


@query
def parse_robots(spark, sf):
    return lg.parse_robots(load(spark, sf, "robots_bodies"))


@query
def host_rules(spark, sf):
    bodies = load(spark, sf, "robots_bodies")
    rules = lg.host_rules(lg.parse_robots(bodies), lg.known_agents(bodies))
    return rules.select("host", "agent", joined("disallow"), joined("allow"), joined("sitemaps"), "crawl_delay")


@query
def known_agents(spark, sf):
    return lg.known_agents(load(spark, sf, "robots_bodies"))


@query
def effective_delay(spark, sf):
    return lg.effective_delay(lg.parse_robots(load(spark, sf, "robots_bodies")), AGENT)


def robots_check(spark, sf, agent, match_on):
    rules = lg.parse_robots(load(spark, sf, "robots_bodies"))
    urls = load(spark, sf, "frontier").select("url", "host")
    return lg.allowed(urls, rules, agent, match_on)


@query
def robots_allowed(spark, sf):
    return robots_check(spark, sf, AGENT, "path")


@query
def robots_allowed_any_agent(spark, sf):
    return robots_check(spark, sf, "nobody", "path")


@query
def robots_allowed_literal_url(spark, sf):
    return robots_check(spark, sf, AGENT, "url")


@query
def frontier_round(spark, sf):
    pages = load(spark, sf, "pages")
    frontier = load(spark, sf, "frontier")
    result = lg.frontier_round(
        load(spark, sf, "fetch_log"), pages, frontier, frontier.select("url"),
        load(spark, sf, "host_state"), lg.parse_robots(load(spark, sf, "robots_bodies")),
        NOW_MS, AGENT, MAX_BYTES)
    parts = [("fetch", result.fetch), ("due", result.due), ("queued", result.frontier)]
    frames = [df.select("url", "next_request_ms", F.lit(name).alias("state")) for name, df in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query
def frontier_round_hosts(spark, sf):
    frontier = load(spark, sf, "frontier")
    return lg.frontier_round(
        load(spark, sf, "fetch_log"), load(spark, sf, "pages"), frontier, frontier.select("url"),
        load(spark, sf, "host_state"), lg.parse_robots(load(spark, sf, "robots_bodies")),
        NOW_MS, AGENT, MAX_BYTES).host_state


def filled_store(spark, sf) -> lg.StoredFrontier:
    """The frontier, and every third of its URLs under another name waiting for download."""
    frontier = load(spark, sf, "frontier")
    waiting = frontier.where("next_request_ms % 1500 = 0").withColumn("url", F.concat("url", F.lit("/page")))
    store = lg.StoredFrontier(spark, scratch_path(spark, "store"), slot_ms=4000, buckets=4, cells=64)
    store.begin(frontier, load(spark, sf, "host_state"), get_queue=waiting)
    return store


def stored_round(spark, sf) -> tuple[lg.StoredFrontier, lg.StoredRound]:
    store = filled_store(spark, sf)
    return store, store.round(load(spark, sf, "fetch_log"), load(spark, sf, "pages"),
                              lg.parse_robots(load(spark, sf, "robots_bodies")), NOW_MS, AGENT, MAX_BYTES)


@query
def frontier_round_get_queue(spark, sf):
    """Both queues after a stored round, and what it handed out."""
    store, done = stored_round(spark, sf)
    parts = {"fetch": done.fetch, "due": done.due, "head": store.head.read(done.version), "get": store.get.read(done.version)}
    frames = [df.select("url", "next_request_ms", F.lit(name).alias("state")) for name, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query
def frontier_round_deltas(spark, sf):
    """The changes of a stored round."""
    _, done = stored_round(spark, sf)
    new = done.new.select("url", "next_request_ms", F.lit("new").alias("state"))
    removed = done.removed.select("url", "next_request_ms", F.concat(F.lit("removed, "), "state").alias("state"))
    moved = done.moved.select(F.col("host").alias("url"), "next_request_ms", F.lit("moved").alias("state"))
    return new.unionByName(removed).unionByName(moved)


@query
def frontier_round_seen(spark, sf):
    """The memory of URLs after a stored round."""
    store, done = stored_round(spark, sf)
    return store.seen.read(done.version)


# Files


@query
def document_files_round_trip(spark, sf):
    path = scratch_path(spark, "documents")
    docs = load(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("url"), F.col("text").alias("body"))
    write_documents(docs, path, MARKER)
    return read_documents(spark, path, MARKER)


@query
def link_files_round_trip(spark, sf):
    path = scratch_path(spark, "links")
    write_links(lg.page_links(lg.crawl_outputs(load(spark, sf, "pages"))), path)
    return lg.to_edges(spark.read.parquet(path))


# Streams: the table arrives in three parts, and the query goes on after each


def replay(df: DataFrame, order_col: str, start: Callable[[DataFrame], object], parts: int = 3) -> DataFrame:
    """Let ``df`` arrive in parts in order of ``order_col``, one batch each, and run a stream over it.

    Returns the stream, to which nothing is added any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "arriving")
    df = written(df, scratch_path(spark, "all"))  # read for the bounds and for each part
    bounds = df.approxQuantile(order_col, [i / parts for i in range(1, parts)], 0.01)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2**31 - 1)
    for low, high in zip([None, *bounds], [*bounds, None]):
        rows = df if low is None else df.where(F.col(order_col) > low)
        rows = rows if high is None else rows.where(F.col(order_col) <= high)
        rows.write.mode("append").parquet(path)
        running = start(stream.parquet(path))
        running.awaitTermination()
    return stream.parquet(path)


@query
def stream_admit(spark, sf):
    arrivals = load(spark, sf, "arrivals").select("url", "arrival")
    seen = load(spark, sf, "arrivals").where(F.col("url").endswith("7")).select("url").distinct()
    path = scratch_path(spark, "admit")
    table = lg.SeenTable(spark, f"{path}/seen", buckets=4, cells=64)
    table.add(seen)
    replay(arrivals, "arrival", lambda stream: lg.start_admission(
        stream.select("url"), table, path, f"{path}/state", available_now=True))
    return spark.read.parquet(f"{path}/admitted").select("url")


@query
def stream_schedule(spark, sf):
    new = lg.first_occurrence(load(spark, sf, "arrivals"), "arrival")
    path = scratch_path(spark, "schedule")
    hosts = written(load(spark, sf, "arrival_hosts"), f"{path}/known")  # every batch reads them
    replay(new, "arrival", lambda stream: lg.start_schedule(
        stream, hosts, path, f"{path}/state", snapshot_every=2, available_now=True))
    return spark.read.parquet(f"{path}/frontier").drop("batch")


@query
def stream_schedule_new_hosts(spark, sf):
    """Hosts that become known with the first URLs, by a second stream, across snapshots."""
    new = lg.first_occurrence(load(spark, sf, "arrivals"), "arrival")
    path = scratch_path(spark, "schedule")
    hosts = written(load(spark, sf, "arrival_hosts"), f"{path}/known")  # every batch reads them
    hosts.where("crawl_delay >= 1.5").write.parquet(f"{path}/registered")
    entries = spark.readStream.schema(hosts.schema).parquet(f"{path}/registered")
    replay(new, "arrival", lambda stream: lg.start_schedule(
        stream, hosts.where("crawl_delay < 1.5"), path, f"{path}/state", snapshot_every=2, available_now=True,
        registrations=entries), parts=4)
    return spark.read.parquet(f"{path}/frontier").drop("batch")


@query
def stream_rolling_files(spark, sf):
    events = load(spark, sf, "events").select("event_id", "ts", "event_type")
    path = scratch_path(spark, "rolling")
    replay(events, "event_id", lambda stream: lg.start_rolling_sink(
        stream, f"{path}/out", f"{path}/state", available_now=True))
    return spark.read.parquet(f"{path}/out").select("event_id", "event_type")


@query
def rolled_windows(spark, sf):
    windows = with_rolling_window(load(spark, sf, "events").select("event_id", "ts"))
    return windows.select("event_id", as_text("window_start"))


def crawled(spark, sf) -> str:
    path = scratch_path(spark, "crawl")
    replay(load(spark, sf, "pages"), "page_id", lambda stream: lg.start_crawl_outputs(
        stream, path, f"{path}/state", available_now=True))
    return path


@query
def stream_crawl_links(spark, sf):
    return spark.read.parquet(f"{crawled(spark, sf)}/links").select("source", joined("targets"))


@query
def stream_crawl_documents(spark, sf):
    return spark.read.parquet(f"{crawled(spark, sf)}/documents").select("url", "body")


# How far the clock of the due stream goes on per batch.
DUE_STEP_MS = 40_000


@query
def stream_due(spark, sf):
    """URLs released by a clock that moves on by 40 s per batch; the last batch has no arrival."""
    frontier = load(spark, sf, "frontier").select("url", "host", "next_request_ms")
    path = scratch_path(spark, "due")

    def start(stream):
        return lg.start_due(stream, path, f"{path}/state", slot_ms=5000, available_now=True,
                            clock=lambda batch_id: NOW_MS + batch_id * DUE_STEP_MS)

    arriving = replay(frontier, "next_request_ms", start)
    start(arriving).awaitTermination()
    return spark.read.parquet(f"{path}/due").select("url", "next_request_ms")


@query
def arrivals_per_window(spark, sf):
    events = load(spark, sf, "events").select("ts", "event_id")
    path = scratch_path(spark, "windows")
    replay(events, "event_id", lambda stream: (
        lg.arrivals_per_window(stream).writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/out"))
        .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()))
    return spark.read.parquet(f"{path}/out").select(as_text("window_start"), as_text("window_end"), "n")
