import math
import random

import pytest
from pyspark.sql import functions as F

import linkgraph as lg
from linkgraph.functions.urls import host_of
from linkgraph.operators.skew import order_splits, with_slot

NOW = 1_000_000
HOSTS = "host string, crawl_delay double, next_request_ms bigint"


def hosts(spark):
    return spark.createDataFrame([("h.org", 2.0, 1_000_000), ("k.org", 1.0, 999_000)], HOSTS)


def test_admit_schedule_due(spark):
    arrivals = ["http://h.org/1", "http://h.org/2", "http://h.org/2", "http://h.org/3", "http://k.org/1",
                "http://new.org/1", "http://h.org/../../../x"]
    candidates = spark.createDataFrame([(i + 1, u) for i, u in enumerate(arrivals)], "arrival bigint, url string")
    candidates = candidates.withColumn("host", host_of(F.col("url")))
    seen = spark.createDataFrame([("http://h.org/1",)], "url string")
    new, grown = lg.admit(candidates, seen, "arrival")
    result = lg.schedule(new, hosts(spark))
    assert {r.url: r.next_request_ms for r in result.frontier.collect()} == {
        "http://h.org/2": 1_002_000, "http://h.org/3": 1_004_000, "http://k.org/1": 1_000_000, "http://new.org/1": 0}
    assert {r.host: r.next_request_ms for r in result.host_state.collect()} == {"h.org": 1_004_000, "k.org": 1_000_000}
    assert {r.url for r in lg.due(result.frontier, NOW).collect()} == {"http://k.org/1", "http://new.org/1"}
    looked_up = {r.host: r.needs_robots for r in lg.with_host_state(new.select("url", "host"), hosts(spark)).collect()}
    assert looked_up == {"h.org": False, "k.org": False, "new.org": True}
    assert {r.url for r in grown.collect()} == {u for u in arrivals if "../../.." not in u}
    assert lg.admit(candidates, grown, "arrival").new.count() == 0


def stepped(rows, state):
    """One URL at a time."""
    times, frontier = {h: t for h, _, t in state}, {}
    delays = {h: d for h, d, _ in state}
    for arrival, url, host in sorted(rows, key=lambda r: (r[0], r[1])):
        if host in times:
            times[host] = math.trunc(times[host] + delays[host] * 1000)
            frontier[url] = times[host]
        else:
            frontier[url] = 0
    return frontier, times


@pytest.mark.parametrize("rows_per_slot", [10_000, 100, 7])
def test_schedule_equals_the_loop(spark, rows_per_slot):
    rng = random.Random(rows_per_slot)
    state = [("hot", 1.25, 1_700_000_000_123), ("a", 1.0, 5), ("b", 3.3337, 77), ("idle", 2.0, 9)]
    rows = [(rng.randint(0, 400), f"u{i}", rng.choice(["hot", "hot", "a", "b", "unknown"])) for i in range(1200)]
    new = spark.createDataFrame(rows, "arrival bigint, url string, host string")
    splits = order_splits(new, "arrival", rows_per_slot)
    assert (len(splits) > 1) == (rows_per_slot < 1200)
    result = lg.schedule(new, spark.createDataFrame(state, HOSTS), splits=splits)
    frontier, times = stepped(rows, state)
    assert {r.url: r.next_request_ms for r in result.frontier.collect()} == frontier
    assert {r.host: r.next_request_ms for r in result.host_state.collect()} == times
    assert {r.host for r in result.moved.collect()} == {"hot", "a", "b"}


def test_slots_bound_the_rows_of_a_hot_host(spark):
    new = spark.range(0, 30_000).select(
        F.when(F.col("id") < 100, F.col("id") * 10**9).otherwise(F.col("id")).alias("arrival"), F.lit("h").alias("host"))
    splits = order_splits(new, "arrival", 1000)
    sizes = [r["count"] for r in with_slot(new, "arrival", splits).groupBy("slot").count().collect()]
    assert max(sizes) < 2500 and len(sizes) > 15


def test_missing_order_is_kept(spark):
    new = spark.createDataFrame([(None, "a", "h.org"), (1, "b", "h.org"), (2, "c", "h.org")], "arrival bigint, url string, host string")
    got = lg.schedule(new, hosts(spark), splits=[1.5]).frontier.collect()
    assert {r.url: r.next_request_ms for r in got} == {"a": 1_002_000, "b": 1_004_000, "c": 1_006_000}


def test_candidates(spark):
    urls = ["http://u@h.org:80/x", "HTTPS://K.org", "mailto:a@b", "ftp://h/", "http://h:port/", "/x", "nothing", ""]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [tuple(r) for r in lg.url_candidates(df).collect()] == [(urls[0], "h.org"), (urls[1], "K.org")]


def test_first_occurrence(spark):
    rows = [("u", 3, "x"), ("u", 1, "y"), ("v", 2, "z")]
    df = spark.createDataFrame(rows, "url string, arrival int, tag string")
    assert {tuple(r) for r in lg.first_occurrence(df, "arrival").collect()} == {("u", 1, "y"), ("v", 2, "z")}
    assert {tuple(r) for r in lg.first_occurrence(df.drop("tag"), "arrival").collect()} == {("u", 1), ("v", 2)}


FETCHES = [
    (200, "text/html; charset=utf-8", 500, None, "fetch"), (200, "text/html", None, None, "fetch"),
    (200, "text/html", 2_000_001, None, "drop"), (200, "text/html", 2_000_000, None, "fetch"),
    (200, "application/pdf", 5, None, "drop"), (200, None, 5, None, "drop"),
    *[(status, "any", 1, "https://k.org/", "redirect") for status in (301, 302, 307)],
    (301, None, None, "HTTPS://k.org/", "redirect"), (302, "any", 1, "/rel", "drop"), (302, "any", 1, "//k.org/x", "drop"),
    (302, "any", 1, None, "drop"), (307, "any", 1, "https://k.org/a b", "drop"),
    *[(status, "text/html", 1, "https://k.org/", "drop") for status in (303, 308, 304, 404, 500)]]


def test_fetch_outcomes(spark):
    rows = [(f"http://{'h.org' if i % 2 else 'new.org'}/{i}", *row) for i, row in enumerate(FETCHES)]
    log = spark.createDataFrame(rows, "url string, status int, content_type string, content_length bigint, location string, want string")
    got = {r.url: r for r in lg.route_fetches(log.drop("want"), hosts(spark), 2_000_000).collect()}
    for url, *_, location, want in rows:
        assert got[url].action == want
        host_time = 1_000_000 if "h.org" in url else 0
        assert got[url].next_request_ms == (None if want == "drop" else host_time)
        target = {"fetch": url, "redirect": "https://k.org/", "drop": None}[want]
        assert got[url].target == target


def test_register(spark):
    rules = lg.parse_robots(spark.createDataFrame([("slow.org", "User-agent: *\nCrawl-delay: 2.5")], "host string, body string"))
    urls = spark.createDataFrame([("http://slow.org/1", "slow.org", 0), ("http://slow.org/2", "slow.org", 0), ("http://x.org/", "x.org", 0)],
                                 "url string, host string, next_request_ms bigint")
    result = lg.register_hosts(urls, rules, NOW, "bot")
    assert {tuple(r) for r in result.new_hosts.collect()} == {("slow.org", 2.5, 1_002_500), ("x.org", 1.0, 1_001_000)}
    assert {r.url: r.next_request_ms for r in result.requeued.collect()} == {
        "http://slow.org/1": 1_002_500, "http://slow.org/2": 1_002_500, "http://x.org/": 1_001_000}
    assert result.requeued.columns == urls.columns


def queue(spark):
    rows = [("c", 5), ("a", 9), ("b", 5), ("d", 1), ("e", 3000)]
    return spark.createDataFrame(rows, "url string, next_request_ms bigint")


def urls(df):
    return [r.url for r in df.collect()]


def test_pops_pass_no_single_task(spark):
    rows = [(f"u{i % 700}", "h", (i * 37) % 50, "t") for i in range(700)]
    frontier = spark.createDataFrame(rows, "url string, host string, next_request_ms bigint, content_type string")
    for n in (1, 49, 350, 699, 700, 5000):
        popped, rest = lg.pop_earliest(frontier, n)
        first = sorted(rows, key=lambda r: (r[2], r[0]))
        assert [r.url for r in popped.collect()] == [r[0] for r in first[:n]]
        assert sorted(r.url for r in rest.collect()) == sorted(r[0] for r in first[n:])
        for df in (popped, rest):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "TakeOrderedAndProject" not in plan and "SinglePartition" not in plan
    assert lg.pop_earliest(frontier, 0).popped.isEmpty() and lg.pull_batch(frontier.limit(0), 3).popped.isEmpty()


def test_pops(spark):
    popped, rest = lg.pop_earliest(queue(spark), 2)
    assert urls(popped) == ["d", "b"] and sorted(urls(rest)) == ["a", "c", "e"]
    popped, rest = lg.pop_due(queue(spark), 1000, 10)
    assert urls(popped) == ["d", "b", "c", "a"] and urls(rest) == ["e"]
    popped, rest = lg.pop_due(queue(spark), 1000)
    assert sorted(urls(popped)) == ["a", "b", "c", "d"] and urls(rest) == ["e"]
    popped, rest = lg.pop_due(queue(spark), -2000 + 1, 10)
    assert urls(popped) == [] and len(urls(rest)) == 5
    popped, rest = lg.pull_batch(queue(spark), 2)
    assert urls(popped) == ["a", "b"] and sorted(urls(rest)) == ["c", "d", "e"]


def test_tables(spark):
    base = queue(spark)
    changes = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("z", 7, 1)], "url string, next_request_ms bigint, version int")
    got = {r.url: r.next_request_ms for r in lg.upsert(base, changes, "url", "version").collect()}
    assert got == {"a": 2, "b": 5, "c": 5, "d": 1, "e": 3000, "z": 7}
    one = spark.createDataFrame([("b", 8)], "url string, next_request_ms bigint")
    assert {r.url: r.next_request_ms for r in lg.upsert(base, one, "url").collect()}["b"] == 8
    assert sorted(urls(lg.delete_keys(base, one, "url"))) == ["a", "c", "d", "e"]
    assert lg.clear(base).count() == 0 and lg.clear(base).columns == base.columns


def test_round(spark):
    rules = lg.parse_robots(spark.createDataFrame(
        [("h.org", "User-agent: *\nDisallow: /no"), ("new.org", "User-agent: *\nCrawl-delay: 4")], "host string, body string"))
    pages = spark.createDataFrame(
        [(1, "http://h.org/", '<a href="/no/1"><a href="/yes"><a href="/old"><a href="http://new.org/1"><a href="mailto:a@b">'),
         (2, "http://k.org/", '<a href="http://h.org/yes"><a href="/k1"><a href="/r">')], "page_id bigint, url string, html string")
    log = spark.createDataFrame(
        [("http://h.org/moved", 301, None, None, "http://k.org/r"), ("http://k.org/page", 200, "text/html", 10, None)],
        "url string, status int, content_type string, content_length bigint, location string")
    seen = spark.createDataFrame([("http://h.org/old",)], "url string")
    frontier = spark.createDataFrame([("http://h.org/waiting", "h.org", 5_000_000)], "url string, host string, next_request_ms bigint")
    result = lg.frontier_round(log, pages, frontier, seen, hosts(spark), rules, NOW + 3000, "bot")
    assert [tuple(r) for r in result.fetch.collect()] == [("http://k.org/page", "text/html", 999_000)]
    # page 1: /no/1 takes 1002000, /yes 1004000; page 2: /k1 takes 1000000; the redirect keeps 1000000
    assert {r.url: r.next_request_ms for r in result.due.collect()} == {
        "http://h.org/yes": 1_004_000, "http://k.org/k1": 1_000_000, "http://k.org/r": 1_000_000}
    assert {r.url: r.next_request_ms for r in result.frontier.collect()} == {
        "http://h.org/waiting": 5_000_000, "http://new.org/1": 1_007_000}
    assert {tuple(r) for r in result.host_state.collect()} == {
        ("h.org", 2.0, 1_004_000), ("k.org", 1.0, 1_000_000), ("new.org", 4.0, 1_007_000)}
    assert result.seen.count() == 6
    parsed = lg.crawl_outputs(pages).select("page_id", "targets")
    again = lg.frontier_round(log, parsed, result.frontier, result.seen, result.host_state, rules, NOW, "bot")
    assert again.due.count() == 0 and again.seen.count() == 6
