"""Stored tables: queues, seen URLs, keyed rows, and rounds of the frontier over them."""

import random

import pytest
from pyspark.sql import functions as F

import linkgraph as lg
from linkgraph.session import scratch_path
from linkgraph.stored import ordered as ordered_module, seen as seen_module
from linkgraph.stored.live import complete_versions
from linkgraph.streaming.admission import start_admission

URL_TIME = "url string, next_request_ms bigint"
NOW = 1_000_000


def slots(spark, rows, slot_ms=1000, parts=2):
    frame = spark.createDataFrame(rows, URL_TIME)
    queue = lg.SlotTable(spark, scratch_path(spark, "queue"), frame.schema, slot_ms)
    for k in range(parts):
        queue.put(frame.where(F.pmod(F.crc32("url"), F.lit(parts)) == k))
    return queue


def pairs(df):
    return sorted((r["url"], r["next_request_ms"]) for r in df.collect())


def test_pops_equal_a_sorted_list(spark):
    rng = random.Random(1)
    rows = [(f"u{i}", rng.choice([rng.randrange(20_000), 5000])) for i in range(120)]
    queue, left = slots(spark, rows), sorted(rows, key=lambda r: (r[1], r[0]))
    for n in (1, 40, 0, 7):
        popped = queue.pop_first(n)
        assert pairs(popped) == sorted(left[:n])
        left = left[n:]
        assert pairs(queue.read()) == sorted(left)
    due = queue.pop_due(9000, 5)
    assert pairs(due) == sorted([r for r in left if r[1] < 11_000][:5])
    left = sorted(set(left) - set(map(tuple, due.collect())), key=lambda r: (r[1], r[0]))
    assert pairs(queue.pop_due(9000)) == sorted(r for r in left if r[1] < 11_000)
    assert pairs(queue.pop_due(-5000, 3)) == []
    assert pairs(queue.pop_first(1000)) == sorted(r for r in left if r[1] >= 11_000)
    assert queue.read().count() == 0 and queue.pop_first(3).count() == 0


def test_only_due_slots_are_opened(spark):
    queue = slots(spark, [(f"u{i}", i * 100) for i in range(200)], parts=1)
    due = queue.take_due(1500, 2000)
    assert {e["part"] for e in due.opened} == {0, 1, 2, 3}
    read = {path.split("part__=")[1].split("/")[0] for path in due.rows.inputFiles()}
    assert read <= {"0", "1", "2", "3"} and due.rows.count() == 35 and due.rest.count() == 5
    first = queue.take_first(15)
    assert sum(e["n"] for e in first.opened) == 20
    assert {p.split("part__=")[1].split("/")[0] for p in first.rows.inputFiles()} == {"0", "1"}


def test_many_slots_lie_in_few_folders(spark, monkeypatch):
    monkeypatch.setattr(ordered_module, "MANY_PARTS", 5)
    monkeypatch.setattr(ordered_module, "MANY_FOLDERS", 4)
    rng = random.Random(2)
    rows = [(f"u{i}", rng.choice([i * 1000, rng.randrange(300) * 1000, None if i % 50 == 0 else 7])) for i in range(300)]
    queue, left = slots(spark, rows, parts=3), sorted(rows, key=lambda r: (r[1] is not None, r[1], r[0]))
    assert queue.folders.live(queue.latest()).count() <= 15
    assert {tuple(r) for r in queue.read().collect()} == set(left)
    for n in (2, 31, 150):
        assert {tuple(r) for r in queue.pop_first(n).collect()} == set(left[:n])
        left = left[n:]
    queue.put(spark.createDataFrame([(f"v{i}", i * 1000) for i in range(300)], URL_TIME))
    left = sorted(left + [(f"v{i}", i * 1000) for i in range(300)], key=lambda r: (r[1], r[0]))
    assert pairs(queue.pop_due(18_500, 6)) == sorted(left[:6])
    left = left[6:]
    for now, n in ((18_500, 400), (100_000, None)):
        assert pairs(queue.pop_due(now, n)) == sorted(r for r in left if r[1] < now + 2000)
        left = [r for r in left if r[1] >= now + 2000]
    assert pairs(queue.read()) == sorted(left)
    for k in range(6):
        queue.put(spark.createDataFrame([(f"{k}w{i}", i * 1000) for i in range(40)], URL_TIME))
    assert queue.read().count() == len(left) + 240 and queue.folders.live(queue.latest()).count() <= 40


def test_keys_that_are_null_stay_and_count(spark):
    frame = spark.createDataFrame([(None,), *((f"u{i:03}",) for i in range(200))], "url string")
    queue = lg.OrderedTable(spark, scratch_path(spark, "keys"), frame.schema, ("url",), lg.prefix_part("url", 9), "string")
    queue.put(frame)
    assert sorted(r["url"] for r in queue.pop_first(5).collect()) == [f"u{i:03}" for i in range(4)]


def test_a_row_without_a_time_is_due_at_once(spark):
    queue = slots(spark, [("a", None), ("b", 10_000), ("c", 0)], parts=1)
    assert {r["url"] for r in queue.pop_due(0).collect()} == {"a", "c"}
    assert pairs(queue.read()) == [("b", 10_000)]


def test_crowded_parts_are_merged(spark, monkeypatch):
    monkeypatch.setattr(ordered_module, "MANY_FOLDERS", 3)
    queue = slots(spark, [], parts=1)
    frame = spark.createDataFrame([("a", 1), ("b", 5000)], URL_TIME)
    for k in range(6):
        queue.put(frame.withColumn("url", F.concat("url", F.lit(str(k)))))
    assert queue.read().count() == 12
    assert queue.folders.live(queue.latest()).groupBy("part").count().agg(F.max("count")).first()[0] <= 3
    before = queue.folders.path
    queue.folders.forget(queue.latest())
    assert complete_versions(spark, f"{before}/manifest") == [queue.latest()] and queue.read().count() == 12
    queue.clear()
    assert queue.read().count() == 0


def test_text_keys_in_order(spark):
    rng = random.Random(3)
    urls = sorted({"http://" + "".join(rng.choice("abÿé/") for _ in range(rng.randint(0, 9))) for _ in range(90)},
                  key=lambda u: u.encode())
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    queue = lg.OrderedTable(spark, scratch_path(spark, "keys"), frame.schema, ("url",), lg.prefix_part("url", 9), "string")
    queue.put(frame)
    assert sorted((r["url"] for r in queue.pop_first(33).collect()), key=lambda u: u.encode()) == urls[:33]
    assert {r["url"] for r in queue.read().collect()} == set(urls[33:])


def test_seen_admits_each_url_once(spark, monkeypatch):
    monkeypatch.setattr(seen_module, "MANY_VERSIONS", 3)
    rng = random.Random(5)
    table, known = lg.SeenTable(spark, scratch_path(spark, "seen"), buckets=4, cells=8), set()
    for step in range(5):
        batch = [(f"http://h/{rng.randrange(400)}", i) for i in range(150)] + [("http://h/../../../x", 1)]
        new = table.admit(spark.createDataFrame(batch, "url string, arrival int"), "arrival")
        firsts = {}
        for url, arrival in batch[:-1]:
            firsts.setdefault(url, arrival)
        assert {tuple(r) for r in new.collect()} == {(u, a) for u, a in firsts.items() if u not in known}
        known |= set(firsts)
        assert sorted(r["url"] for r in table.read().collect()) == sorted(known)
    assert "version=3" in seen_module.complete_versions.__globals__["names_in"](spark, f"{table.path}/index")


def test_buckets_without_a_hit_are_not_read(spark):
    table = lg.SeenTable(spark, scratch_path(spark, "seen"), buckets=8, cells=64)
    table.add(spark.range(500).select(F.concat(F.lit("http://h/"), "id").alias("url")))
    fresh = spark.range(300).select(F.concat(F.lit("http://other/"), "id").alias("url"))
    assert table.maybe_seen(fresh).count() == 0
    found = table.unseen(fresh)
    assert found.new.count() == 300 and all("/rows/" not in path for path in found.new.inputFiles())
    one = fresh.unionByName(spark.createDataFrame([("http://h/7",)], "url string"))
    found = table.unseen(one)
    assert found.new.count() == 300
    buckets = {path.split("part__=")[1].split("/")[0] for path in found.new.inputFiles() if "/rows/" in path}
    assert len(buckets) == 1
    assert not any(name in found.new._jdf.queryExecution().executedPlan().toString() for name in ("Python", "Arrow"))
    every = table.read().select("url")
    assert table.maybe_seen(every).count() == 500


def test_an_admission_that_was_cut_off_is_tried_again(spark, monkeypatch):
    table = lg.SeenTable(spark, scratch_path(spark, "seen"), buckets=4, cells=8)
    table.add(spark.createDataFrame([("a",)], "url string"))
    batch = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    with monkeypatch.context() as broken:
        broken.setattr(table.folders, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.admit(batch)
    assert table.latest() == 1 and table.read().count() == 1
    assert sorted(r["url"] for r in table.admit(batch).collect()) == ["b", "c"]
    assert sorted(r["url"] for r in table.read().collect()) == ["a", "b", "c"]
    assert table.admit(batch).count() == 0


def test_one_memory_for_stream_and_batch(spark):
    path = scratch_path(spark, "stream")
    table = lg.SeenTable(spark, f"{path}/seen", buckets=4, cells=8)

    def arrive(urls):
        spark.createDataFrame([(u,) for u in urls], "url string").coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema("url string").parquet(f"{path}/in")
        running = start_admission(stream, table, path, f"{path}/state", available_now=True)
        running.awaitTermination()
        return sorted(r["url"] for r in spark.read.parquet(f"{path}/admitted").collect())

    assert arrive(["a", "b", "a"]) == ["a", "b"]
    assert [r["url"] for r in table.admit(spark.createDataFrame([("b",), ("x",)], "url string")).collect()] == ["x"]
    assert arrive(["x", "c", "b"]) == ["a", "b", "c"]
    assert sorted(r["url"] for r in table.read().collect()) == ["a", "b", "c", "x"]


def test_keyed_rows_equal_a_dictionary(spark):
    rng = random.Random(9)
    table = lg.KeyedTable(spark, scratch_path(spark, "keyed"),
                          spark.createDataFrame([], "k string, v int").schema, "k", buckets=3)
    model = {f"k{i}": i for i in range(60)}
    table.put(spark.createDataFrame(list(model.items()), "k string, v int"))
    for step in range(4):
        changes = {f"k{rng.randrange(90)}": rng.randrange(1000) for _ in range(10)}
        table.put(spark.createDataFrame(list(changes.items()), "k string, v int"))
        written_rows = table.base.live(table.latest()).where(F.col("version") == table.latest())
        assert written_rows.agg(F.sum("n")).first()[0] == len(changes)
        model |= changes
        gone = [f"k{rng.randrange(90)}" for _ in range(4)]
        table.delete(spark.createDataFrame([(k,) for k in gone + gone[:1]], "k string"))
        model = {k: v for k, v in model.items() if k not in gone}
        assert {r["k"]: r["v"] for r in table.read().collect()} == model
        if step % 2:
            table.compact(0.1)
            assert {r["k"]: r["v"] for r in table.read().collect()} == model
    ordered = spark.createDataFrame([("k1", 5, 1), ("k1", 6, 2), ("new", 7, 1)], "k string, v int, at int")
    table.put(ordered, "at")
    assert {r["k"]: r["v"] for r in table.read().collect()} == model | {"k1": 6, "new": 7}
    assert table.compact(1e9) == table.latest()
    table.clear()
    assert table.read().count() == 0


def crawl(spark):
    rules = lg.parse_robots(spark.createDataFrame(
        [("h.org", "User-agent: *\nDisallow: /no"), ("new.org", "User-agent: *\nCrawl-delay: 4")], "host string, body string"))
    pages = spark.createDataFrame(
        [(1, "http://h.org/", '<a href="/no/1"><a href="/yes"><a href="/old"><a href="http://new.org/1"><a href="mailto:a@b">'),
         (2, "http://k.org/", '<a href="http://h.org/yes"><a href="/k1"><a href="/r">')], "page_id bigint, url string, html string")
    log = spark.createDataFrame(
        [("http://h.org/moved", 301, None, None, "http://k.org/r"), ("http://k.org/page", 200, "text/html", 10, None),
         ("http://h.org/later", 200, "text/html", 10, None)],
        "url string, status int, content_type string, content_length bigint, location string")
    hosts = spark.createDataFrame([("h.org", 2.0, NOW), ("k.org", 1.0, 999_000)],
                                  "host string, crawl_delay double, next_request_ms bigint")
    frontier = spark.createDataFrame([("http://h.org/waiting", "h.org", 1_009_000)], "url string, host string, next_request_ms bigint")
    seen = spark.createDataFrame([("http://h.org/old",)], "url string")
    return rules, pages, log, hosts, frontier, seen


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_stored_rounds_equal_rounds_in_memory(spark):
    rules, pages, log, hosts, frontier, seen = crawl(spark)
    store = lg.StoredFrontier(spark, scratch_path(spark, "store"), slot_ms=1000, buckets=2, cells=8)
    store.begin(frontier, hosts, seen)
    model = (frontier, seen.unionByName(frontier.select("url")), hosts)
    log2 = spark.createDataFrame([("http://k.org/r", 200, "text/html", 10, None)], log.schema)
    more = spark.createDataFrame([(3, "http://new.org/1", '<a href="/2"><a href="http://h.org/yes">')], pages.schema)
    waiting = []
    for now, responses, read in ((NOW - 3000, log, pages), (NOW + 3000, log2, more), (NOW + 6000, log2.limit(0), more)):
        want = lg.frontier_round(responses, read, *model, rules, now, "bot")
        done = store.round(responses, read, rules, now, "bot")
        columns = ("url", "next_request_ms")
        assert rows(done.due, *columns) == rows(want.due, *columns)
        assert rows(store.head.read(done.version), *columns) == rows(want.frontier, *columns)
        assert rows(store.seen.read(done.version), "url") == rows(want.seen, "url")
        host_columns = ("host", "crawl_delay", "next_request_ms")
        assert rows(store.hosts.read(done.version), *host_columns) == rows(want.host_state, *host_columns)
        assert set(rows(done.moved, *host_columns)) >= set(rows(want.host_state, *host_columns)) - set(rows(model[2], *host_columns))
        waiting += rows(want.fetch, *columns)
        now_due = [r for r in waiting if r[1] < now + 2000]
        waiting = [r for r in waiting if r not in now_due]
        assert rows(done.fetch, *columns) == sorted(now_due) and rows(store.get.read(done.version), *columns) == sorted(waiting)
        assert set(rows(done.new, "url")) == set(rows(want.seen, "url")) - set(rows(model[1], "url"))
        model = (want.frontier, want.seen, want.host_state)
    store.forget()
    assert rows(store.head.read(store.version()), "url") == rows(model[0], "url")
    store.clear()
    assert store.head.read(store.version()).count() == 0 and rows(store.seen.read(store.version()), "url") == rows(model[1], "url")


def test_a_round_that_was_cut_off_is_tried_again(spark, monkeypatch):
    rules, pages, log, hosts, frontier, seen = crawl(spark)
    path = scratch_path(spark, "store")
    store = lg.StoredFrontier(spark, path, slot_ms=1000, buckets=2, cells=8)
    store.begin(frontier, hosts, seen)
    with monkeypatch.context() as broken:
        broken.setattr(store, "_complete", lambda _: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.round(log, pages, rules, NOW + 3000, "bot")
    again = lg.StoredFrontier(spark, path, slot_ms=1000, buckets=2, cells=8)
    assert again.version() == 1 and rows(again.head.read(1), "url") == [("http://h.org/waiting",)]
    done = again.round(log, pages, rules, NOW + 3000, "bot")
    assert rows(done.due, "url") == [("http://h.org/yes",), ("http://k.org/k1",), ("http://k.org/r",)]
    assert again.seen.read(done.version).count() == 7
    with pytest.raises(ValueError):
        again.begin(frontier, hosts)
