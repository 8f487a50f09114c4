import random
import time

import pytest
from pyspark.sql import functions as F

import linkgraph as lg
from linkgraph.streaming.due import start_due
from linkgraph.streaming.schedule import start_schedule
from linkgraph.streaming.sinks import with_rolling_window

HOSTS = "host string, crawl_delay double, next_request_ms bigint"


class Source:
    """A folder read as a stream, one file per batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, rows):
        (self.spark.createDataFrame(rows, self.schema).coalesce(1)
         .write.mode("append").parquet(self.path))

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def done(query):
    query.awaitTermination()
    assert query.exception() is None


def test_admission(spark, tmp_path):
    source = Source(spark, tmp_path / "in", "url string, ts timestamp")
    seen = spark.createDataFrame([("old",)], "url string")

    def run():
        admitted = lg.stream_admit(source.stream().select("url"), seen)
        done(lg.start_rolling_sink(admitted, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True))
        return sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect())

    source.add([(u, None) for u in ["a", "b", "a", "old", "x/../../../y"] + ["hot"] * 500])
    source.add([(u, None) for u in ["b", "c", "hot"]])
    assert run() == ["a", "b", "c", "hot"]
    source.add([(u, None) for u in ["c", "d", "hot"]])
    assert run() == ["a", "b", "c", "d", "hot"]


def test_admission_for_a_while(spark, tmp_path):
    source = Source(spark, tmp_path / "in", "url string, ts timestamp_ltz")
    from datetime import datetime
    source.add([("a", datetime(2024, 1, 1, 0, 0)), ("b", datetime(2024, 1, 1, 0, 0)), ("a", datetime(2024, 1, 1, 0, 1))])
    source.add([("b", datetime(2024, 1, 1, 0, 5)), ("c", datetime(2024, 1, 1, 0, 5))])
    admitted = lg.stream_admit(source.stream(), watermark=("ts", "1 hour"))
    done(lg.start_rolling_sink(admitted, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True))
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("snapshot_every", [2, 100])
def test_schedule_goes_on_between_batches(spark, tmp_path, snapshot_every):
    rng = random.Random(1)
    state = [("hot", 1.5, 1000), ("a", 1.0, 0), ("idle", 1.0, 7)]
    rows = [(f"u{i}", rng.choice(["hot", "hot", "a", "unknown"]), i) for i in range(300)]
    source = Source(spark, tmp_path / "in", "url string, host string, arrival bigint")
    hosts = spark.createDataFrame(state, HOSTS)
    path = str(tmp_path / "out")

    def run():
        done(start_schedule(source.stream(), hosts, path, str(tmp_path / "state"), snapshot_every=snapshot_every,
                            available_now=True))

    for start in (0, 50, 100, 150):
        source.add(rows[start:start + 50])
    run()
    for start in (200, 250):
        source.add(rows[start:start + 50])
    run()
    got = {r.url: r.next_request_ms for r in spark.read.parquet(f"{path}/frontier").collect()}
    new = spark.createDataFrame(rows, "url string, host string, arrival bigint")
    want = {r.url: r.next_request_ms for r in lg.schedule(new, hosts).frontier.collect()}
    assert got == want


def test_a_repeated_batch_replaces_its_output(spark, tmp_path):
    hosts = spark.createDataFrame([("h", 1.0, 0)], HOSTS)
    source = Source(spark, tmp_path / "in", "url string, host string, arrival bigint")
    source.add([("a", "h", 1), ("b", "h", 2)])
    for attempt in ("one", "two"):  # a new state folder makes batch 0 run again
        done(start_schedule(source.stream(), hosts, str(tmp_path / "out"), str(tmp_path / attempt), available_now=True))
    got = spark.read.parquet(str(tmp_path / "out/frontier")).collect()
    assert sorted((r.url, r.next_request_ms) for r in got) == [("a", 1000), ("b", 2000)]


def test_due_releases_each_url_once_and_in_time(spark, tmp_path):
    rng = random.Random(2)
    source = Source(spark, tmp_path / "in", "url string, next_request_ms bigint")
    batches = [[(f"b{b}-{i}", rng.randint(0, 100_000)) for i in range(60)] for b in range(5)] + [[("last", 50)]]
    clock = [10_000, 30_000, 30_000, 25_000, 60_000, 200_000]  # it may stand still or go back
    for batch in batches:
        source.add(batch)
    done(start_due(source.stream(), str(tmp_path / "out"), str(tmp_path / "state"), clock=lambda b: clock[b],
                   slot_ms=7000, available_now=True))
    rows = spark.read.parquet(str(tmp_path / "out/due")).collect()
    got = {r.url: r.batch for r in rows}
    assert len(rows) == len(got) == 301
    for arrived, batch in enumerate(batches):
        for url, at in batch:
            assert got[url] == min(b for b in range(arrived, 6) if at < max(clock[:b + 1]) + 2000)


def test_due_writes_few_folders_however_far_urls_reach(spark, tmp_path):
    source = Source(spark, tmp_path / "in", "url string, next_request_ms bigint")
    urls = [(f"u{i}", i * 1000) for i in range(2000)] + [("far", 10**15), ("before", -5)]
    source.add(urls)
    for _ in range(6):
        source.add([])
    clock = [0, 30_000, 70_000, 70_500, 1_000_000, 1_990_000, 10**15]

    def run(state, batches):
        done(start_due(source.stream(), str(tmp_path / "out"), str(tmp_path / state), horizon_ms=0, slot_ms=1000,
                       clock=lambda b: clock[b] - (b == 0 and state == "first") * 40_000, available_now=True))

    run("first", 1)  # a new state folder makes batch 0 run again, at another time
    run("second", 7)
    assert len(list((tmp_path / "out/waiting").glob("slot=*"))) <= 64 * 2 + 2000 // 64 + 2
    got = {r.url: r.batch for r in spark.read.parquet(str(tmp_path / "out/due")).collect()}
    rows = spark.read.parquet(str(tmp_path / "out/due")).count()
    want = {url: min(b for b in range(7) if at < clock[b] or at < 0) for url, at in urls if at < clock[6]}
    assert got == want and rows == len(want)


def test_due_is_released_without_a_further_arrival(spark, tmp_path):
    source = Source(spark, tmp_path / "in", "url string, next_request_ms bigint")
    source.add([("now", 0), ("soon", 7_000), ("later", 10**12), ("untimed", None)])
    query = start_due(source.stream(), str(tmp_path / "out"), str(tmp_path / "state"), slot_ms=1000, horizon_ms=0,
                      clock=lambda b: 1_000 + b * 10_000, every="1 second")
    try:
        deadline = time.time() + 90
        while time.time() < deadline and not query.exception():
            if query.lastProgress and query.lastProgress["batchId"] >= 3:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    rows = {r.url: r.batch for r in spark.read.parquet(str(tmp_path / "out/due")).collect()}
    assert set(rows) == {"now", "soon", "untimed"} and rows["soon"] > rows["now"] == rows["untimed"]


def test_hosts_registered_later_are_polite(spark, tmp_path):
    source = Source(spark, tmp_path / "in", "url string, host string, arrival bigint")
    entries = Source(spark, tmp_path / "entries", HOSTS)
    hosts = spark.createDataFrame([("old", 1.0, 0)], HOSTS)
    path = str(tmp_path / "out")

    def run():
        done(start_schedule(source.stream(), hosts, path, str(tmp_path / "state"), snapshot_every=2,
                            available_now=True, registrations=entries.stream()))

    source.add([("a1", "new", 1), ("o1", "old", 2)])
    entries.add([("other", 1.0, 5)])
    run()
    entries.add([("new", 2.0, 10_000)])
    source.add([("a2", "new", 3), ("a3", "new", 4)])
    run()
    for i in range(4, 8):
        source.add([(f"a{i}", "new", i + 1)])
        run()
    got = {r.url: r.next_request_ms for r in spark.read.parquet(f"{path}/frontier").collect()}
    assert got == {"a1": 0, "o1": 1000, "a2": 12_000, "a3": 14_000, "a4": 16_000, "a5": 18_000, "a6": 20_000, "a7": 22_000}


def test_page_stream(spark, tmp_path):
    source = Source(spark, tmp_path / "in", "page_id bigint, url string, html string")
    source.add([(1, "http://h/1", ' <a href="/x"> ')])
    source.add([(2, "http://h/2", "none"), (3, "http://h/3", '<a href="y"><a href="tel:1">')])
    path = str(tmp_path / "out")
    done(lg.start_crawl_outputs(source.stream(), path, str(tmp_path / "state"), available_now=True))
    links = {r.source: (r.targets, r.batch) for r in spark.read.parquet(f"{path}/links").collect()}
    assert links == {"http://h/1": (["http://h/x"], 0), "http://h/2": ([], 1), "http://h/3": (["http://h/3/y"], 1)}
    bodies = {r.url: r.body for r in spark.read.parquet(f"{path}/documents").collect()}
    assert bodies["http://h/1"] == '<a href="/x">' and len(bodies) == 3


def test_windows(spark, tmp_path):
    from datetime import datetime, timedelta
    base = datetime(2024, 1, 1)
    rows = [(i, base + timedelta(seconds=i * 7)) for i in range(40)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp")
    counts = {r.window_start: r.n for r in lg.arrivals_per_window(events).collect()}
    rolled = with_rolling_window(events).groupBy("window_start").count()
    assert counts == {r.window_start: r["count"] for r in rolled.collect()}
    assert sum(counts.values()) == 40 and all((b - base).seconds % 30 == 0 for b in counts)
    lg.write_rolled(events, str(tmp_path / "rolled"))
    assert spark.read.parquet(str(tmp_path / "rolled")).select("window_start").distinct().count() == len(counts)


def test_url_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.txt").write_text(" a \nb\na\n")
    admitted = lg.stream_admit(lg.stream_url_batches(spark, str(tmp_path / "in")))
    done(lg.start_rolling_sink(admitted, str(tmp_path / "out"), str(tmp_path / "state"), available_now=True))
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "out")).select(F.col("url")).collect()) == ["a", "b"]


def test_a_replayed_table_is_derived_once(spark):
    from catalog.queries import replay
    made = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(value):
        made.add(1)
        return value

    rows = spark.range(90).select(counted("id").alias("id"))
    seen = []

    class Ended:
        def awaitTermination(self):
            pass

    stream = replay(rows, "id", lambda arriving: seen.append(1) or Ended())
    assert made.value == 90 and len(seen) == 3 and stream.isStreaming
