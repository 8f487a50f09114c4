"""A hot host or source is split: what adaptive execution does with the joins, and what the plans do."""

import pytest
from pyspark.sql import functions as F

import linkgraph as lg
from linkgraph.session import checkpointed

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture(autouse=True)
def small_partitions(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def urls(spark):
    """A third of 60,000 URLs on one host, from several tasks."""
    host = F.when(F.col("id") % 3 == 0, F.lit("hot.org")).otherwise(F.concat(F.lit("h"), F.col("id") % 5000))
    return spark.range(0, 60_000, numPartitions=8).select(
        F.concat(F.lit("http://"), host, F.lit("/p/"), F.sha1(F.col("id").cast("string"))).alias("url"),
        host.alias("host"), F.col("id").alias("arrival"))


@pytest.fixture
def hosts(urls):
    return checkpointed(urls.select("host").distinct().select(
        "host", F.lit(1.5).alias("crawl_delay"), F.lit(1000).cast("bigint").alias("next_request_ms")))


def rules(hosts):
    return hosts.select("host", F.lit("*").alias("agent"), F.lit("disallow").alias("directive"),
                        F.explode(F.array(F.lit("/p/0"), F.lit("/p/f"))).alias("value"),
                        F.lit(1).cast("bigint").alias("ord"))


def split(df):
    """Run ``df``; whether a join split a skewed partition."""
    rows = df.collect()
    return len(rows), "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_host_lookup_is_split(urls, hosts):
    assert split(lg.with_host_state(urls, hosts)) == (60_000, True)


def test_robots_test_is_split(urls, hosts):
    count, skewed = split(lg.allowed(urls, rules(hosts), "bot"))
    kept = urls.where(~F.substring_index("url", "/", -1).rlike("^[0f]")).count()
    assert (count, skewed) == (kept, True)


def test_registration_is_split(urls, hosts):
    count, skewed = split(lg.register_hosts(urls, rules(hosts), 5, "bot").requeued)
    assert (count, skewed) == (60_000, True)


def test_fetch_routing_is_split(urls, hosts):
    log = urls.select("url", F.lit(200).alias("status"), F.lit("text/html").alias("content_type"),
                      F.lit(5).cast("bigint").alias("content_length"), F.lit(None).cast("string").alias("location"))
    assert split(lg.route_fetches(log, hosts, 10)) == (60_000, True)


def test_schedule_numbers_a_hot_host_in_parts(spark, urls, hosts):
    splits = lg.operators.skew.order_splits(urls, "arrival", 2000)
    frontier = lg.schedule(urls, hosts, splits=splits).frontier
    plan = frontier._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(host" in plan and "slot" in plan
    hot = frontier.where("host = 'hot.org'").orderBy("arrival").collect()
    assert [r.next_request_ms for r in hot] == [1000 + 1500 * (i + 1) for i in range(20_000)]


def test_weighted_edges_of_a_hub_are_split(spark):
    src = F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise(F.col("id").cast("string"))
    edges = spark.range(0, 90_000, numPartitions=8).select(
        src.alias("src"), F.sha1(F.col("id").cast("string")).alias("dst"))
    assert split(lg.weighted_edges(edges)) == (90_000, True)


def test_urls_with_all_host_facts_are_split(urls, hosts):
    facts = checkpointed(hosts.select("host").join(
        lg.operators.robots.host_policy(rules(hosts), "bot"), "host", "full_outer"))
    assert split(urls.join(facts, "host", "left").select("url", "prefixes")) == (60_000, True)


def test_a_hot_node_is_written_as_several_files(spark, urls, tmp_path):
    path = str(tmp_path / "exchange")
    lg.write_exchange(urls, path, 3)
    assert spark.read.text(path).count() == 60_000
    files = [len(list((tmp_path / "exchange").glob(f"node={n}/*.txt"))) for n in range(3)]
    assert max(files) > 3 and sum(files) < 8 * 12


def test_a_bucketed_seen_table_is_not_shuffled(spark, urls):
    spark.sql("DROP TABLE IF EXISTS seen_urls")
    lg.append_seen(urls.where("arrival < 30000"), "seen_urls", 12)
    lg.append_seen(urls.where("arrival between 30000 and 30999"), "seen_urls", 12)
    seen = spark.table("seen_urls")
    new = lg.admit(urls, seen, "arrival").new
    assert new.count() == 29_000
    assert new._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
    spark.sql("DROP TABLE seen_urls")
