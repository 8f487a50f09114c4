import random
import re

import pytest
from pyspark.sql import functions as F

import linkgraph as lg

TEXT = """User-agent: *
Disallow: /private
Crawl-delay: 0.5

User-agent: mybot
User-agent: other
Disallow: /tmp/
Disallow:
Allow: /tmp/ok
Crawl-delay: 3
Sitemap: http://h.org/s.xml

User-agent: last
Disallow:"""


def parse(spark, *bodies):
    return lg.parse_robots(spark.createDataFrame(list(bodies), "host string, body string"))


def triples(rules):
    return sorted((r.host, r.agent, r.directive, r.value) for r in rules.collect())


def test_rows(spark):
    shared = [("disallow", "/tmp/"), ("disallow", ""), ("allow", "/tmp/ok"), ("crawl-delay", "3.0"), ("sitemap", "http")]
    want = [("h", "*", "disallow", "/private"), ("h", "*", "crawl-delay", "1.0")]
    want += [("h", agent, *rule) for agent in ("mybot", "other") for rule in shared]
    assert triples(parse(spark, ("h", TEXT))) == sorted(want)


def test_delays(spark):
    rules = parse(spark, ("h", TEXT), ("k", "User-agent: *\nDisallow: /x"), ("bad", "User-agent: *\nCrawl-delay: soon"),
                  ("two", "User-agent: *\nCrawl-delay: 2\n\nUser-agent: *\nCrawl-delay: 1.5\nCrawl-delay: 4"))
    for agent, want in (("mybot", 3.0), ("last", 1.0), ("nobody", 1.0)):
        got = {r.host: r.crawl_delay for r in lg.effective_delay(rules, agent).collect()}
        assert got == {"h": want, "k": 1.0, "two": 4.0}
    gathered = {(r.host, r.agent): r for r in lg.host_rules(rules).collect()}
    assert gathered[("h", "mybot")].disallow == ["/tmp/", ""]
    assert gathered[("h", "mybot")].allow == ["/tmp/ok"]
    assert gathered[("h", "other")].crawl_delay == 3.0
    assert gathered[("k", "*")].crawl_delay is None and gathered[("k", "*")].sitemaps == []


@pytest.mark.parametrize("agent, path, ok", [
    ("mybot", "/tmp/x", False), ("mybot", "/tmp", False), ("mybot", "/private/x", True), ("mybot", "/tmp/ok", False),
    ("nobody", "/privateer", False), ("nobody", "/ok", True), ("last", "/private", False), ("mybot", "", True)])
def test_paths(spark, agent, path, ok):
    frontier = spark.createDataFrame([(f"http://h{path}", "h", 1), ("http://free/private", "free", 2)],
                                     "url string, host string, n int")
    got = lg.allowed(frontier, parse(spark, ("h", TEXT)), agent)
    assert got.columns == frontier.columns
    assert {r.n for r in got.collect()} == ({1, 2} if ok else {2})


def test_literal_urls(spark):
    frontier = spark.createDataFrame([("http://h/ok", "h"), ("http://h/private", "h")], "url string, host string")
    rules = parse(spark, ("h", TEXT))
    assert lg.allowed(frontier, rules, "mybot", "url").count() == 0
    assert lg.allowed(frontier, rules, "nobody", "url").count() == 2
    with pytest.raises(ValueError):
        lg.allowed(frontier, rules, "mybot", "host")


def expected_rows(body):
    """The same rules by plain loops."""
    rows = []
    for block in body.split("\n\n"):
        tokens = re.split("[\n:]", block.rstrip("\n:"))
        pairs = [(tokens[i].strip().lower(), tokens[i + 1].strip()) for i in range(len(tokens) - 1)]
        rules = [p for p in pairs if p[0] in ("disallow", "allow", "sitemap")]
        delays = [v for k, v in pairs if k == "crawl-delay"]
        if delays and re.fullmatch(r"\d+(\.\d+)?", delays[-1]):
            rules.append(("crawl-delay", str(max(float(delays[-1]), 1.0))))
        rows += [(agent, *rule) for key, agent in pairs if key == "user-agent" for rule in rules]
    return rows


def test_random_texts(spark):
    rng = random.Random(11)
    words = ["User-agent", "Disallow", "ALLOW ", " crawl-delay", "Sitemap", "*", "bot", "/x", "2", "0.1", "abc", "", " "]
    bodies = ["".join(rng.choice(words) + rng.choice([":", ": ", "\n", "\n\n", ""]) for _ in range(rng.randint(0, 24)))
              for _ in range(400)]
    got = parse(spark, *[(str(i), body) for i, body in enumerate(bodies)])
    want = sorted((str(i), *row) for i, body in enumerate(bodies) for row in expected_rows(body))
    assert triples(got) == want


def test_order_follows_the_text(spark):
    body = "\n\n".join(f"User-agent: a\nDisallow: /{i}\nDisallow: /{i}x" for i in range(20))
    rows = parse(spark, ("h", body)).orderBy("ord").collect()
    assert [r.value for r in rows] == [v for i in range(20) for v in (f"/{i}", f"/{i}x")]


def test_many_rules_and_urls_of_one_host(spark):
    body = "User-agent: *\n" + "\n".join(f"Disallow: /d{i}/" for i in range(3000))
    urls = spark.range(4000).select(F.concat(F.lit("http://h/d"), "id", F.lit("/x")).alias("url"), F.lit("h").alias("host"))
    got = lg.allowed(urls, parse(spark, ("h", body)), "bot")
    assert got.count() == 1000


def test_search_equals_comparing_with_every_value(spark):
    """Nested, repeated and empty values, texts between them, and letters whose byte order differs from UTF-16."""
    rng = random.Random(11)
    letters = "ab/～\U0001f600"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 4))) for _ in range(400)]
    lists = [None, [], [""], *[rng.sample(words, rng.randint(1, 12)) for _ in range(60)]]
    rows = [(text, values) for values in lists for text in [*rng.sample(words, 25), None]]
    pairs = spark.createDataFrame(rows, "tested string, prefixes array<string>")
    for match_on in ("path", "url"):
        searched = pairs.withColumn("searched", lg.operators.robots.search_list("prefixes", match_on))
        for row in searched.withColumn("hit", lg.operators.robots.is_excluded("tested", "searched")).collect():
            used = [p for p in row.prefixes or [] if p or match_on == "url"]
            assert row.hit == (row.tested is not None and any(row.tested.startswith(p) for p in used)), row


def test_many_rules_of_a_host(spark):
    rules = spark.range(10_000).select(
        F.lit("h").alias("host"), F.lit("*").alias("agent"), F.lit("disallow").alias("directive"),
        F.format_string("/%d/x", "id").alias("value"), F.col("id").alias("ord"))
    urls = spark.range(20_000).select(F.format_string("http://h/%d/%s", F.col("id"), F.when(
        F.col("id") % 2 == 0, "xy").otherwise("y")).alias("url"), F.lit("h").alias("host"))
    # even numbers below 10,000 are excluded
    assert lg.allowed(urls, rules, "bot").count() == 15_000
