import hashlib
import random

import pytest
from pyspark.sql import functions as F

from linkgraph.functions.buckets import host_bucket
from linkgraph.functions.urls import absolute_url, dotdot_count, is_legal, resolve_url, resolve_urls, url_parts
from linkgraph.operators.frontier import drop_trap_urls

RESOLVED = [
    ("c.html", "/a/b", "http://h.org/a/b/c.html"),
    ("c.html", "/a/b.html", "http://h.org/a/c.html"),
    ("c.html", "", "http://h.org/c.html"),
    ("c.html", "/a/", "http://h.org/a/c.html"),
    ("/c", "/a/b", "http://h.org/c"),
    ("//k.org/x", "/a/b", "http://k.org/x"),
    ("https://k.org/y#f", "/a/b", "https://k.org/y#f"),
    ("HTTP://A.org/q", "/a/b", "http://A.org/q"),
    ("", "/a/b", "http://h.org/a/b/"),
    ("?q=1", "/a/b", "http://h.org/a/b/?q=1"),
    ("#f", "/a/b", "http://h.org/a/b/#f"),
    ("../x", "/a/b", "http://h.org/a/b/../x"),
    ("/para,", "/a/b", "http://h.org/para,"),
    ("/für", "/a/b", "http://h.org/für"),
    ("mailto:x@y.z", "/a/b", "mailto:x@y.z"),
    *[(bad, "/a/b", None) for bad in (
        "javascript:void(0)", "tel:123", "a:80", "a b", "a|b", 'a"b', "a^b", "x%zz", "[x]", "http://", " /x",
        "//", "a_b:c", ":x", "mailto:", "http://h:port/", "#a#b", "/x\u00a0y", "/tab\t", "jar:foo")],
]


def test_resolve(spark):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(RESOLVED)], "i int, href string, path string, want string")
    got = df.select("href", "path", "want", resolve_url(
        F.col("href"), F.lit("http"), F.lit("h.org"), F.col("path")).alias("got")).collect()
    assert [(r.href, r.path, r.got) for r in got] == [(r.href, r.path, r.want) for r in got]


def test_resolve_array_equals_rows(spark):
    hrefs = [row[0] for row in RESOLVED]
    df = spark.createDataFrame([(hrefs, "/a/b")], "hrefs array<string>, path string")
    got = df.select(resolve_urls(F.col("hrefs"), F.lit("http"), F.lit("h.org"), F.col("path"))).first()[0]
    rows = df.select(F.posexplode("hrefs").alias("i", "href"), "path")
    want = rows.select("i", resolve_url(F.col("href"), F.lit("http"), F.lit("h.org"), F.col("path")).alias("u"))
    assert got == [r.u for r in want.orderBy("i").collect() if r.u is not None]


def jdk(spark, link):
    """What the JDK's own classes make of an absolute link."""
    net = spark._jvm.java.net
    try:
        net.URI(link)
        return net.URL(link).toString()
    except Exception:
        return None


FIXED = [
    "http://h.org/a/../x", "http://h.org/?a[]=1", "http://h.org/a[0]", "http://h.org/#a[0]", "http:x",
    "http:/x", "http:///x", "http://?q", "http://#f", "http://h:99999/", "http://h:/x", "http://[::1]/x",
    "http://[zz]/x", "http://u@h.org/x", "http://a_b.com/", "file:///x", "ftp://a/x", "url:http://x/",
    "http:////x", "http://h.org:80:90/", "mailto:a[b]", "http:#f", "http:?q", "http://h[1]/",
    "http://h:2147483648/", "jar:http://a/b!/c", "ws://a/b", "http://h.org?q|", "data:text/html,x"]


def test_absolute_urls_agree_with_the_jdk(spark):
    rng = random.Random(7)
    pieces = ["http", "https", "ftp", "data", ":", "//", "/", "h.org", "a_b.c", "u@", ":80", "?", "#", "%41", "%4",
              "[", "]", " ", "|", "é", ",", "..", "x", "=", "&", "!", "\u2003", "\\", "~", "+", "'", ";"]
    links = set(FIXED)
    while len(links) < 600:
        head = rng.choice(["http://h.org", "https://k.org:8080", "HTTP://A", "mailto:", "http:", ""])
        links.add(head + "".join(rng.choices(pieces, k=rng.randint(0, 6))))
    links = sorted(links)
    df = spark.createDataFrame([(link,) for link in links], "link string")
    got = {r.link: r.u for r in df.select("link", absolute_url(F.col("link")).alias("u")).collect()}
    wrong = {link: (got[link], jdk(spark, link)) for link in links if got[link] != jdk(spark, link)}
    assert wrong == {}


def test_link_syntax_agrees_with_the_jdk(spark):
    rng = random.Random(8)
    pieces = ["a", "B-c", ":", "//", "/", "h.org", "_", "@", ":80", "?", "#", "%41", "%4g", "[", "]", "[::1]", " ", "|",
              "é", ",", "..", "1", "=", "&", "\u00a0", "\u0085", "\x7f", "+", "'", ";", "http:", "mailto:", "$", "^"]
    links = sorted({"".join(rng.choices(pieces, k=rng.randint(0, 5))) for _ in range(1500)})

    def legal(link):
        try:
            spark._jvm.java.net.URI(link)
            return True
        except Exception:
            return False

    df = spark.createDataFrame([(link,) for link in links], "link string")
    got = {r.link: r.ok for r in df.select("link", is_legal(F.col("link")).alias("ok")).collect()}
    assert {link: got[link] for link in links if got[link] != legal(link)} == {}


def test_parts(spark):
    df = spark.createDataFrame([("HTTP://u@A_b.Org:80/x/y?q#f",), ("http://h.org",), ("mailto:x@y",), ("https://[::1]:8/p",)], "url string")
    got = [tuple(r.p) for r in df.select(url_parts(F.col("url")).alias("p")).collect()]
    assert got == [("http", "A_b.Org", "/x/y"), ("http", "h.org", ""), ("mailto", "", "x@y"), ("https", "[::1]", "/p")]


def test_traps(spark):
    urls = ["http://h.org/a/../../../x", "http://h.org/../../x", "http://h.org/....../x", "http://h.org/...../x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r.url for r in drop_trap_urls(df).collect()] == [urls[1], urls[3]]
    assert [r[0] for r in df.select(dotdot_count(F.col("url"))).collect()] == [3, 2, 3, 2]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 16, 100, 1000])
def test_bucket_is_that_of_the_exact_number(spark, n):
    hosts = [f"h{i}.org" for i in range(2000)] + ["", "h.org", "k.org", "example.com", "für.de"]
    width = 2 ** 160 // n

    def exact(host):
        return min(int(hashlib.sha1(host.encode()).hexdigest(), 16) // width, n - 1)

    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = df.select("host", host_bucket(F.col("host"), n).alias("b")).collect()
    assert [r.b for r in got] == [exact(r.host) for r in got]


def test_bucket_goldens(spark):
    want = {"h.org": (1, 1, 3), "k.org": (0, 0, 1), "example.com": (0, 0, 0), "": (1, 2, 4)}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    got = df.select("host", *[host_bucket(F.col("host"), n) for n in (2, 3, 5)]).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want
