import time

import pytest
from pyspark.sql import functions as F

from linkgraph.functions.html import anchor_hrefs, decode_references
from linkgraph.functions.text import normalise_body
from linkgraph.operators.exchange import urls_per_node, write_exchange
from linkgraph.operators.pages import candidate_urls, crawl_outputs, extract_links, resolve_links

HTML = """<html><a href="/1">1</a><!-- <a href="/no"> --><script>"<!--"; '<a href="/no">'</script>
<A class='k' data-x="a>b" HREF = '/2&amp;x&#x41;&#66;'>q</A><a href>e</a><a id=q href=/3?x=1>t</a><a name=h>
<area href="/no"><abbr href="/no"></abbr><title><a href="/no"></title><a href=""></a><a
  href="/4"/><style>a{}</style><a href="/1">again</a><STYLE><a href="/no"></STYLE ><!-- open <a href="/no">"""
HREFS = ["/1", "/2&xAB", "", "/3?x=1", "", "/4", "/1"]


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "page_id bigint, url string, html string")


def test_anchors(spark):
    df = pages(spark, (1, "http://h.org/a", HTML))
    assert df.select(anchor_hrefs(F.col("html"))).first()[0] == HREFS
    assert [r.href for r in extract_links(df).orderBy("ord").collect()] == HREFS


@pytest.mark.parametrize("html,hrefs", [
    ("<!--> <a href=/a> <!-- c --!> <a class='k'href='/1'><!---><a href=/b><!-- <a href=/no> -->", ["/a", "/1", "/b"]),
    ('<a title="<a href=/no>" href=/b/c/><img alt="<a href=/no>"><a u=a/b u=a/b v="x">', ["/b/c/"]),
    ('<a href="/open> <a href=/no', []),
    ("<a ahref=/no hrefx=/no href=/yes href=/second>", ["/yes"]),
    ('<a href=>x</a><a href = "x"y="z"><a/href=/s><A\nHREF\n=\n/t>', ["", "x", "/s", "/t"]),
    ("<script><a href=/no></scripty><a href=/no></script ><a href=/x>", ["/x"]),
    ("<?xml <a href=/no>?><!doctype html><a =href=/no href=/d></a href=/no>", ["/d"]),
    ("a < b <a> <3 <a href=/e", []),
    ('<a href="/q?x=1&lt=2&copy;&#65&#x42;">', ["/q?x=1&lt=2©AB"]),
])
def test_markup_as_a_parser_sees_it(spark, html, hrefs):
    assert [r.href for r in extract_links(pages(spark, (1, "http://h.org/a", html))).orderBy("ord").collect()] == hrefs


@pytest.mark.parametrize("html,hrefs", [
    ("<a " + " ".join(f'd{i}="v"' for i in range(100_000)) + ' href="/end">', ["/end"]),
    ("<a " + " ".join(f"u=a/b{i}" for i in range(1000)) + "> <a href=/z>", ["/z"]),
    ("<a u=a/b" * 20_000 + ">", []),
    ("<a href=" * 20_000, []), ("<!--" * 50_000, []), ("<script>" * 20_000, []), ('<a "' * 20_000, []),
])
def test_time_is_linear_and_the_stack_is_flat(spark, html, hrefs):
    start = time.perf_counter()
    assert [r.href for r in extract_links(pages(spark, (1, "http://h.org/a", html))).collect()] == hrefs
    assert time.perf_counter() - start < 20


def test_long_texts_do_not_exhaust_the_stack(spark):
    filler = "<p>" + "x" * 2_000_000 + "</p><!--" + "y" * 2_000_000 + "--><script>" + "z" * 2_000_000 + "</script>"
    attributes = " ".join(f'data-{i}="{"v" * 50}"' for i in range(500))
    df = pages(spark, (1, "http://h.org/", filler + f'<a {attributes} href="/end">'))
    assert [r.href for r in extract_links(df).collect()] == ["/end"]
    link = "/" + "%41b" * 20_000
    df = pages(spark, (1, "http://h.org/", f'<a href="{link}">'))
    assert [r.link for r in resolve_links(extract_links(df)).collect()] == ["http://h.org" + link]


def test_decode(spark):
    df = spark.createDataFrame([
        ("a&lt;b&#228;&#x1F600;&#xD800;&amp;amp;&nope;",), ("&#38;lt;&#00000065;&eacute;&amp;lt;&#38;amp;",),
        ("&copy=1&copy;&copyx;&copy &#0;&#x80;&#x110000;&notin;&",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(decode_references(F.col("t"))).collect()] == [
        "a<bä😀�&amp;&nope;", "&lt;Aé&lt;&amp;", "&copy=1©&copyx;© �€�∉&", "", None]


def test_normalise(spark):
    df = spark.createDataFrame([(" \r\n\x01a\r\nb\rc\n\n d\t \n",)], "t string")
    assert df.select(normalise_body(F.col("t"))).first()[0] == "a\nb\nc\n\n d"


def test_outputs_keep_pages_without_links(spark):
    df = pages(spark, (1, "http://h.org/a/b?x", ' <a href="c"><a href="/d"><a href="tel:1"><a href="c">\r\n'),
               (2, "https://k.org", "<p>no links</p>"), (3, "https://k.org/3", None))
    got = {r.page_id: (r.body, r.targets) for r in crawl_outputs(df).collect()}
    assert got[1][1] == ["http://h.org/a/b/c", "http://h.org/d", "http://h.org/a/b/c"]
    assert got[1][0].endswith('<a href="c">')
    assert got[2] == ("<p>no links</p>", []) and got[3] == (None, [])


def test_candidates_are_web_urls(spark):
    df = pages(spark, (1, "http://h.org/", '<a href="mailto:a@b"><a href="https://K.org:8/x"><a href="ftp://f/x">'))
    assert [tuple(r) for r in candidate_urls(df).collect()] == [(1, 1, "https://K.org:8/x", "K.org")]


def test_routing_keeps_page_order(spark, tmp_path):
    targets = [f"http://h{i % 7}.org/{i}" for i in range(30)] + ["mailto:x@y"]
    df = spark.createDataFrame([(1, targets)], "page_id bigint, targets array<string>")
    batches = {r.node: r.urls for r in urls_per_node(df, 3).collect()}
    assert sorted(sum(batches.values(), [])) == sorted(targets)
    for urls in batches.values():
        assert urls == [u for u in targets if u in urls]
    path = str(tmp_path / "exchange")
    write_exchange(df.select(F.explode("targets").alias("url")), path, 3)
    written = spark.read.text(path)
    assert {r.node for r in written.collect()} == set(batches)
    assert sorted(r.value for r in written.collect()) == sorted(targets)
