"""Routing of URLs to the nodes that own their hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkgraph.functions.buckets import host_bucket
from linkgraph.functions.urls import host_of
from linkgraph.operators.skew import balanced_by


def urls_per_node(outputs: DataFrame, n: int) -> DataFrame:
    """The batches a page sends out: ``page_id, node, urls`` in page order.

    A batch never outgrows the link list of its own page, and no shuffle is needed to build it.
    """
    tagged = F.transform(
        "targets", lambda link: F.struct(host_bucket(host_of(link), n).alias("node"), link.alias("url")))
    nodes = F.array_sort(F.array_distinct(F.transform("tagged", lambda item: item["node"])))
    batch = F.transform(
        F.filter("tagged", lambda item: item["node"] == F.col("node")), lambda item: item["url"])
    return (outputs.select("page_id", tagged.alias("tagged"))
            .select("page_id", "tagged", F.explode(nodes).alias("node"))
            .select("page_id", "node", batch.alias("urls")))


def write_exchange(links: DataFrame, path: str, n: int, mode: str = "error") -> None:
    """Write URLs (``url``) as text, one folder per owning node.

    Rows are brought together by node, but adaptive execution cuts a large node into several files.
    """
    routed = links.select(host_bucket(host_of(F.col("url")), n).alias("node"), "url")
    balanced_by(routed, "node").write.mode(mode).partitionBy("node").text(path)
