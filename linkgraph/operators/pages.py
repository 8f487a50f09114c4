"""Pages to links and documents.

All of a page's links come from its own row, so these are narrow projections: no HTML is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkgraph.functions.html import anchor_hrefs
from linkgraph.functions.text import normalise_body
from linkgraph.functions.urls import (
    host_of, is_web_url, path_of, resolve_url, resolve_urls, scheme_of)


def with_hrefs(pages: DataFrame) -> DataFrame:
    """Add ``hrefs``; empty for a page without anchors or without HTML."""
    none = F.array().cast("array<string>")
    return pages.withColumn("hrefs", F.coalesce(anchor_hrefs(F.col("html")), none))


def extract_links(pages: DataFrame) -> DataFrame:
    """Every anchor of every page: ``page_id, url, ord, href``."""
    return with_hrefs(pages).select("page_id", "url", F.posexplode("hrefs").alias("ord", "href"))


def resolve_links(hrefs: DataFrame) -> DataFrame:
    """Hrefs against the URL of their page: ``page_id, url, ord, link``; bad ones are dropped.

    The link is made and tested inside one generator, as a plain filter would be pushed below the
    projection and work every link out twice.
    """
    link = resolve_url(F.col("href"), scheme_of(F.col("url")), host_of(F.col("url")), path_of(F.col("url")))
    good = F.filter(F.array(link), lambda item: item.isNotNull())
    return hrefs.select("page_id", "url", "ord", F.explode(good).alias("link"))


def crawl_outputs(pages: DataFrame) -> DataFrame:
    """What a fetched page leaves behind: ``page_id, url, body, targets``.

    Pages without links keep an empty list.
    """
    url = F.col("url")
    site = F.struct(scheme_of(url).alias("scheme"), host_of(url).alias("host"), path_of(url).alias("path"))
    targets = F.flatten(F.transform(F.array(site), lambda page: resolve_urls(
        F.col("hrefs"), page["scheme"], page["host"], page["path"])))  # the parts are worked out once a page
    return with_hrefs(pages).select(
        "page_id", "url", normalise_body(F.col("html")).alias("body"), targets.alias("targets"))


def page_links(outputs: DataFrame) -> DataFrame:
    """The link table of crawled pages: ``source, targets``."""
    return outputs.select(F.col("url").alias("source"), "targets")


def candidate_urls(pages: DataFrame) -> DataFrame:
    """Fetchable links of pages: ``page_id, ord, url, host``, with ``ord`` among the usable links.

    Pages that already have ``targets`` are not parsed again.
    """
    outputs = pages if "targets" in pages.columns else crawl_outputs(pages)
    targets = outputs.select(
        "page_id", F.posexplode("targets").alias("ord", "url"))
    return targets.where(is_web_url(F.col("url"))).withColumn("host", host_of(F.col("url")))
