"""Edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def to_edges(links: DataFrame) -> DataFrame:
    """One row per occurrence of a target: ``src, dst``."""
    return links.select(F.col("source").alias("src"), F.explode("targets").alias("dst"))


def drop_self_links(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src") != F.col("dst"))


def edge_pairs(edges: DataFrame, distinct_edges: bool = False) -> DataFrame:
    """``src, dst, m``: each pair once with the number of its links (or 1 each)."""
    m = F.lit(1).cast("bigint") if distinct_edges else F.count(F.lit(1))
    return drop_self_links(edges).groupBy("src", "dst").agg(m.alias("m"))


def weighted_edges(edges: DataFrame, distinct_edges: bool = False) -> DataFrame:
    """``src, dst, w``: the share of the source's rank a link passes on.

    A view for export; the rank steps keep the degree with the node instead of with every edge.
    Degrees are grouped by one more key than the join, so that it shuffles both sides and adaptive
    execution can split a hub.
    """
    pairs = edge_pairs(edges, distinct_edges)
    degrees = pairs.groupBy("src", F.hash("src").alias("src_hash")).agg(
        F.sum("m").alias("out_degree")).drop("src_hash")
    return pairs.join(degrees, "src").select("src", "dst", (F.col("m") / F.col("out_degree")).alias("w"))
