"""Rank propagation over an edge table.

Ranks are not normalised: every node starts at 1 and a step gives
``(1 - damping) + damping * sum(rank / out_degree)`` over the links to it. A node without links of
its own passes nothing on.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from linkgraph.operators.edges import drop_self_links, edge_pairs, to_edges
from linkgraph.session import drop_path, scratch_path, written

# Damping and the rank of a node before the first step.
DAMPING = 0.85
START_RANK = 1.0

# A source with more than this share of all edges is a hub, and one with more than an average
# partition; so there are never more than 1000 hubs or, if that is more, one per partition.
HUB_SHARE = 1 / 1000


class LinkGraph(NamedTuple):
    """Edges laid out for repeated steps.

    ``edges`` are partitioned by source, next to the ranks. Sources with a large share of all edges
    are kept apart in ``hub_edges`` (None if there are none), spread over all partitions; their few
    ranks (see HUB_SHARE) are broadcast. ``path`` holds the table all is built from.
    """
    nodes: DataFrame
    edges: DataFrame
    hub_edges: DataFrame | None
    hubs: DataFrame | None
    path: str

    def release(self) -> None:
        """Give up caches and files; what was not computed before cannot be computed any more."""
        for frame in (self.nodes, self.edges, self.hub_edges, self.hubs):
            if frame is not None:
                frame.unpersist()
        drop_path(self.nodes.sparkSession, self.path)


def degree_table(pairs: DataFrame) -> DataFrame:
    """``node, out_degree, fanout`` of all sources and targets.

    ``out_degree`` counts links and is NULL for a node that is only a target, ``fanout`` counts
    different targets.
    """
    ends = F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.col("m").alias("m")),
        F.struct(F.col("dst").alias("node"), F.lit(None).cast("bigint").alias("m"))))
    return (pairs.select(ends.alias("end")).groupBy("end.node")
            .agg(F.sum("end.m").alias("out_degree"), F.count("end.m").alias("fanout")))


def link_graph(edges: DataFrame, distinct_edges: bool = False,
               hub_share: float | None = None) -> LinkGraph:
    """Prepare ``edges`` (``src, dst``) for steps, in ``spark.sql.shuffle.partitions`` partitions.

    A ``hub_share`` below the default counts as the default, so the number of hubs stays bounded.
    The pairs are written once to the checkpoint folder, so that a lost executor costs a re-read and
    not a re-parse; what is cached on top of them is only a layout.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "pairs")
    pairs = written(edge_pairs(edges, distinct_edges), path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = hub_limit(pairs.count(), n, hub_share)
    nodes = _laid_out(degree_table(pairs), n, "node")
    hubs = nodes.where(F.col("fanout") > limit).select(F.col("node").alias("src")).persist()
    if hubs.isEmpty():
        hubs.unpersist()
        return LinkGraph(nodes, _laid_out(pairs, n, "src"), None, None, path)
    small_hubs = F.broadcast(hubs)
    cold = pairs.join(small_hubs, "src", "left_anti")
    hot = pairs.join(small_hubs, "src", "left_semi").persist()
    return LinkGraph(nodes, _laid_out(cold, n, "src"), hot, hubs, path)


def hub_limit(edges: int, partitions: int, hub_share: float | None = None) -> float:
    """How many different targets a source may have before it is a hub."""
    return edges * max(hub_share or 0, min(HUB_SHARE, 1 / partitions))


def _laid_out(rows: DataFrame, n: int, key: str) -> DataFrame:
    """Cache ``rows`` partitioned and sorted by ``key``, so that steps neither shuffle nor sort them.

    The cache is filled here: only then does the planner know how it is partitioned.
    """
    rows = rows.repartition(n, key).sortWithinPartitions(key).persist()
    rows.count()
    return rows


def single_step(edges: DataFrame, damping: float = DAMPING, distinct_edges: bool = False) -> DataFrame:
    """The state after one step, without a graph laid out for more: degrees, one join, one sum."""
    pairs = edge_pairs(edges, distinct_edges)
    nodes = degree_table(pairs).drop("fanout")
    start = nodes.where(F.col("out_degree").isNotNull()).withColumn("rank", F.lit(START_RANK))
    received = _sent(start, pairs).groupBy("dst").agg(F.sum("amount").alias("received"))
    rank = F.lit(1 - damping) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    return nodes.join(received, F.col("node") == F.col("dst"), "left").select(
        "node", "out_degree", rank.alias("rank"))


def initial_state(graph: LinkGraph) -> DataFrame:
    """State 0: every node with links of its own, at the start rank."""
    return graph.nodes.where(F.col("out_degree").isNotNull()).select(
        "node", "out_degree", F.lit(START_RANK).alias("rank"))


def whole_state(graph: LinkGraph) -> DataFrame:
    """Every node at the start rank, also those without links of their own, which pass nothing on."""
    return graph.nodes.select("node", "out_degree", F.lit(START_RANK).alias("rank"))


def pagerank_init(links: DataFrame, distinct_edges: bool = False) -> DataFrame:
    """``node, out_degree, rank`` of all sources of a link table, without building a graph."""
    return start_state(to_edges(links), distinct_edges)


def start_state(edges: DataFrame, distinct_edges: bool = False) -> DataFrame:
    """State 0 of an edge table, by one sum: neither pairs nor targets are needed for it."""
    degree = F.countDistinct("dst") if distinct_edges else F.count(F.lit(1))
    return drop_self_links(edges).groupBy(F.col("src").alias("node")).agg(degree.alias("out_degree")).withColumn(
        "rank", F.lit(START_RANK))


def _sent(state: DataFrame, edges: DataFrame) -> DataFrame:
    share = F.col("rank") / F.col("out_degree")
    return edges.join(state.where(F.col("out_degree").isNotNull()), F.col("src") == F.col("node")).select(
        "dst", (share * F.col("m")).alias("amount"))


def contributions(state: DataFrame, graph: LinkGraph) -> DataFrame:
    """``dst, received``; what one target gets is summed before the shuffle as well as after it."""
    sent = _sent(state, graph.edges)
    if graph.hub_edges is not None:
        hub_ranks = state.join(F.broadcast(graph.hubs), F.col("node") == F.col("src"), "left_semi")
        sent = sent.unionByName(_sent(F.broadcast(hub_ranks), graph.hub_edges))
    return sent.groupBy("dst").agg(F.sum("amount").alias("received"))


def pagerank_step(state: DataFrame, graph: LinkGraph, damping: float = DAMPING) -> DataFrame:
    """The next state; from the first step on it has all sources and targets.

    Nodes, ranks and edges share their partitioning, so the one shuffle is that of contributions.
    """
    received = contributions(state, graph)
    rank = F.lit(1 - damping) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    return graph.nodes.join(received, F.col("node") == F.col("dst"), "left").select(
        "node", "out_degree", rank.alias("rank"))


def measured_step(state: DataFrame, graph: LinkGraph, damping: float = DAMPING) -> DataFrame:
    """The step after a state of all nodes (``whole_state`` at first), with ``delta``, what each rank moved by.

    The old rank is at hand where the new one is made, so no join of two states is needed for it. The
    state is read twice and should be kept.
    """
    received = contributions(state, graph)
    rank = F.lit(1 - damping) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    return state.join(received, F.col("node") == F.col("dst"), "left").select(
        "node", "out_degree", rank.alias("rank"), F.abs(rank - F.col("rank")).alias("delta"))


def rank_delta(prev: DataFrame, cur: DataFrame) -> DataFrame:
    """``node, delta`` between two states; a node missing in one counts with the start rank there."""
    before = prev.select("node", F.col("rank").alias("before"))
    after = cur.select("node", F.col("rank").alias("after"))
    delta = F.abs(F.coalesce("before", F.lit(START_RANK)) - F.coalesce("after", F.lit(START_RANK)))
    return before.join(after, "node", "full_outer").select("node", delta.alias("delta"))


def max_delta(deltas: DataFrame) -> DataFrame:
    """One row ``max_delta``, NULL for no input."""
    return deltas.agg(F.max("delta").alias("max_delta"))


def has_converged(prev: DataFrame, cur: DataFrame, tol: float) -> bool:
    """Whether no rank moved by more than ``tol``; one number reaches the driver."""
    moved = max_delta(rank_delta(prev, cur)).first()["max_delta"]
    return (moved if moved is not None else 0.0) <= tol


def pagerank_finish(state: DataFrame, limit: int | None = None) -> DataFrame:
    """``node, rank`` from the highest rank down, equal ranks by name."""
    ordered = state.select("node", "rank").orderBy(F.desc("rank"), "node")
    return ordered if limit is None else ordered.limit(limit)
