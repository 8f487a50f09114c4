"""A ranking whose graph and states stay on disk, so that a run that ended goes on where it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkgraph.operators.edges import edge_pairs
from linkgraph.operators.ranking import (
    DAMPING, LinkGraph, degree_table, hub_limit, initial_state, measured_step, whole_state)
from linkgraph.session import drop_path, written
from linkgraph.stored.bucketed import read_bucketed, write_bucketed
from linkgraph.stored.live import complete_versions, names_in

NODES = "node string, out_degree bigint, fanout bigint"
EDGES = "src string, dst string, m bigint"
LAYOUT = "buckets int, has_hubs boolean"
STATE = "node string, out_degree bigint, rank double, delta double"


class StoredRanking:
    """Pairs, degrees and states under ``path``, all in buckets of the node.

    The graph is laid out once; a step joins it with the last state bucket by bucket and shuffles only
    contributions. Sources with a large share of all edges are kept apart, as in ``link_graph``. A state
    counts once its mark is written, after its rows, so a step that was cut off is done again.
    """

    def __init__(self, spark: SparkSession, path: str, damping: float = DAMPING):
        self.spark, self.path, self.damping = spark, path.rstrip("/"), damping

    def begin(self, edges: DataFrame, distinct_edges: bool = False, hub_share: float | None = None) -> bool:
        """Lay out ``edges`` (``src, dst``) in as many buckets as shuffle partitions; False if that is done already."""
        if self._begun():
            return False
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        pairs = written(edge_pairs(edges, distinct_edges), f"{self.path}/pairs")
        total = pairs.count()
        write_bucketed(degree_table(pairs).repartition(n, "node"), f"{self.path}/nodes", "node", n)
        nodes = read_bucketed(self.spark, f"{self.path}/nodes", NODES, "node", n)
        hubs = written(nodes.where(F.col("fanout") > hub_limit(total, n, hub_share)).select(F.col("node").alias("src")),
                       f"{self.path}/hubs")
        few = F.broadcast(hubs)  # 1000 rows or one a partition, as the limit has it
        write_bucketed(pairs.join(few, "src", "left_anti").repartition(n, "src"), f"{self.path}/edges", "src", n)
        pairs.join(few, "src", "left_semi").repartition(n).write.mode("overwrite").parquet(f"{self.path}/hub_edges")
        drop_path(self.spark, f"{self.path}/pairs")
        layout = self.spark.createDataFrame([(n, not hubs.isEmpty())], LAYOUT)
        layout.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/layout")
        return True

    def _begun(self) -> bool:
        return "_SUCCESS" in names_in(self.spark, f"{self.path}/layout")

    def _layout(self):
        return self.spark.read.schema(LAYOUT).parquet(f"{self.path}/layout").first()

    def graph(self) -> LinkGraph:
        layout = self._layout()
        n, hub_edges, hubs = layout["buckets"], None, None
        if layout["has_hubs"]:
            hub_edges = self.spark.read.schema(EDGES).parquet(f"{self.path}/hub_edges")
            hubs = self.spark.read.schema("src string").parquet(f"{self.path}/hubs")
        return LinkGraph(read_bucketed(self.spark, f"{self.path}/nodes", NODES, "node", n),
                         read_bucketed(self.spark, f"{self.path}/edges", EDGES, "src", n), hub_edges, hubs, self.path)

    def steps(self) -> int:
        """The number of whole steps."""
        return max(complete_versions(self.spark, f"{self.path}/mark"), default=0)

    def _stored(self, step: int) -> DataFrame:
        return read_bucketed(self.spark, f"{self.path}/state/version={step}", STATE, "node", self._layout()["buckets"])

    def state(self, step: int | None = None) -> DataFrame:
        """``node, out_degree, rank`` after a step (the last one), as ``rank_edges`` gives it."""
        step = self.steps() if step is None else step
        return initial_state(self.graph()) if step == 0 else self._stored(step).drop("delta")

    def moved(self, step: int | None = None) -> float | None:
        """The most that a rank moved by in a step (the last one); None before the first."""
        step = self.steps() if step is None else step
        return None if step == 0 else self.spark.read.schema("moved double").parquet(
            f"{self.path}/mark/version={step}").first()["moved"]

    def step(self) -> float:
        """Do the next step and keep its state; the most that a rank moved by."""
        done, graph = self.steps(), self.graph()
        before = whole_state(graph) if done == 0 else self._stored(done).drop("delta")
        write_bucketed(measured_step(before, graph, self.damping), f"{self.path}/state/version={done + 1}", "node",
                       self._layout()["buckets"])
        moved = self._stored(done + 1).agg(F.coalesce(F.max("delta"), F.lit(0.0)).alias("moved"))
        moved.write.mode("overwrite").parquet(f"{self.path}/mark/version={done + 1}")
        return self.moved(done + 1)

    def run(self, max_iter: int, tol: float | None = None) -> DataFrame:
        """The state after ``max_iter`` steps in all, or fewer once no rank moves by more than ``tol``."""
        moved = self.moved()
        while self.steps() < max_iter and not (tol is not None and moved is not None and moved <= tol):
            moved = self.step()
        return self.state()

    def forget(self, before: int | None = None) -> None:
        """Delete the states before a step (the last one)."""
        before = self.steps() if before is None else before
        for version in complete_versions(self.spark, f"{self.path}/state"):
            if version < before:
                drop_path(self.spark, f"{self.path}/state/version={version}")
