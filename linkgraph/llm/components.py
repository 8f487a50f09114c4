"""Connected components of links in a table, by alternating star operations.

Every round replaces links by links to the smallest neighbour: first for the larger neighbours of a node, then
for the smaller ones (Kiveris et al., Connected Components in MapReduce and Beyond, 2014). The links become
stars whose centre is the smallest node. Rounds are cut by tables in the shared folder, so a lost executor
costs a part of one round. Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkgraph.session import drop_path, scratch_path, written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, left: str = "a", right: str = "b", rounds: int = 200) -> DataFrame:
    """``node``, ``root`` for every node with a link to another; ``root`` is the smallest node it reaches.

    ``links`` has pairs of numbers, in any order and with repeats; pairs with a null and links to oneself are
    ignored. No links give no rows.
    """
    spark = links.sparkSession
    pair = links.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"),
                        (F.col(left).isNotNull() & F.col(right).isNotNull()).alias("known"))
    path = scratch_path(spark, "links")
    current = written(pair.where("known and a <> b").select("a", "b").distinct(), path)
    mark = _mark(current)
    for _ in range(rounds):
        if not mark[0]:
            break
        next_path = scratch_path(spark, "links")
        following = written(_small_star(_large_star(current)), next_path)
        next_mark = _mark(following)
        drop_path(spark, path)
        path, current = next_path, following
        if next_mark == mark:
            break
        mark = next_mark
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(centres)
