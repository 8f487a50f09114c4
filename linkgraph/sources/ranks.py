"""Rank states and final ranks on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def parse_rank_state(lines: DataFrame) -> DataFrame:
    """Lines ``url<TAB>name size rank links`` to ``node, out_degree, rank``.

    A size that is no number (a node known only as a target) becomes NULL.
    """
    fields = F.split("value", "\t")
    state = F.split(F.get(fields, F.lit(1)), " ")
    return (
        lines.where(F.col("value").contains("\t"))
        .select(F.get(fields, F.lit(0)).alias("node"),
                F.get(state, F.lit(1)).try_cast("bigint").alias("out_degree"),
                F.get(state, F.lit(2)).try_cast("double").alias("rank")))


def read_rank_state(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A rank state from Parquet, or imported from its text form (``format="text"``)."""
    if format == "text":
        return parse_rank_state(spark.read.text(path))
    return spark.read.format(format).load(path).select("node", "out_degree", "rank")


def read_rank_states(spark: SparkSession, *paths: str, format: str = "parquet") -> DataFrame:
    """All rows of several states, as one table."""
    states = [read_rank_state(spark, path, format) for path in paths]
    result = states[0]
    for state in states[1:]:
        result = result.unionByName(state)
    return result


def write_rank_state(state: DataFrame, path: str, mode: str = "error") -> None:
    state.select("node", "out_degree", "rank").write.mode(mode).parquet(path)


def write_ranks(ranks: DataFrame, path: str, format: str = "parquet", mode: str = "error") -> None:
    """Write ``node, rank``, as Parquet or as tab-separated text (``format="csv"``)."""
    writer = ranks.select("node", "rank").write.mode(mode).format(format)
    if format == "csv":
        writer = writer.option("sep", "\t")
    writer.save(path)
