"""Link lists: ``url<TAB>[a, b, c]`` text lines and their Parquet form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkgraph.functions.text import format_list, parse_list


def parse_links(lines: DataFrame) -> DataFrame:
    """Text lines (``value``) to ``source, targets``; malformed lines and empty lists are skipped.

    A comma inside a URL ends it here, as the text form has no quoting; Parquet has no such limit.
    """
    fields = F.split("value", "\t")
    return (
        lines.where(F.col("value").contains("\t"))
        .select(F.get(fields, F.lit(0)).alias("source"),
                parse_list(F.get(fields, F.lit(1))).alias("targets"))
        .where(F.size("targets") > 0))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return parse_links(spark.read.text(path))


def link_lines(links: DataFrame) -> DataFrame:
    targets = F.coalesce("targets", F.array().cast("array<string>"))
    return links.where(F.col("source").isNotNull()).select(
        F.concat("source", F.lit("\t"), format_list(targets)).alias("value"))


def write_links(links: DataFrame, path: str, format: str = "parquet", mode: str = "error") -> None:
    """Write a link table, as Parquet or (``format="text"``) as one line per source."""
    if format == "text":
        link_lines(links).write.mode(mode).text(path)
    else:
        links.select("source", "targets").write.mode(mode).format(format).save(path)
