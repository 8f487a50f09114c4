"""Documents: ``url<TAB>body`` records that end in a marker, as a body may hold newlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_documents(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """Records up to ``marker`` to ``url, body``.

    Files with a custom record end are still split, so one large file is read by many tasks.
    """
    fields = F.split("value", "\t", 2)
    return (
        spark.read.option("lineSep", marker).text(path)
        .where(F.col("value").contains("\t"))
        .select(F.get(fields, F.lit(0)).alias("url"), F.get(fields, F.lit(1)).alias("body")))


def write_documents(documents: DataFrame, path: str, marker: str, mode: str = "error") -> None:
    """Write records; a NULL body is written as an empty one, rows without a URL are left out."""
    record = F.concat("url", F.lit("\t"), F.coalesce("body", F.lit("")))
    (documents.where(F.col("url").isNotNull()).select(record.alias("value"))
     .write.mode(mode).option("lineSep", marker).text(path))
