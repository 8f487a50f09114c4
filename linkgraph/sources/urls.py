"""URL lists: start URLs, batches of one URL per line, and files still to be copied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def split_seeds(lists: DataFrame, column: str = "seeds") -> DataFrame:
    """Comma-separated URLs, one row per URL."""
    return lists.select(F.explode(F.split(column, ",")).alias("url"))


def seeds(spark: SparkSession, text: str) -> DataFrame:
    """The start URLs of a crawl from one comma-separated text."""
    return split_seeds(spark.createDataFrame([(text,)], "seeds string"))


def trimmed_urls(lines: DataFrame, column: str | Column = "value") -> DataFrame:
    column = F.col(column) if isinstance(column, str) else column
    return lines.select(F.trim(column).alias("url"))


def distinct_urls(lines: DataFrame, column: str | Column = "value") -> DataFrame:
    """Trimmed URLs, each once."""
    return trimmed_urls(lines, column).dropDuplicates(["url"])


def read_url_batch(spark: SparkSession, path: str) -> DataFrame:
    return distinct_urls(spark.read.text(path))


def stream_url_batches(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New URL files of a folder as a stream; repeats are left to ``stream_admit``."""
    return trimmed_urls(
        spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path))


def files_to_copy(local: DataFrame, dest: DataFrame, now_ms: int,
                  settle_ms: int = 60_000) -> DataFrame:
    """Plain files that have settled for ``settle_ms`` and whose key is not at the destination."""
    settled = ~F.col("is_dir") & (F.lit(now_ms) - F.col("modified_ms") >= settle_ms)
    return local.where(settled).join(dest.select("key"), "key", "left_anti")


def read_settled(spark: SparkSession, path: str, modified_before: str, format: str = "text") -> DataFrame:
    """Read the files of a folder last modified before a UTC time such as ``2024-05-01T12:00:00``."""
    return spark.read.format(format).option("modifiedBefore", modified_before).load(path)


def append_seen(new: DataFrame, table: str, buckets: int) -> None:
    """Add URLs to a seen table bucketed by URL.

    With as many buckets as shuffle partitions, admission joins the table without shuffling it.
    """
    (new.select("url").repartition(buckets, "url")
     .write.mode("append").bucketBy(buckets, "url").sortBy("url").saveAsTable(table))
