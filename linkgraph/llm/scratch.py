"""Tables that an operator needs only while it works."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkgraph.session import drop_path, scratch_path, written


class Scratch:
    """Writes tables to the shared folder and deletes them when the operator no longer reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        return written(df, path)

    def drop(self) -> None:
        while self.paths:
            drop_path(self.spark, self.paths.pop())
