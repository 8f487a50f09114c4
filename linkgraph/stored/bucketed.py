"""Tables as folders of files dealt and named by bucket, so that joins by their key need no shuffle.

The files say which bucket they hold; a session that did not write them is told their key and number of
buckets by a table definition, which is dropped once the table is resolved. The files stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from linkgraph.session import drop_path


def _name() -> str:
    return f"linkgraph_{uuid.uuid4().hex}"


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write rows in buckets of ``key``; what a try that was cut off left there is replaced."""
    spark, name = rows.sparkSession, _name()
    drop_path(spark, path)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """A table written by ``write_bucketed``; ``columns`` is its definition."""
    name = _name()
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
