"""Tables as folders of Parquet files that are never changed, with a manifest of those that are live.

A change writes the folders of a new version and then a manifest that names all live folders; it is visible
once that manifest is complete. A change that was cut off leaves nothing that is read, and is tried again under
the same number. A table that belongs to others takes its version from them, so that all change at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from linkgraph.operators.skew import balanced_by
from linkgraph.session import drop_path

PART = "part__"


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the ``version=N`` folders whose writer has finished."""
    numbers = [int(name.split("=")[1]) for name in names_in(spark, path) if name.startswith("version=")]
    return sorted(n for n in numbers if "_SUCCESS" in names_in(spark, f"{path}/version={n}"))


def _fields(columns: str) -> list:
    return StructType.fromDDL(columns).fields


class LiveFolders:
    """The folders of one table. ``part_type`` is the type of what rows are dealt by."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part_type: str = "bigint"):
        self.spark, self.path, self.schema, self.part_type = spark, path.rstrip("/"), schema, part_type
        self.entry_schema = f"kind string, version bigint, part {part_type}, last {part_type}, n bigint"

    def latest(self) -> int:
        """The number of the last complete version; 0 for a new table."""
        return max(complete_versions(self.spark, f"{self.path}/manifest"), default=0)

    def live(self, version: int) -> DataFrame:
        """``kind, version, part, last, n`` of the folders that are live in a version.

        A folder holds the parts from ``part`` to ``last``, one part as a rule.
        """
        if not version:
            return self.spark.createDataFrame([], self.entry_schema)
        return self.spark.read.schema(self.entry_schema).parquet(f"{self.path}/manifest/version={version}").withColumn(
            "last", F.coalesce("last", "part"))

    def write(self, rows: DataFrame, version: int, part: Column, kind: str = "rows",
              lows: list | None = None) -> DataFrame:
        """Write rows into folders by ``part``, large parts spread over files; the entries of these folders.

        With ``lows`` (parts in order, the first of them the least) a folder holds the parts from one to the next.
        """
        folder = f"{self.path}/{kind}/version={version}"
        part = part.cast(self.part_type)
        name = part
        if lows is not None:
            bounds = F.array(*[F.lit(low).cast(self.part_type) for low in lows])
            name = F.try_element_at(F.filter(bounds, lambda low: low <= part), F.lit(-1))
        (balanced_by(rows.select(*self.schema.names, name.alias(PART)), PART)
         .write.mode("overwrite").partitionBy(PART).parquet(folder))
        schema = StructType([*self.schema.fields, *_fields(f"{PART} {self.part_type}")])
        last = F.col(PART) if lows is None else part
        return (self.spark.read.schema(schema).parquet(folder).groupBy(F.col(PART).alias("part"))
                .agg(F.max(last).alias("last"), F.count(F.lit(1)).alias("n"))
                .select(F.lit(kind).alias("kind"), F.lit(version).cast("bigint").alias("version"), "part", "last", "n"))

    def read(self, entries: list[Row]) -> DataFrame:
        """The rows of some folders; no other folder is looked at."""
        paths = [f"{self.path}/{e['kind']}/version={e['version']}/{PART}={e['part']}" for e in entries]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def commit(self, version: int, live: DataFrame) -> None:
        """Make ``live`` the folders of a version."""
        live.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")

    def forget(self, before: int) -> None:
        """Delete manifests older than a version, and the folders that no manifest from it on names."""
        versions = complete_versions(self.spark, f"{self.path}/manifest")
        for version in versions:
            if version < before:
                drop_path(self.spark, f"{self.path}/manifest/version={version}")
        kept = [version for version in versions if version >= before]
        if not kept:
            return
        named = {(row["kind"], row["version"]) for version in kept
                 for row in self.live(version).select("kind", "version").distinct().collect()}
        for kind in names_in(self.spark, self.path):
            if kind != "manifest":
                for version in complete_versions(self.spark, f"{self.path}/{kind}"):
                    if version < before and (kind, version) not in named:
                        drop_path(self.spark, f"{self.path}/{kind}/version={version}")
