"""Documents to a training mix: language, near copies, benchmark passages, personal data, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkgraph.llm import decontaminate, language, mixing, ngram_join, pii
from linkgraph.session import drop_path, scratch_path, written


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language (no text, or no letter in it); fill in missing languages."""
    model = language.fit_language(docs)
    found = language.predict_language(docs, model, out_col="__found").where(
        F.col("__found.lang") != language.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "__found.lang")).drop("__found")


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return ngram_join.first_of_components(docs, size=5, num=8, den=10)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item: four fifths of its five-word shingles or more."""
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of times."""
    return mixing.take_mix(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_copies", keep_first_copies),
    ("benchmark", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("mix", mix_sources),
]

# Fitted languages, hashed signatures and hashed sampling have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; every stage is written to the shared folder and read again.

    What a stage has read is deleted once the next table is there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        docs = written(stage(spark, docs, sf_dir), path)
        if last is not None:
            drop_path(spark, last)
        last = path
    return docs
