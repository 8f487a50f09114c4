"""One query for each operator over its whole table, with production settings, and the SQL twins there are."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkgraph.llm import (
    ball_search, decontaminate, embeddings, language, licences, lm_score, mixing, ngram_join, periodic_runs, pii, quality,
    token_files, toxicity)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """The remainder that deals documents into folds."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_language(docs.where((fold(5) != 0) & F.col("lang").isNotNull()))
    return language.predict_language(docs, model, out_col="found").select(
        "doc_id", (fold(5) == 0).alias("held_out"), F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_components(table(spark, sf_dir, "documents"), size=3, num=90, den=100)
    return found.withColumnRenamed("id", "doc_id")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sources(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit_quality(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    return quality.score_quality(docs, model, out_col="found").select(
        "doc_id", (fold(5) == 0).alias("held_out"), F.col("found.text").alias("text_score"),
        F.col("found.page").alias("page_score"), F.col("found.score").alias("score"),
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"))


def op6_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_components(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licences.corpus_files(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))
    return licences.scan_licences(files).select(
        F.col("file.kind").alias("kind"), F.col("file.id").alias("id"), "path", "licence", "cosine", "origin")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit_toxicity(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    return toxicity.score_toxicity(docs, model, out_col="score").select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm_score.fit_lm(docs.where(fold(7) != 2))
    return lm_score.score_lm(docs.withColumn("held_out", fold(7) == 2), model)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_search.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def planted_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, one in ten made periodic from a place on, as its id tells."""
    h = 0 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    again = words[start:start + period]
    return words[:start] + (again * ((n - start) // period + 1))[:n - start]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.with_runs(docs, words_of=planted_period, given=F.col("doc_id").cast("bigint"), with_text=False)
    best = F.col("found.strongest")
    return found.select(
        "doc_id", F.size("found.runs").cast("bigint").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("found.strongest.length * 1000 div found.strongest.period").alias("exponent_milli"),
        F.col("found.runs_sha256").alias("runs_sha256"), F.col("found.collapsed_sha256").alias("collapsed_sha256"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_ngram_join": op2_ngram_join,
    "op3_personal_data": op3_personal_data,
    "op4_source_mix": op4_source_mix,
    "op5_quality": op5_quality,
    "op6_embedding_duplicates": op6_embedding_duplicates,
    "op7_decontamination": op7_decontamination,
    "op8_licences": op8_licences,
    "op9_toxicity": op9_toxicity,
    "op10_lm_score": op10_lm_score,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_files": op13_token_files,
}

def _shingles_sql(table_name: str, key: str) -> str:
    """Distinct five-word shingles of a table's texts as rows (key, s)."""
    return f"""
        SELECT DISTINCT {key}, unnest(CASE
            WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
        FROM (SELECT {key}, list_filter(string_split_regex(lower(text), '[ \\x09-\\x0D]+'), lambda x: x <> '') AS w
              FROM {table_name})"""


def _terms_sql(table_name: str, key: str) -> str:
    """The terms of a table's texts as rows (key, t), repeats included."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
        SELECT {key}, unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'),
                                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
        FROM {table_name}"""


ORACLE_SQL: dict[str, str] = {
    "op11_ranked_search": f"""
        WITH d AS MATERIALIZED (SELECT doc_id, t, count(*) AS tf FROM ({_terms_sql("documents", "doc_id")}) GROUP BY ALL),
        i AS (SELECT DISTINCT item_id, t FROM ({_terms_sql("benchmark", "item_id")})),
        c AS (SELECT count(DISTINCT doc_id) AS docs, CAST(sum(tf) AS BIGINT) AS terms FROM d),
        n AS (SELECT doc_id, 10 + (90 * CAST(sum(tf) AS BIGINT) * any_value(docs)) // any_value(terms) AS m
              FROM d, c GROUP BY doc_id),
        w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM d, c GROUP BY t),
        s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
              FROM i JOIN d USING (t) JOIN w USING (t) JOIN n USING (doc_id) GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10""",
    "op7_decontamination": f"""
        WITH d AS ({_shingles_sql("documents", "doc_id")}), b AS ({_shingles_sql("benchmark", "item_id")}),
        n AS (SELECT item_id, count(*) AS n_item_shingles FROM b GROUP BY item_id),
        f AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_item_shingles, n_shared,
               CAST(n_shared AS DOUBLE) / n_item_shingles AS containment
        FROM f JOIN n USING (item_id) WHERE n_shared * 10 >= n_item_shingles * 8""",
}
