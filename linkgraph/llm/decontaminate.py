"""Benchmark items inside documents: size-partitioned MinHash search, verified by exact shingle containment.

A document is much larger than an item, so the Jaccard similarity of their sketches says nothing. The search
therefore goes by containment. An item of n shingles that a document contains to a share c misses at most (1 - c) n
of them, so of its (1 - c) n + t smallest hashes the document has t or more: this is exact at any size of item and
document, with a sketch as long as the item needs. Items are partitioned by the size of their shingle set; a
partition's threshold is the largest hash of its sketches, and only a document's hashes up to the highest threshold
take part. Candidates are then counted on the shingles themselves.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from linkgraph.session import scratch_path, written

SHINGLE = 5
NEEDED = 4  # hashes of a sketch that a document must have, if the item has so many to spare
BROADCAST_ROWS = 1_000_000  # rows of two numbers, or ids, that may be broadcast; more are joined by a shuffle


def words_of(text: Column) -> Column:
    """The lower-cased words of a whole text."""
    return F.array_remove(F.split(F.translate(F.lower(text), "\t\n\x0b\x0c\r", "     "), " ", -1), "")


def _runs(words: str, size: int, make) -> Column:
    """``make`` of every run of ``size`` words of the column ``words``, or of all its words if they are fewer."""
    n = F.size(words)
    every = F.transform(F.sequence(F.lit(0), n - size), lambda i: make([F.get(words, i + k) for k in range(size)]))
    return F.when(n >= size, every).when(n > 0, F.array(make([F.col(words)]))).otherwise(
        F.slice(F.array(make([F.col(words)])), 1, 0))


def shingle_hashes(words: str, size: int = SHINGLE) -> Column:
    return _runs(words, size, lambda run: F.xxhash64(*run))


def shingle_texts(words: str, size: int = SHINGLE) -> Column:
    return F.array_distinct(_runs(words, size, lambda run: F.concat_ws(" ", *run)))


def small(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for a broadcast if it has few rows; counted before it is."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def item_sketches(items: DataFrame, share_num: int, share_den: int, needed: int = NEEDED) -> DataFrame:
    """``item``, ``partition``, ``hash``, ``needed``: a row for each hash of an item's sketch.

    ``items`` has ``item`` and ``words``. A document that contains the item has ``needed`` of these hashes or more.
    """
    hashes = items.select("item", F.explode(shingle_hashes("words")).alias("hash")).distinct()
    sized = hashes.groupBy("item").agg(F.sort_array(F.collect_list("hash")).alias("hashes"), F.count("*").alias("n"))
    misses = F.expr(f"int(n * {share_den - share_num} div {share_den})")
    parted = sized.select("item", "hashes", misses.alias("misses"), F.floor(F.log2("n")).alias("partition"),
                          F.least(F.lit(needed), F.col("n") - misses).cast("int").alias("needed"))
    return parted.select("item", "partition", "needed",
                         F.explode(F.slice("hashes", F.lit(1), F.col("misses") + F.col("needed"))).alias("hash"))


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", share_num: int = 8,
                    share_den: int = 10) -> DataFrame:
    """``id``, ``item``, ``n_item_shingles``, ``n_shared``, ``containment``: items that documents contain.

    An item counts where a document has at least share_num / share_den of its distinct five-word shingles. A
    text of fewer words is one shingle, one without words none; nulls are empty. Rows that share an id are one
    document, rows that share an item id one item; null ids count as an id. Empty tables give no rows. Items
    and their sketches are broadcast only while they are few.
    """
    spark = docs.sparkSession
    doc_words = docs.select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words"))
    items = benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("words"))
    sketches = written(item_sketches(items, share_num, share_den), scratch_path(spark, "sketches"))
    thresholds = sketches.groupBy("partition").agg(F.max("hash").alias("threshold")).collect()  # 64 rows at most
    loosest = max([row["threshold"] for row in thresholds], default=None)
    hashes = doc_words.select("id", F.explode(shingle_hashes("words")).alias("hash"))
    if loosest is not None:
        hashes = hashes.where(F.col("hash") <= loosest)
    hits = hashes.join(small(sketches.select("item", "hash", "needed")), "hash")
    candidates = written(
        hits.groupBy("id", "item", "hash").agg(F.first("needed").alias("needed"))
        .groupBy("id", "item").agg(F.count("*").alias("found"), F.first("needed").alias("needed"))
        .where("found >= needed").select("id", "item"), scratch_path(spark, "candidates"))

    of_items = written(items.select("item", F.explode(shingle_texts("words")).alias("shingle")).distinct(),
                       scratch_path(spark, "item-shingles"))
    sizes = of_items.groupBy("item").agg(F.count("*").alias("n_item_shingles"))
    wanted = small(candidates.select(F.col("id").alias("wanted")).distinct())
    suspects = doc_words.join(wanted, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
    shared = (suspects.select("id", F.explode(shingle_texts("words")).alias("shingle"))
              .join(small(of_items), "shingle").groupBy("id", "item", "shingle").count()
              .groupBy("id", "item").agg(F.count("*").alias("n_shared")))
    found = shared.alias("s").join(small(sizes).alias("n"), F.expr("s.item <=> n.item")).select(
        "s.id", "s.item", "n_item_shingles", "n_shared",
        (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"))
    exact = found.where(F.col("n_shared") * share_den >= F.col("n_item_shingles") * share_num)
    return exact.alias("e").join(candidates.alias("c"), F.expr("e.id <=> c.id AND e.item <=> c.item"), "left_semi")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """``docs`` without those that contain an item of ``benchmark``."""
    found = small(contained_items(docs, benchmark, id_col, **settings).select(F.col("id").alias("__id")).distinct())
    return docs.join(found, F.col(id_col).eqNullSafe(F.col("__id")), "left_anti")
