"""Mix sources to target weights by Pareto order sampling of whole documents.

Every document has an expected number of copies. Its whole part is certain; the fraction is an inclusion
probability. Documents are ranked by the odds of a fixed random number divided by the odds of their inclusion
(Rosén, 1997), and the first ones are taken until the words still missing from their source are filled. The
random numbers are hashes of the id, so reruns agree.

No window runs over a source: ranks are cut into bins, words are summed by bin before any shuffle, and only the
bin in which a source's words run out is ordered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from linkgraph.session import scratch_path, written

ROWS_PER_BIN = 5_000
MAX_COPIES = 3


def word_count(text: Column) -> Column:
    """Number of words of a whole text; 0 for null and empty texts."""
    apart = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.array_remove(F.split(apart, " ", -1), "")), F.lit(0)).cast("bigint")


def cyclic_weights(sources: DataFrame, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Weights that repeat over the sources in order of code points, null last: one row per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.select("source", F.element_at(
        F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")).alias("weight"))


def source_targets(sizes: DataFrame, max_copies: float = MAX_COPIES) -> DataFrame:
    """``source``, ``source_size``, ``target``: words each source should give, in sum as many as there are.

    ``sizes`` has ``source``, ``source_size``, ``weight``, one row per source. No target is above
    ``max_copies`` times its source; what a weight asks beyond that is shared again by weight. Every round
    fixes all targets at their limit, so a few rounds of sums over the sources suffice; only the sums reach the
    driver.
    """
    limit = F.col("source_size") * float(max_copies)
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, open_count = None, None
    while True:
        at_limit = F.lit(False) if level is None else F.col("weight") * level >= limit
        row = sizes.agg(F.sum(F.when(at_limit, limit)), F.sum(F.when(~at_limit, F.col("weight"))),
                        F.count(F.when(~at_limit, True))).first()
        if not row[1] or row[2] == open_count:
            break
        level, open_count = (total - (row[0] or 0.0)) / row[1], row[2]
    asked = F.col("weight") * (level or 0.0)
    return sizes.select("source", "source_size", F.least(asked, limit).cast("double").alias("target"))


def few(df: DataFrame, bound: int = 100_000) -> bool:
    """Whether a table has at most ``bound`` rows, so that it may be broadcast."""
    return df.limit(bound + 1).count() <= bound


def with_sources(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """Add what is known of each row's source, null being a source too; broadcast where the sources are few."""
    right = by_source.withColumnRenamed("source", "source_of")
    right = F.broadcast(right) if few(by_source) else right
    return rows.join(right, F.col("source").eqNullSafe(F.col("source_of")), "left").drop("source_of")


def longer_preferred(size: Column) -> Column:
    """1 for the shortest texts, a tenth more for every doubling, at most 3."""
    return F.least(F.lit(3.0), 1.0 + F.floor(F.log2(size + 1.0)) * 0.1)


def source_rates(docs: DataFrame, targets: DataFrame, max_copies: float = MAX_COPIES) -> DataFrame:
    """``source``, ``target``, ``factor``: a document's expected copies are its preference times the factor, at
    most ``max_copies``, and a source's expected words are its target.

    ``docs`` has ``source``, ``size``, ``preference`` with few different preferences.
    """
    levels = docs.groupBy("source", "preference").agg(F.sum("size").alias("words")).where("words > 0")
    order = Window.partitionBy("source").orderBy(F.desc("preference"))
    above = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("words") * F.col("preference")).over(
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # the factor that fills the target if exactly the levels above are at the limit
    solved = with_sources(levels.withColumns({"above": above, "below": below}), targets).withColumn(
        "factor", (F.col("target") - F.col("above") * max_copies) / F.col("below"))
    fits = F.col("factor") * F.col("preference") <= max_copies
    return solved.groupBy("source").agg(
        F.first("target").alias("target"),
        F.coalesce(F.max(F.when(fits, F.col("factor"))), F.lit(float("inf"))).alias("factor"))


def _ranked(docs: DataFrame, rates: DataFrame, seed: int, max_copies: float) -> DataFrame:
    """Certain copies and, where a fraction is left, the Pareto rank as a number between 0 and 1."""
    uniform = (F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    rate = F.least(F.lit(float(max_copies)), F.col("factor") * F.col("preference"))
    odds = (F.col("uniform") / (1 - F.col("uniform"))) / (F.col("part") / (1 - F.col("part")))
    return (with_sources(docs, rates)
            .withColumns({"rate": F.when(F.col("size") > 0, rate).otherwise(0.0), "uniform": uniform})
            .withColumn("copies", F.floor("rate").cast("bigint"))
            .withColumn("part", F.col("rate") - F.col("copies"))
            .withColumn("place", F.when(F.col("part") > 1e-12, odds / (1 + odds)))
            .drop("uniform", "part", "rate", "factor", "preference"))


def pareto_mix(docs: DataFrame, targets: DataFrame, seed: int = 42, max_copies: float = MAX_COPIES,
               rows_per_bin: int = ROWS_PER_BIN) -> DataFrame:
    """``docs`` (``id``, ``source``, ``size``, ``preference``) with ``copies``, the times a document is taken.

    ``targets`` has ``source`` and ``target`` in units of ``size``. The result has the rows of ``docs``;
    documents without size are not taken. Rows that agree in id, source and size are taken alike. The sampled
    words of a source stop at its target; one closing document, the one that fits the gap best, may follow.
    """
    narrow = docs.select("id", "source", "size", "preference")
    ranked = _ranked(narrow, source_rates(narrow, targets, max_copies), seed, max_copies)
    per_source = ranked.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing"),
        F.ceil(F.count("place") / rows_per_bin).alias("bins"))
    binned = with_sources(ranked, per_source).withColumn(
        "bin", F.when(F.col("place").isNotNull(), F.least(F.floor(F.col("place") * F.col("bins")), F.col("bins") - 1)))
    order = Window.partitionBy("source").orderBy("bin")
    upto = (binned.where("bin IS NOT NULL").groupBy("source", "bin")
            .agg(F.sum("size").alias("words"), F.first("missing").alias("missing"))
            .withColumn("upto", F.sum("words").over(order)))
    edge = upto.where("upto >= missing").groupBy("source").agg(
        F.min("bin").alias("edge"), F.min_by(F.col("missing") - F.col("upto") + F.col("words"), "bin").alias("room"))
    known = per_source.select("source").join(
        edge.withColumnRenamed("source", "edge_source"),
        F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    placed = with_sources(binned, known)

    at_edge = placed.where("bin = edge")
    units = at_edge.groupBy("source", "id", "size", "place").agg(
        F.sum("size").alias("words"), F.first("room").alias("room"))
    row = Window.partitionBy("source").orderBy("place", "id", "size")
    filled = units.withColumn("upto", F.sum("words").over(row))
    inside = filled.withColumn("taken", F.col("upto") <= F.col("room"))
    gap = F.col("room") - F.coalesce(
        F.sum(F.when(F.col("taken"), F.col("words"))).over(Window.partitionBy("source")), F.lit(0))
    fits = F.when(~F.col("taken"), F.abs(F.col("words") - F.col("gap")))
    closing = Window.partitionBy("source").orderBy(F.col("misfit").asc_nulls_last(), "place", "id", "size")
    chosen = (inside.withColumn("gap", gap).withColumn("misfit", fits)
              .withColumn("first", F.row_number().over(closing))
              .where("taken OR (first = 1 AND misfit < gap)")
              .select(F.col("source").alias("s"), F.col("id").alias("i"), F.col("size").alias("z"),
                      F.lit(1).alias("extra")))
    same = (F.col("source").eqNullSafe(F.col("s")) & F.col("id").eqNullSafe(F.col("i"))
            & (F.col("size") == F.col("z")))
    settled = at_edge.join(chosen, same, "left").select(
        "id", "source", "size", "target", (F.col("copies") + F.coalesce("extra", F.lit(0))).alias("copies"))
    before = F.col("bin").isNotNull() & (F.col("edge").isNull() | (F.col("bin") < F.col("edge")))
    rest = placed.where("NOT coalesce(bin = edge, false)").select(
        "id", "source", "size", "target", (F.col("copies") + before.cast("bigint")).alias("copies"))
    return settled.unionByName(rest)


def mixed_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  cycle: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 42) -> DataFrame:
    """``id``, ``source``, ``size`` (words), ``source_size``, ``target``, ``copies`` for every row of ``docs``.

    Targets share all words of the table by weights that repeat over the sources. Null texts have size 0; null
    is a source of its own. An empty table gives no rows. Texts are read once; what is left is a narrow table
    in the shared folder.
    """
    size = word_count(F.col(text_col))
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")),
                    scratch_path(docs.sparkSession, "sizes"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = written(totals, scratch_path(docs.sparkSession, "totals"))
    weighted = with_sources(totals, cyclic_weights(totals, cycle))
    targets = source_targets(weighted, MAX_COPIES)
    targets = written(targets, scratch_path(docs.sparkSession, "targets"))
    taken = pareto_mix(sized.withColumn("preference", longer_preferred(F.col("size"))),
                       targets.select("source", "target"), seed)
    return with_sources(taken.drop("target"), targets).select(
        "id", "source", "size", "source_size", "target", "copies")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             copies_col: str = "copies", **settings) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with the number of times in ``copies_col``.

    A column of that name is replaced. Copies are found by id, source and size, so the texts are joined with a
    narrow table of the rows taken.
    """
    taken = mixed_sources(docs, id_col, text_col, source_col, **settings).where("copies > 0").select(
        F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"),
        F.col("copies").alias("__copies")).distinct()
    same = (F.col(id_col).eqNullSafe(F.col("__id")) & F.col(source_col).eqNullSafe(F.col("__source"))
            & (F.col("__words") == F.col("__size")))
    rows = docs.drop(copies_col) if copies_col in docs.columns else docs
    return (rows.withColumn("__words", word_count(F.col(text_col))).join(taken, same)
            .withColumn(copies_col, F.col("__copies")).drop("__words", "__id", "__source", "__size", "__copies"))
