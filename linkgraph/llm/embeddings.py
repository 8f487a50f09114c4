"""Near-duplicate vectors by int8 tile products with error bounds for every vector.

A unit vector u is kept as s * q, q of 8-bit integers, with the length e of what is lost. For two vectors

    |u.v - s_u s_v (q_u.q_v)| <= e_u + e_v + e_u e_v,

so a pair whose product lies lower than the threshold by more than that cannot reach it. Only the other pairs
are worked out in double precision. Products of integers are exact.

Equal vectors are one class with a size. Classes are dealt to cells around pivots and within a cell to tiles;
two cells that are further apart than their radii and the threshold's angle allow are never compared. A tile
pair gives sums of links for each class and a forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkgraph.llm.components import connected_components
from linkgraph.llm.scratch import Scratch
from linkgraph.session import scratch_path, written

TILE = 4096  # classes in a tile, about
MAX_PIVOTS = 256
SLACK = 1e-5  # more than single precision can lose when integer products are scaled


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, dtype=np.float64)
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """8-bit rows, their scales, and a bound on the length of the error of each row."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return q.astype(np.int8), scale, error


def tile_links(a: dict, b: dict, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of two tiles with cosine at or above the threshold; within one tile i < j."""
    kind = np.float32 if a["q"].shape[1] * 127 * 127 < 1 << 24 else np.float64
    left, right = a["q"].astype(kind), b["q"].astype(kind).T
    found_i, found_j = [], []
    for at in range(0, len(left), 512):
        rows = slice(at, at + 512)
        product = (left[rows] @ right) * (a["scale"][rows, None] * b["scale"][None, :]).astype(kind)
        reach = (threshold - SLACK - a["error"][rows, None]
                 - b["error"][None, :] * (1 + a["error"][rows, None])).astype(kind)
        i, j = np.nonzero(product >= reach)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        if len(i) > 64 * 512:  # dense: one product of all rows costs less than gathering pairs
            exact = (a["unit"][rows] @ b["unit"].T)[i - at, j]
        else:
            exact = np.einsum("ij,ij->i", a["unit"][i], b["unit"][j])
        above = exact >= threshold
        found_i.append(i[above])
        found_j.append(j[above])
    if not found_i:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as join what the links (a, b) join: each id with the smallest of its component."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[:len(a)], place[len(a):]
    label = np.arange(len(ids))
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(ids))
    return ids[apart], ids[label[apart]]


def _valid(vector: str):
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def _pivots(classes: DataFrame, count: int) -> dict[int, np.ndarray]:
    """At most ``count`` unit vectors for each length of vector, chosen by hash; a bounded sample."""
    per_length = classes.withColumn("length", F.size("vector"))
    parts = per_length.withColumn("part", F.pmod(F.xxhash64("class"), F.lit(count)))
    rows = (parts.groupBy("length", "part").agg(F.min_by("vector", F.xxhash64("class")).alias("vector")).collect())
    found: dict[int, list] = {}
    for row in rows:
        found.setdefault(row["length"], []).append(row["vector"])
    return {length: unit_rows(np.array(vectors)) for length, vectors in found.items()}


def _cells(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Each class with the nearest pivot of its length (``cell``) and the angle to it."""

    def nearest(vector: pd.Series) -> pd.DataFrame:
        cells, angles = np.zeros(len(vector), dtype=np.int64), np.zeros(len(vector))
        lengths = vector.map(len).to_numpy()
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            unit = unit_rows(np.stack(vector.iloc[rows].to_numpy()))
            cosine = np.clip(unit @ pivots[int(length)].T, -1, 1)
            cells[rows] = cosine.argmax(axis=1)
            angles[rows] = np.arccos(cosine.max(axis=1))
        return pd.DataFrame({"cell": cells, "angle": angles})

    found = F.pandas_udf(nearest, "cell bigint, angle double")("vector")
    return (classes.withColumn("found", found)
            .select("class", "vector", "n", F.size("vector").alias("length"), "found.cell", "found.angle"))


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("class")
    x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    q, scale, error = quantised(unit_rows(x))
    return pd.DataFrame({
        "length": rows["length"].iloc[:1].to_numpy(), "cell": rows["cell"].iloc[:1].to_numpy(),
        "tile": rows["tile"].iloc[:1].to_numpy(), "ids": [rows["class"].to_numpy(dtype=np.int64).tobytes()],
        "sizes": [rows["n"].to_numpy(dtype=np.int64).tobytes()], "vectors": [x.tobytes()], "q": [q.tobytes()],
        "scale": [scale.tobytes()], "error": [error.tobytes()]})


PARTS = ("ids", "sizes", "vectors", "q", "scale", "error")


def _unpack(parts: dict, length: int) -> dict:
    return {"ids": np.frombuffer(parts["ids"], dtype=np.int64), "sizes": np.frombuffer(parts["sizes"], dtype=np.int64),
            "unit": unit_rows(np.frombuffer(parts["vectors"]).reshape(-1, length)),
            "q": np.frombuffer(parts["q"], dtype=np.int8).reshape(-1, length),
            "scale": np.frombuffer(parts["scale"]), "error": np.frombuffer(parts["error"])}


def _tile_pairs(spark, cells: list, pivots: dict[int, np.ndarray], threshold: float, tile: int) -> DataFrame:
    """Pairs of tiles that can hold a link; decided for pairs of cells, of which there is a fixed number at most."""
    allowed = []
    for one in cells:
        for two in cells:
            if one["length"] != two["length"] or one["cell"] > two["cell"]:
                continue
            unit = pivots[one["length"]]
            between = math.acos(min(1.0, max(-1.0, float(unit[one["cell"]] @ unit[two["cell"]]))))
            if (one["cell"] == two["cell"]
                    or between - one["radius"] - two["radius"] <= math.acos(threshold) + 1e-6):
                allowed.append((one["length"], one["cell"], two["cell"], -(-one["n"] // tile), -(-two["n"] // tile)))
    pairs = spark.createDataFrame(allowed, "length int, cell_a bigint, cell_b bigint, tiles_a bigint, tiles_b bigint")
    return (pairs.withColumn("tile_a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles_a") - 1)))
            .withColumn("tile_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles_b") - 1)))
            .where("cell_a < cell_b OR tile_a <= tile_b").drop("tiles_a", "tiles_b"))


def _compared(pairs: DataFrame, tiles: DataFrame, threshold: float) -> DataFrame:
    """Rows (class, null, links) and rows (class, smaller class of its component, null) of all tile pairs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sides = [_unpack({p: row[f"{p}_{side}"] for p in PARTS}, row["length"]) for side in "ab"]
                i, j = tile_links(*sides, row["same"], threshold)
                if not len(i):
                    continue
                a, b = sides
                n_a = np.bincount(i, weights=b["sizes"][j], minlength=len(a["ids"])).astype(np.int64)
                n_b = np.bincount(j, weights=a["sizes"][i], minlength=len(b["ids"])).astype(np.int64)
                ids = np.concatenate([a["ids"][n_a > 0], b["ids"][n_b > 0]])
                links = np.concatenate([n_a[n_a > 0], n_b[n_b > 0]])
                node, root = forest(a["ids"][i], b["ids"][j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([ids, node])),
                     pa.array([None] * len(ids) + root.tolist(), pa.int64()),
                     pa.array(links.tolist() + [None] * len(node), pa.int64())], names=["a", "b", "links"])

    def side(name: str) -> DataFrame:
        renamed = {p: f"{p}_{name}" for p in (*PARTS, "cell", "tile")}
        return tiles.withColumnsRenamed(renamed)

    joined = (pairs.join(side("a"), ["length", "cell_a", "tile_a"]).join(side("b"), ["length", "cell_b", "tile_b"])
              .withColumn("same", (F.col("cell_a") == F.col("cell_b")) & (F.col("tile_a") == F.col("tile_b"))))
    kept = ["length", "same", *(f"{p}_{name}" for name in "ab" for p in PARTS)]
    return joined.select(kept).mapInArrow(compare, "a bigint, b bigint, links bigint")


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         threshold: float = 0.95, tile: int = TILE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows link where the cosine in double precision is at least ``threshold``. Vectors that are null, empty or
    zero, or hold a null or a non-finite number, and rows with a null id, link with nothing; vectors of different
    length are never compared. Repeated rows count as further vectors. ``kept`` marks the smallest id of each
    component. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector"))
    valid = F.coalesce(_valid("vector"), F.lit(False)) & F.col("vec_id").isNotNull()
    classes = written(rows.where(valid).groupBy("vector").agg(F.min("vec_id").alias("class"), F.count("*").alias("n")),
                      scratch_path(spark, "classes"))
    total = classes.count()
    pivots = _pivots(classes, max(1, min(MAX_PIVOTS, total // (4 * tile)))) if total else {}
    scratch = Scratch(spark)
    placed = scratch.write(_cells(classes, pivots), "cells")
    cells = placed.groupBy("length", "cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
    counts = spark.createDataFrame([(c["length"], c["cell"], -(-c["n"] // tile)) for c in cells],
                                   "length int, cell bigint, tiles bigint")
    tiles = scratch.write(placed.join(F.broadcast(counts), ["length", "cell"])
                    .withColumn("tile", F.pmod(F.xxhash64("class"), F.col("tiles")))
                    .groupBy("length", "cell", "tile").applyInPandas(
                        _pack, "length int, cell bigint, tile bigint, ids binary, sizes binary, vectors binary, "
                               "q binary, scale binary, error binary"), "tiles")
    compared = written(_compared(_tile_pairs(spark, cells, pivots, threshold, tile), tiles, threshold),
                       scratch_path(spark, "compared"))
    scratch.drop()
    roots = connected_components(compared.where("b IS NOT NULL"))
    links = compared.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    of_class = (classes.join(links, F.col("class") == F.col("a"), "left")
                .join(roots, F.col("class") == F.col("node"), "left")
                .select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                        F.coalesce("root", "class").alias("component_id")))
    linked = rows.where(valid).join(of_class, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where(~valid).select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                      F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
