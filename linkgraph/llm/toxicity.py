"""Toxicity of whole texts by logistic regression over hashed word n-grams and skip-grams.

The regression is fitted by FTRL-proximal (McMahan et al., Ad Click Prediction, 2013): every coordinate has a
learning rate of its own, and the L1 term keeps most weights at exactly zero, so the model that goes to the
workers is a short list of indices and weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from linkgraph.llm.batches import long_texts
from linkgraph.llm.words import hash_words, letters_apart, lowered, mix

BITS = 20
MAX_ROWS = 8_000  # most labelled rows the weights are fitted on
EPOCHS = 6


def text_features(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Sorted distinct indices of words, pairs in a row, and pairs with one word between, of a whole text."""
    words = hash_words(lowered(text), letters_apart())
    if not len(words):
        return np.empty(0, dtype=np.uint32)
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])
    skips = mix(words[:-2] * np.uint64(5) + words[2:] + np.uint64(1)) if len(words) > 2 else pairs[:0]
    every = np.concatenate([words, pairs, skips]) >> np.uint64(64 - bits)
    return np.unique(every.astype(np.uint32))


class FtrlProximal:
    """State of the regression: a gradient sum and a squared gradient sum for each coordinate."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk)

    def learn(self, at: np.ndarray, label: float, importance: float) -> None:
        """One step on a row whose features ``at`` are 1."""
        w = self.weights(at)
        gradient = importance * (1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label)
        square = gradient * gradient
        sigma = (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] += square


@dataclass
class ToxicityModel:
    """Sparse weights: sorted indices, their weights, and a bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << self.bits, dtype=np.float32)
        dense[self.index] = self.weight
        return dense


def _fit_rows(features: list[np.ndarray], labels: np.ndarray, bits: int, epochs: int, alpha: float, beta: float,
              l1: float, l2: float) -> ToxicityModel:
    size = 1 << bits
    state = FtrlProximal(size + 1, alpha, beta, l1, l2)  # the last coordinate is the bias
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            state.learn(np.append(features[i], size), float(labels[i]), 1.0)
    weights = state.weights()
    index = np.flatnonzero(weights[:-1])
    return ToxicityModel(index.astype(np.uint32), weights[index].astype(np.float32), float(weights[-1]), bits)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_rows: int = MAX_ROWS, bits: int = BITS, epochs: int = EPOCHS,
                 alpha: float = 1.0, beta: float = 1.0, l1: float = 12.0, l2: float = 0.0) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled documents, chosen by a hash of the id; null labels do not count.

    The choice is made on the labels, before any text is read. A row of the sample is a list of at most
    ``2^bits`` indices. The rows pass one task, as the method is sequential; only the nonzero weights reach the
    driver. Repeated labels of a document each count. Without labels every score is the bias of 0.
    """
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) > 0).alias("label"), place.alias("place"))
    total = known.count()
    chosen = known.where(F.col("place") * F.lit(float(total)) <= 1.5 * max_rows).orderBy("place").limit(max_rows)
    texts = long_texts(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id")

    def features(text: pd.Series) -> pd.Series:
        return pd.Series([text_features(value, bits).tobytes() for value in text])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "features", "label"])
        model = _fit_rows([np.frombuffer(f, dtype=np.uint32) for f in rows["features"]],
                          rows["label"].to_numpy(), bits, epochs, alpha, beta, l1, l2)
        return pd.DataFrame({"index": [model.index.tobytes()], "weight": [model.weight.tobytes()],
                             "bias": [model.bias]})

    ready = sample.select("label", "place", F.pandas_udf(features, "binary")(F.col("text").cast("binary")).alias("features"))
    fitted = ready.groupBy().applyInPandas(fit, "index binary, weight binary, bias double").collect()
    if not fitted:
        return ToxicityModel(np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.float32), 0.0, bits)
    row = fitted[0]
    return ToxicityModel(np.frombuffer(row["index"], dtype=np.uint32),
                         np.frombuffer(row["weight"], dtype=np.float32), row["bias"], bits)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out_col: str = "toxicity") -> DataFrame:
    """``docs`` with the probability that a whole text is toxic; a null or empty text gets that of the bias.

    Rows and other columns stay; a column called ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(text: pd.Series) -> pd.Series:
        model, table = shared.value, shared.value.table()
        sums = [float(table[text_features(value, model.bits)].sum()) for value in text]
        return pd.Series(1 / (1 + np.exp(-np.clip(np.array(sums) + model.bias, -30, 30))))

    return long_texts(docs).withColumn(out_col, F.pandas_udf(score, "double")(F.col(text_col).cast("binary")))
