"""Language of whole texts: the family first, then the language within the family, by linear machines.

Texts become hashed counts of one to three letters in a row. One linear support vector machine for every pair
of families picks the family; one for every pair of its languages picks the language. Machines are fitted in
tasks, one group of rows each, on a bounded sample of labelled rows; the model is a few weight vectors, and
every text is scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from linkgraph.llm.batches import long_texts

# Families of languages by two-letter code; a language that is not listed is in "other".
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt",
    "indic": "hi bn ur pa mr gu ne",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "sinitic": "zh yue wuu",
    "celtic": "ga gd cy br",
    "austronesian": "id ms tl jv",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

UNKNOWN = "und"
DIMENSIONS = 1 << 12
LONGEST_GRAM = 3
PIECE = 1 << 18  # characters counted at a time
ROWS_PER_LANGUAGE = 400  # most rows of a language that the machines are fitted on
_cache: dict = {}


def _letters() -> np.ndarray:
    """For every character, whether it is a letter."""
    if "letters" not in _cache:
        _cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _cache["letters"]


def text_features(text: str | None) -> np.ndarray | None:
    """Square roots of hashed counts of letter sequences, scaled to length 1; None without any letter."""
    counts, seen, tail = np.zeros(DIMENSIONS), False, np.empty(0, dtype=np.uint32)
    text = text or ""
    for start in range(0, len(text), PIECE):
        piece = text[start:start + PIECE].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        seen = seen or bool(letter.any())
        codes = np.concatenate([tail, np.where(letter, codes, 32)])
        for size in range(1, LONGEST_GRAM + 1):
            first = max(0, len(tail) - size + 1)  # sequences within the tail are counted already
            run = codes[first:]
            if len(run) < size:
                continue
            total = np.full(len(run) - size + 1, size, dtype=np.uint32)
            for place in range(size):
                total = (total ^ run[place:len(run) - size + 1 + place]) * np.uint32(0x9E3779B1)
                total ^= total >> np.uint32(15)
            counts += np.bincount(total & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
        tail = codes[-(LONGEST_GRAM - 1):]
    if not seen:
        return None
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def fit_machine(x: np.ndarray, positive: np.ndarray, c: float = 1.0, epochs: int = 30) -> tuple[np.ndarray, float]:
    """A linear machine by dual coordinate descent (Hsieh et al., 2008), classes weighted to balance."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]).astype(np.float64)
    sign = np.where(positive, 1.0, -1.0)
    share = np.where(positive, positive.mean(), 1 - positive.mean())
    most = c * 0.5 / np.maximum(share, 1e-9)
    norm, alpha, w = (x * x).sum(axis=1), np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            step = alpha[i] - (sign[i] * (x[i] @ w) - 1) / norm[i]
            new = min(max(step, 0.0), most[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * sign[i] * x[i]
                alpha[i] = new
    return w[:-1].astype(np.float32), float(w[-1])


@dataclass
class LanguageModel:
    """Languages by family, and a machine (weights, bias) for each ordered pair (first against second)."""

    families: dict[str, list[str]]
    machines: dict[tuple[str, str], tuple[np.ndarray, float]]

    def _pick(self, x: np.ndarray, names: list[str], kind: str) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes, margins = dict.fromkeys(names, 0), {name: [] for name in names}
        for i, a in enumerate(names):
            for b in names[i + 1:]:
                weights, bias = self.machines[f"{kind}:{a}", f"{kind}:{b}"]
                margin = float(x @ weights) + bias
                votes[a if margin >= 0 else b] += 1
                margins[a].append(margin)
                margins[b].append(-margin)
        best = max(names, key=lambda n: (votes[n], sum(margins[n])))
        return best, 1 / (1 + float(np.exp(-4 * max(-20.0, min(margins[best])))))

    def predict(self, text: str | None) -> tuple[str, float]:
        x = text_features(text) if self.families else None
        if x is None:
            return UNKNOWN, 0.0
        family, sure = self._pick(x, sorted(self.families), "family")
        language, surer = self._pick(x, self.families[family], "language")
        return language, sure * surer


def family_of(language: Column) -> Column:
    table = F.create_map(*[F.lit(part) for pair in FAMILY_OF.items() for part in pair])
    return F.coalesce(F.try_element_at(table, language), F.lit("other"))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
                  rows_per_language: int, max_languages: int | None = None) -> DataFrame:
    """At most ``rows_per_language`` rows with letters for each language, or each of the most frequent ones, by hash."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = known.groupBy(F.col(lang_col).alias("lang")).count()
    if max_languages is not None:
        counts = counts.orderBy(F.desc("count"), "lang").limit(max_languages)
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) / float(1 << 30)
    thinned = (known.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), place.alias("place"))
               .join(F.broadcast(counts), "lang")
               .where(F.col("place") * F.col("count") <= 2.0 * rows_per_language))
    order = Window.partitionBy("lang").orderBy("place", F.xxhash64("text"))
    return (thinned.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= rows_per_language).select("text", "lang"))


def _features(text: pd.Series) -> pd.Series:
    return pd.Series([None if (x := text_features(value)) is None else x.tobytes() for value in text])


def _fit_group(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["own", "features"])  # the order of arrival has no say
    x = np.frombuffer(b"".join(rows["features"]), dtype=np.float32).reshape(len(rows), -1)
    weights, bias = fit_machine(x, (rows["own"] == rows["a"]).to_numpy())
    return pd.DataFrame({"a": rows["a"].iloc[:1], "b": rows["b"].iloc[:1], "weights": [weights.tobytes()],
                         "bias": [bias]})


def fit_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Fit the machines on a bounded sample of the rows of every language, those that have a letter.

    Only the list of languages and the weights reach the driver: a vector of 4096 numbers for each pair of
    families and each pair of languages of one family. Without a labelled row the model knows no language.
    """
    rows = training_rows(long_texts(docs), id_col, text_col, lang_col, rows_per_language)
    rows = rows.select("lang", family_of(F.col("lang")).alias("family"),
                       F.pandas_udf(_features, "binary")("text").alias("features")).where("features IS NOT NULL")
    rows = rows.persist()
    try:
        found = sorted((row["family"], row["lang"]) for row in rows.select("family", "lang").distinct().collect())
        families: dict[str, list[str]] = {}
        for family, language in found:
            families.setdefault(family, []).append(language)
        pairs = [(f"family:{a}", f"family:{b}") for a in families for b in families if a < b]
        pairs += [(f"language:{a}", f"language:{b}") for names in families.values()
                  for a in names for b in names if a < b]
        if not pairs:
            return LanguageModel(families, {})
        spark = docs.sparkSession
        both = [(name, a, b) for a, b in pairs for name in (a, b)]
        machines = F.broadcast(spark.createDataFrame(both, "own string, a string, b string"))
        owned = rows.select("features", F.explode(F.array(
            F.concat(F.lit("family:"), "family"), F.concat(F.lit("language:"), "lang"))).alias("own"))
        fitted = owned.join(machines, "own").groupBy("a", "b").applyInPandas(
            _fit_group, "a string, b string, weights binary, bias double").collect()
    finally:
        rows.unpersist()
    return LanguageModel(families, {
        (row["a"], row["b"]): (np.frombuffer(row["weights"], dtype=np.float32), row["bias"]) for row in fitted})


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with a struct of ``lang`` and ``score`` (0 to 1) for each whole text.

    ``und`` with score 0 for a null text, one without letters, or a model without languages. Ties go to the
    first language by name. Rows and other columns stay; a column called ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(value) for value in text], columns=["lang", "score"])

    # not deterministic for the planner, as a filter on the prediction would otherwise have every text predicted twice
    predicted = F.pandas_udf(predict, "lang string, score double").asNondeterministic()
    return long_texts(docs).withColumn(out_col, predicted(F.col(text_col)))
