"""Quality of documents by co-training a text view and a metadata view.

Two logistic regressions see different things: one hashed runs of characters of the whole text, the other the
page's metadata (source, language, length, layout). In every round each marks the unlabelled documents that it
is surest about, and the marks are added to the rows the other learns from (Blum and Mitchell, 1998). In the
end both are calibrated on labelled rows kept back, and their calibrated log odds are averaged for every
document.

The regressions are fitted on bounded samples in one task; all documents are scored, on whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from linkgraph.llm.batches import long_texts

TEXT_SIZE = 1 << 12
PAGE_SIZE = 1 << 8
PIECE = 1 << 18  # bytes of a text looked at together
MAX_LABELLED = 4_000  # most labelled rows that are learned from
MAX_POOL = 4_000  # most unlabelled rows that take part in the rounds
ROUNDS = 4
MARKS = 100  # most marks a view gives in a round, of each kind
SURE = 0.95
EDGES = (8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 65536)


def _hash(codes: np.ndarray, size: int) -> np.ndarray:
    codes = codes * np.uint32(0x9E3779B1)
    codes ^= codes >> np.uint32(15)
    return codes & np.uint32(size - 1)


def text_view(text: bytes | None) -> np.ndarray:
    """Square roots of hashed counts of one to three bytes in a row, scaled to length 1; zeros without text.

    Letters are kept as they are, digits are one symbol, so case and signs count and single numbers do not.
    """
    counts, tail = np.zeros(TEXT_SIZE), np.empty(0, dtype=np.uint32)
    data = np.frombuffer(text or b"", dtype=np.uint8)
    for start in range(0, len(data), PIECE):
        piece = data[start:start + PIECE].astype(np.uint32)
        piece[(piece >= 48) & (piece <= 57)] = 48
        row = np.concatenate([tail, piece])
        for size in (1, 2, 3):
            run = row[max(0, len(tail) - size + 1):]
            if len(run) >= size:
                total = np.full(len(run) - size + 1, size, dtype=np.uint32)
                for place in range(size):
                    total = (total << np.uint32(8)) ^ run[place:len(run) - size + 1 + place] ^ (total >> np.uint32(24))
                counts += np.bincount(_hash(total, TEXT_SIZE), minlength=TEXT_SIZE)
        tail = row[-2:]
    length = np.sqrt(counts.sum())
    return (np.sqrt(counts) / length if length else counts).astype(np.float32)


def _level(value: float) -> int:
    return int(np.searchsorted(EDGES, value, side="right"))


def page_view(text: bytes | None, source: str | None, lang: str | None, n_chars: float | None) -> np.ndarray:
    """One-hot metadata: hashed source and language, size class, lines, longest line, share of signs and capitals."""
    text = text or b""
    lines = text.count(b"\n") + 1
    data = np.frombuffer(text, dtype=np.uint8)
    breaks = np.flatnonzero(data == 10)
    longest = int(np.diff(np.concatenate([[-1], breaks, [len(data)]])).max()) if len(data) else 0
    signs = int((((data >= 33) & (data <= 47)) | ((data >= 58) & (data <= 64)) | ((data >= 91) & (data <= 96))
                 | ((data >= 123) & (data <= 126))).sum())
    capitals = int(((data >= 65) & (data <= 90)).sum())
    size = max(1, len(data))
    names = (f"source={source}", f"lang={lang}", f"chars={_level(n_chars or 0)}", f"lines={_level(lines)}",
             f"longest={_level(longest)}", f"signs={int(40 * signs / size)}", f"capitals={int(20 * capitals / size)}")
    out = np.zeros(PAGE_SIZE, dtype=np.float32)
    for name in names:
        place = 2166136261
        for byte in name.encode():
            place = (place ^ byte) * 16777619 & 0xFFFFFFFF
        out[(place ^ (place >> 16)) % PAGE_SIZE] += 1 / np.sqrt(len(names))
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient descent; rows count by ``weight``, both classes alike in sum."""
    w, b = np.zeros(x.shape[1], dtype=np.float32), np.float32(0)
    share = np.where(y == 1, weight[y == 1].sum(), weight[y == 0].sum())
    weight = (weight / np.maximum(share, 1e-12) / 2).astype(np.float32)
    y, l2 = y.astype(np.float32), np.float32(l2)  # single precision throughout, so that no step copies the rows
    last, momentum, rate = (w, b), (w, b), np.float32(4)
    for step in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ momentum[0] + momentum[1], -30, 30)))
        error = weight * (p - y)
        new = (momentum[0] - rate * (x.T @ error + l2 * momentum[0]), momentum[1] - rate * error.sum())
        push = np.float32(step / (step + 3))
        momentum = tuple(n + push * (n - o) for n, o in zip(new, last))
        last = new
    return last[0].astype(np.float32), float(last[1])


def _calibration(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift that make a margin a log odds (Platt), with targets drawn in so that nothing is certain."""
    good, bad = int((y == 1).sum()), int((y == 0).sum())
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        v = np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        hessian = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()],
                            [(v * margin).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        step *= min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


@dataclass
class QualityModel:
    """Weights, bias and calibration of the text view and of the metadata view."""

    text: tuple[np.ndarray, float, float, float]
    page: tuple[np.ndarray, float, float, float]
    marks: int = 0

    def log_odds(self, text: np.ndarray, page: np.ndarray) -> tuple[float, float]:
        (w, b, scale, shift), (v, c, scale2, shift2) = self.text, self.page
        return scale * (float(text @ w) + b) + shift, scale2 * (float(page @ v) + c) + shift2


def co_train(views: list[np.ndarray], y: np.ndarray, kept: np.ndarray, pool: list[np.ndarray], rounds: int,
             marks: int, sure: float) -> QualityModel:
    """Two regressions that teach each other on the pool; ``kept`` rows calibrate and are not learned from."""
    learn = ~kept
    given = [np.full(len(pool[0]), -1), np.full(len(pool[0]), -1)]  # what the other view has marked

    def fit(view: int) -> tuple[np.ndarray, float]:
        own = given[view] >= 0
        x = np.concatenate([views[view][learn], pool[view][own]])
        label = np.concatenate([y[learn], given[view][own]])
        return fit_logistic(x, label, np.concatenate([np.ones(learn.sum()), np.full(own.sum(), 0.5)]))

    models = [fit(0), fit(1)]
    for _ in range(rounds):
        for view in (0, 1):
            w, b = models[view]
            margin = pool[view] @ w + b
            scale, shift = _calibration(views[view][kept] @ w + b, y[kept])
            p = 1 / (1 + np.exp(-np.clip(scale * margin + shift, -30, 30)))
            open_rows = given[1 - view] < 0
            for label, surety in ((1, p), (0, 1 - p)):
                rows = np.flatnonzero(open_rows & (surety >= sure))
                rows = rows[np.argsort(-surety[rows], kind="stable")][:marks]
                given[1 - view][rows] = label
        models = [fit(0), fit(1)]
    ready = []
    for view in (0, 1):
        w, b = models[view]
        ready.append((w, b, *_calibration(views[view][kept] @ w + b, y[kept])))
    return QualityModel(ready[0], ready[1], int(sum((g >= 0).sum() for g in given)))


def _views(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({
        "text": [text_view(t).tobytes() for t in text],
        "page": [page_view(t, s, g, 0 if n is None or n != n else n).tobytes()
                 for t, s, g, n in zip(text, source, lang, n_chars)]})


def _inputs(docs: DataFrame, text_col: str, source_col: str, lang_col: str, length_col: str) -> list:
    return [F.col(text_col).cast("binary"), F.col(source_col).cast("string"), F.col(lang_col).cast("string"),
            F.col(length_col).cast("double")]


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", lang_col: str = "lang", length_col: str = "n_chars",
                label_col: str = "quality", max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL,
                rounds: int = ROUNDS, marks: int = MARKS, sure: float = SURE) -> QualityModel | None:
    """Co-train on at most ``max_labelled`` labelled and ``max_pool`` unlabelled documents, chosen by hash.

    A fifth of the labelled ones is kept back for calibration. Null labels do not count. None where the labels
    do not show both kinds.
    """
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).withColumn("place", place)
    total = known.count()
    chosen = known.where(F.col("place") * F.lit(float(total)) <= 1.5 * max_labelled).orderBy("place").limit(max_labelled)
    ids = docs.select(F.col(id_col).alias("id")).where("id IS NOT NULL")
    rows = ids.count()
    pool = (ids.withColumn("place", place).where(F.col("place") * F.lit(float(rows)) <= 1.5 * max_pool)
            .join(F.broadcast(known.where(F.col("place") * F.lit(float(rows)) <= 1.5 * max_pool).select("id")), "id", "left_anti")
            .orderBy("place").limit(max_pool).select("id", F.lit(-1).alias("label"), "place"))
    picked = chosen.unionByName(pool)
    texts = long_texts(docs).select(F.col(id_col).alias("id"), *_aliased(docs, text_col, source_col, lang_col, length_col))
    sample = texts.join(F.broadcast(picked), "id")
    ready = sample.select("label", "place", F.pandas_udf(_views, "text binary, page binary")(
        "t", "s", "g", "n").alias("view"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "text", "page"])
        views = [np.frombuffer(b"".join(rows[name]), dtype=np.float32).reshape(len(rows), -1)
                 for name in ("text", "page")]
        label = rows["label"].to_numpy()
        known = label >= 0
        y = label[known]
        kept = np.arange(len(y)) % 5 == 0
        if len(set(y[kept])) < 2 or len(set(y[~kept])) < 2:
            return pd.DataFrame({"weights": [], "other": []}, dtype=object)
        model = co_train([v[known] for v in views], y, kept, [v[~known] for v in views], rounds, marks, sure)
        return pd.DataFrame({"weights": [model.text[0].tobytes(), model.page[0].tobytes()],
                             "other": [[*model.text[1:], float(model.marks)], [*model.page[1:], float(model.marks)]]})

    fitted = ready.select("label", "place", "view.text", "view.page").groupBy().applyInPandas(
        fit, "weights binary, other array<double>").collect()
    if len(fitted) < 2:
        return None
    parts = {len(row["weights"]) // 4: row for row in fitted}
    made = [(np.frombuffer(parts[size]["weights"], dtype=np.float32), *parts[size]["other"][:3])
            for size in (TEXT_SIZE, PAGE_SIZE)]
    return QualityModel(made[0], made[1], int(fitted[0]["other"][3]))


def _aliased(docs: DataFrame, text_col: str, source_col: str, lang_col: str, length_col: str) -> list:
    return [c.alias(name) for c, name in zip(_inputs(docs, text_col, source_col, lang_col, length_col), "tsgn")]


def score_quality(docs: DataFrame, model: QualityModel | None, text_col: str = "text", source_col: str = "source",
                  lang_col: str = "lang", length_col: str = "n_chars", out_col: str = "quality") -> DataFrame:
    """``docs`` with a struct of ``text``, ``page`` and ``score``: the probability of good quality by each view,
    and by both together.

    Null and empty texts, and null metadata, are scored for what they are; without a model all is 0.5. Rows and
    other columns stay; a column called ``out_col`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sigmoid(value: float) -> float:
        return 1 / (1 + float(np.exp(-max(-30.0, min(30.0, value)))))

    def score(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        model, rows = shared.value, []
        for t, s, g, n in zip(text, source, lang, n_chars):
            one, two = (0.0, 0.0) if model is None else model.log_odds(
                text_view(t), page_view(t, s, g, 0 if n is None or n != n else n))
            rows.append((sigmoid(one), sigmoid(two), sigmoid((one + two) / 2)))
        return pd.DataFrame(rows, columns=["text", "page", "score"])

    found = F.pandas_udf(score, "text double, page double, score double")
    return long_texts(docs).withColumn(out_col, found(*_inputs(docs, text_col, source_col, lang_col, length_col)))
