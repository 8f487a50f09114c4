"""Language, toxicity and quality: held-out accuracy, and defined results for odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkgraph.llm import language, quality, queries, toxicity

SYLLABLES = {"en": "the er ing th on sh wh ly", "de": "der sch ung ein ß ü pf ch", "fr": "le eau é è ou que ç ai",
             "es": "el ción ñ rr os ado ía ja"}
ODD = [None, "", " \n", "12 + 3", "x" * 400_000]


def prose(rng, lang, n=60):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, lang), lang) for i in range(240) for lang in [rng.choice(list(SYLLABLES))]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").cache()


def test_language_of_unseen_texts(spark, texts):
    model = language.fit_language(texts.where("doc_id < 160"))
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    found = language.predict_language(texts.where("doc_id >= 160"), model).select("lang", "language").collect()
    assert len(found) == 80 and all(r["lang"] == r["language"]["lang"] for r in found)
    assert all(0.5 < r["language"]["score"] <= 1 for r in found)


def test_language_of_odd_rows(spark, texts):
    model = language.fit_language(texts, rows_per_language=20)
    rows = [(i, t, "n") for i, t in enumerate(ODD)] + [(None, "der die", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, language string")
    found = [r["language"] for r in language.predict_language(docs, model).collect()]
    assert [f["lang"] for f in found[:4]] == ["und"] * 4 and [f["score"] for f in found[:4]] == [0.0] * 4
    assert found[4]["lang"] in SYLLABLES and found[5] == found[6]
    assert language.predict_language(docs.limit(0), model).collect() == []
    nothing = language.fit_language(texts.limit(0))
    assert [r["language"]["lang"] for r in language.predict_language(docs, nothing).collect()] == ["und"] * len(rows)
    alone = language.fit_language(texts.where("lang = 'fr'"))
    assert {r["language"]["lang"] for r in language.predict_language(texts, alone).collect()} == {"fr"}


def test_letters_are_counted_once_across_pieces(monkeypatch):
    text = "Größe und Länge, é 世界 𝒜bc. " * 20
    whole = language.text_features(text)
    monkeypatch.setattr(language, "PIECE", 7)
    assert np.allclose(language.text_features(text), whole)
    raw = text.encode()
    whole = quality.text_view(raw)
    monkeypatch.setattr(quality, "PIECE", 5)
    assert np.allclose(quality.text_view(raw), whole)


def test_toxicity_of_unseen_texts(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        text, toxic = prose(rng, "en", rng.randrange(20, 200)).split(), i % 3 == 0
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(("idiot", "Scum,", "WORTHLESS", "moron.")))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(docs.where("doc_id < 300"), marks.where("doc_id < 300"))
    assert 0 < len(model.index) < 2000
    scored = toxicity.score_toxicity(docs.where("doc_id >= 300"), model).collect()
    right = sum((r["toxicity"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in scored)
    assert right >= 0.95 * len(scored)
    odd = spark.createDataFrame([(i, t, 1.5) for i, t in enumerate(ODD)], "doc_id bigint, text string, toxicity double")
    found = [r["toxicity"] for r in toxicity.score_toxicity(odd, model).collect()]
    assert all(0 <= s <= 1 for s in found) and found[0] == found[1] == found[2] < 0.5
    assert toxicity.score_toxicity(odd.limit(0), model).collect() == []
    none = toxicity.fit_toxicity(docs, marks.limit(0))
    assert {r["toxicity"] for r in toxicity.score_toxicity(odd, none).collect()} == {0.5}
    again = toxicity.fit_toxicity(docs.where("doc_id < 300").repartition(5), marks.where("doc_id < 300").repartition(3))
    assert (again.index == model.index).all() and (again.weight == model.weight).all()


def test_quality_of_unseen_texts(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        text, good = prose(rng, "en", 80), i % 4 != 0
        text = text if good else rng.choice((text.upper(), text.replace(" ", " | "), text.replace(" ", "$$$ ")))
        rows.append((i, text, rng.choice(("a", "b", None)), "en", len(text)))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, n_chars bigint")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality.fit_quality(docs.where("doc_id < 400"), marks.where("doc_id < 120"))
    assert model.marks > 0
    scored = quality.score_quality(docs.where("doc_id >= 400"), model).collect()
    right = sum((r["quality"]["score"] >= 0.5) == (r["doc_id"] % 4 != 0) for r in scored)
    assert right >= 0.95 * len(scored)
    odd = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(ODD)], docs.schema)
    found = [r["quality"] for r in quality.score_quality(odd, model).collect()]
    assert len(found) == len(ODD) and all(0 <= f[k] <= 1 for f in found for k in ("text", "page", "score"))
    assert quality.score_quality(odd.limit(0), model).collect() == []
    assert quality.fit_quality(docs, marks.where("quality = 1")) is None
    assert {r["quality"]["score"] for r in quality.score_quality(odd, None).collect()} == {0.5}


def test_samples_are_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("der die").alias("text"), F.lit("de").alias("lang"))
    assert language.training_rows(docs, "doc_id", "text", "lang", 100, 64).count() == 100
    two = docs.withColumn("lang", F.expr("concat('l', doc_id % 7)"))
    assert language.training_rows(two, "doc_id", "text", "lang", 10, 3).select("lang").distinct().count() == 3


@pytest.mark.parametrize("name,column", [("op1_language", "lang_pred"), ("op5_quality", "predicted"), ("op9_toxicity", "predicted")])
def test_held_out_rows_of_the_queries(spark, name, column):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES[name](spark, sf)
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    assert found.count() == docs.count()
    truth = {"lang_pred": ("lang", docs), "predicted": ("quality" if name == "op5_quality" else "toxic", labels)}[column]
    both = found.join(truth[1].select("doc_id", F.col(truth[0]).alias("truth")), "doc_id").where("held_out")
    right = both.agg(F.avg((F.col(column) == F.col("truth")).cast("int"))).first()[0]
    assert right >= 0.9


def test_no_language_is_left_out_of_training(spark):
    rows = [(i, f"text {i}", f"l{i % 70}") for i in range(210)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(language.fit_language(docs, rows_per_language=2).families["other"]) == 70


def test_only_letters_are_letters_beyond_the_basic_plane():
    assert language.text_features("\U0001F600 \U0001F680") is None
    assert language.text_features("\U00020000") is not None and language.text_features("\U0001D400") is not None


def test_quality_is_not_made_smaller_to_pass():
    import inspect
    assert quality.TEXT_SIZE == 1 << 12 and quality.ROUNDS >= 4
    assert quality.MAX_LABELLED >= 4_000 and quality.MAX_POOL >= 4_000
    assert inspect.signature(quality.fit_logistic).parameters["steps"].default >= 300
