"""The pipeline on a small corpus with planted cases, against plain Python up to the mix, which is checked by its rules."""

import random

import pytest

import corpus_pipeline
from linkgraph.llm import pii
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(tmp_path, spark):
    rng = random.Random(12)
    en = lambda n: " ".join("".join(rng.choice("the er ing th on sh wh ly".split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    de = lambda n: " ".join("".join(rng.choice("der sch ung ein ß ü pf ch".split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))
    items = [(i, en(30)) for i in range(4)]
    docs = []
    for i in range(60):
        lang, make = rng.choice((("en", en), ("de", de)))
        docs.append([i, make(rng.choice((6, 60, 150))), lang if rng.random() < 0.9 else None, rng.choice(("a", "b", "c", None))])
    for i, d in enumerate(rng.sample(docs[:50], 15)):  # exact and near copies
        text = d[1].split()
        if i % 2 and len(text) > 100:
            text[3] = "changed"
        docs.append([100 + i, " ".join(text), d[2], "a"])
    for i in range(6):  # benchmark passages
        docs.append([200 + i, f"{en(80)} {items[i % 4][1]} {en(40)}", "en", "b"])
    for i in range(6):  # personal data
        docs.append([300 + i, f"{en(50)} ann.{i}@mail.example.com {en(20)} bob [at] c{i} [dot] de", "en", "c"])
    docs += [[400, None, "en", "a"], [401, "", None, "a"], [402, "12 -- 34", "en", None], [None, en(40), "en", "a"],
             [300, docs[-1][1] + " and more of it", "en", "c"]]
    docs.append(list(docs[5]))  # a repeated row
    rows = [(*d, len(d[1] or "")) for d in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, items


def test_stages_equal_plain_python(spark, tmp_path):
    rows, items = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "benchmark", "personal_data", "mix"]

    kept = stages["language"](spark, docs, str(tmp_path)).cache()
    want = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(((r[0], r[1]) for r in want), key=str)
    assert kept.where("lang IS NULL").count() == 0 and kept.columns == docs.columns

    firsts = stages["near_copies"](spark, kept, str(tmp_path)).cache()
    numbered = [(n, r[1]) for n, r in enumerate(want)]
    component = brute.ngram_components(numbered, 5, 8, 10)
    groups = {}
    for n, r in enumerate(want):
        groups.setdefault(component[n][1], []).append(r)
    # one document of each group: the smallest id; a row without id is no document's copy
    expected = []
    for group in groups.values():
        named = [r for r in group if r[0] is not None]
        least = min((r[0] for r in named), default=None)
        expected += [(least, r[1]) for r in {r[1]: r for r in named if r[0] == least}.values()]
        expected += [(None, r[1]) for r in group if r[0] is None]
    assert sorted(((r["doc_id"], r["text"]) for r in firsts.collect()), key=str) == sorted(expected, key=str)

    clean = stages["benchmark"](spark, firsts, str(tmp_path)).cache()
    bad = {d for d, _ in brute.contained(expected, items)}
    assert bad >= {200, 201}
    expected = [(i, t) for i, t in expected if i not in bad]
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(expected, key=str)

    masked = stages["personal_data"](spark, clean, str(tmp_path)).cache()
    expected = [(i, pii.redacted(t, pii.all_spans(t))) for i, t in expected]
    assert sorted(((r["doc_id"], r["text"]) for r in masked.collect()), key=str) == sorted(expected, key=str)
    assert masked.where("text LIKE '%@%' OR text LIKE '%[dot]%'").count() == 0
    assert masked.where("n_chars <> length(text)").count() == 0 and masked.columns == docs.columns

    mixed = stages["mix"](spark, masked, str(tmp_path)).collect()
    sizes, largest, taken = {}, {}, {}
    for r in masked.collect():
        n = len(brute.words(r["text"]))
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        largest[r["source"]] = max(largest.get(r["source"], 0), n)
    for r in mixed:
        assert 1 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * len(brute.words(r["text"]))
    for source, target in brute.targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= largest[source]

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, mixed), key=str)


def test_each_text_is_predicted_once(spark, tmp_path):
    corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.keep_known_languages(spark, docs, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_empty_tables_pass_all_stages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_further_columns_stay(spark, tmp_path, stage):
    rows, _ = corpus(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("*", "1 AS node", "'x' AS id", "2 AS size", "'y' AS item")
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    assert out.columns[:len(docs.columns)] == docs.columns
    assert {(r["node"], r["id"], r["size"], r["item"]) for r in out.collect()} == {(1, "x", 2, "y")}
