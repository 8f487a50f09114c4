import random

import pytest
from pyspark.sql import functions as F

from linkgraph.llm import mixing
from tests.llm import brute


def corpus(seed=1, n=600):
    rng = random.Random(seed)
    sources = ["b", "a", "ä", "B", "zz", None, "hot"]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.4 else rng.choice(sources)
        count = rng.choice((0, 1, 3, 10, 50, 200))
        rows.append((i, " ".join("w" for _ in range(count)) if count or rng.random() < 0.5 else None, source))
    return rows


SCHEMA = "doc_id bigint, text string, source string"


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b\tc\x0bd\ne \r", "é x"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(mixing.word_count(F.col("t"))).collect()] == [len(brute.words(t)) for t in texts]


@pytest.mark.parametrize("rows_per_bin", [5_000, 7])
def test_mix_meets_targets(spark, rows_per_bin, monkeypatch):
    monkeypatch.setattr(mixing.pareto_mix, "__defaults__", (42, 3, rows_per_bin))
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = mixing.mixed_sources(docs).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    want = brute.targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 * sum(sizes.values())
        assert 0 <= r["copies"] <= 3 and (r["size"] or not r["copies"])
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert sorted(r["id"] for r in got) == sorted(i for i, _, _ in rows)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source], source
    again = mixing.mixed_sources(docs.repartition(5)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got), key=str)


def test_limits_are_shared_again(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(10, "a"), (10, "b"), (1000, "c"), (5, None), (0, "d")])]
    found = {r["source"]: r["target"] for r in mixing.mixed_sources(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute.targets({"a": 10, "b": 10, "c": 1000, None: 5, "d": 0})
    assert found == pytest.approx(want)
    assert found["a"] == 30 and sum(found.values()) == pytest.approx(1025)


def test_inclusion_follows_preference(spark):
    rows = [(i, "w " * (2 if i % 2 else 500), "s") for i in range(400)] + [(1000 + i, "w " * 100, "t") for i in range(900)]
    got = mixing.mixed_sources(spark.createDataFrame(rows, SCHEMA)).where("source = 's'").collect()
    rate = lambda size: sum(r["copies"] for r in got if r["size"] == size) / 200
    assert rate(500) > rate(2)


def test_repeated_rows_and_edges(spark):
    rows = [(1, "a b c", "s", 9)] * 4 + [(None, "a b", "s", 1)] * 2 + [(2, None, None, 2), (3, "", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies int")
    got = mixing.mixed_sources(docs).collect()
    assert len(got) == len(rows)
    assert len({r["copies"] for r in got if r["id"] == 1}) == 1
    assert all(r["copies"] == 0 for r in got if r["source"] is None)
    taken = mixing.take_mix(docs)
    assert taken.columns == [*docs.drop("copies").columns, "copies"] and taken.where("copies < 1").count() == 0
    empty = docs.limit(0)
    assert mixing.mixed_sources(empty).collect() == [] and mixing.take_mix(empty).collect() == []
