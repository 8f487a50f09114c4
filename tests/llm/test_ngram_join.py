import random

import numpy as np
import pyarrow as pa
import pytest

from linkgraph.llm import ngram_join
from linkgraph.llm.components import connected_components
from linkgraph.llm.words import hash_words, lowered, shingles
from tests.llm import brute

SCHEMA = "doc_id bigint, text string"


def varied(seed, families=12, copies=8):
    """Families of texts whose copies differ in a few words, with shared passages, short and empty texts."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice((3, 8, 15, 40, 120, 400)))]
        if rng.random() < 0.5:
            base = base[:len(base) // 2] + passage + base[len(base) // 2:]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 5))):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text).upper() if rng.random() < 0.1 else " \t".join(text))
    rows += [None, "", "  \n", "one", "one two", "ONE two", "one two three"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size,num,den", [(3, 90, 100), (5, 8, 10), (2, 1, 2)])
def test_components_equal_brute_force(spark, size, num, den):
    rows = varied(size)
    found = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA), size=size, num=num, den=den)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == brute.ngram_components(rows, size, num, den)


@pytest.mark.parametrize("num,den", [(90, 100), (8, 10), (6, 10)])
def test_similar_sets_share_a_signature(num, den):
    rng, seen = np.random.default_rng(7), 0
    for _ in range(1500):
        n = int(rng.integers(2, 150)) if rng.random() < 0.9 else int(rng.integers(150, 2000))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        drop, add = (int(rng.integers(0, max(1, n // 6) + 1)) for _ in "ab")
        b = np.unique(np.concatenate([rng.permutation(a)[:n - drop], rng.integers(0, 2 ** 63, add).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        union = len(a) + len(b) - common
        if common < union and den * common >= num * union:
            seen += 1
            assert len(np.intersect1d(ngram_join.signatures(a, num, den), ngram_join.signatures(b, num, den)))
    assert seen > 200


def test_empty_parts_do_not_lose_pairs():
    """Sets that miss a whole partition share a signature of a further scheme."""
    shape = ngram_join.plan(12, 90, 100)
    rng, seen = np.random.default_rng(3), 0
    for _ in range(20000):
        a = np.unique(rng.integers(0, 2 ** 63, 11).astype(np.uint64))
        index, _, _ = ngram_join.bands(11, 90, 100)
        if ngram_join._scheme(a, index, 0, shape)[1].any():
            seen += 1
            assert len(np.intersect1d(ngram_join.signatures(a, 90, 100), ngram_join.signatures(a[:-1], 90, 100)))
    assert seen


def test_sketches_never_rule_out_similar_sets():
    rng = np.random.default_rng(5)
    for n in (1, 5, 300, 3000):
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 10:], rng.integers(0, 2 ** 63, n // 10).astype(np.uint64)]))
        differ = len(np.setxor1d(a, b))
        one, two = (np.frombuffer(ngram_join.odd_sketch(s), dtype=np.uint8)[None] for s in (a, b))
        width = min(one.shape[1], two.shape[1])
        one, two = ngram_join._fold(one, width), ngram_join._fold(two, width)
        assert int(np.bitwise_count(one ^ two).sum()) <= differ


def test_a_forest_joins_what_similar_pairs_join():
    rng = np.random.default_rng(4)
    for one_block in (True, False):
        base = [np.unique(rng.integers(0, 2 ** 62, 60)) for _ in range(4)]
        elements = [np.unique(np.concatenate([rng.permutation(base[k % 4])[:rng.integers(50, 60)],
                                              rng.integers(0, 2 ** 62, rng.integers(0, 6))])) for k in range(40)]
        roots, blocks = [k // 2 for k in range(40)], rng.integers(0, 2, 40).tolist()
        got = ngram_join.forest_of_similar(roots, blocks, elements, one_block, 8, 10)
        want = [(i, j) for i in range(40) for j in range(i + 1, 40) if (one_block or blocks[i] != blocks[j])
                and 10 * len(np.intersect1d(elements[i], elements[j])) >= 8 * len(np.union1d(elements[i], elements[j]))]
        start = [(2 * r, 2 * r + 1) for r in range(20)]
        assert set(got) <= set(want) and len(got) < 20
        assert brute.components(range(40), start + got) == brute.components(range(40), start + want)


@pytest.mark.parametrize("elements", [1 << 22, 200])
def test_large_near_families_give_few_links(spark, monkeypatch, elements):
    monkeypatch.setattr(ngram_join, "BLOCK_ELEMENTS", elements)
    rng = random.Random(7)
    rows = []
    for family in range(3):
        base = [f"w{family}x{k}" for k in range(120)]
        for copy in range(60):  # each half of a family lies just below the limit to the other half
            words = list(base)
            for k in rng.sample(range(0, 120, 9), 3 if copy % 2 else 2):
                words[k] = f"own{copy}x{k}"
            rows.append((len(rows), " ".join(words)))
    got = {r["id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA), size=3, num=9, den=10).collect()}
    assert got == brute.ngram_components(rows, 3, 9, 10)


def test_blocks_cover_large_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rows = varied(99, families=4, copies=20)
    found = ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA), size=3, num=8, den=10)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == brute.ngram_components(rows, 3, 8, 10)


def test_lists_of_numbers_come_as_arrays():
    rows = [[1, 2], [], [3], [4, 5, 6]]
    got = ngram_join._values(pa.array(rows, pa.list_(pa.int64())).slice(1))
    assert all(isinstance(g, np.ndarray) and g.base is None for g in got)
    assert [g.tolist() for g in got] == rows[1:]
    assert ngram_join._values(pa.array([b"a", b"b"])) == [b"a", b"b"]


def test_ids_beyond_the_broadcast_bound_are_joined(spark):
    rows = spark.range(20).toDF("x")
    ids = spark.createDataFrame([(i,) for i in (3, 5, 7)], "id bigint")
    assert sorted(r[0] for r in ngram_join.rows_with_ids(rows, "x", ids, bound=1).collect()) == [3, 5, 7]


def test_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, 5, "x"), (1, text, 5, "x"), (2, text, None, None), (None, text, 1, "y"), (None, None, 2, "z"), (4, "", 0, "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, node bigint, name string")
    got = sorted(map(tuple, ngram_join.ngram_components(docs).collect()), key=str)
    assert got == sorted([(1, 26, 1), (1, 26, 1), (2, 26, 1), (None, 26, 1), (None, 0, None), (4, 0, 4)], key=str)
    kept = ngram_join.first_of_components(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[0], rows[3], rows[4], rows[5]], key=str)


def test_empty_table_and_long_text(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ngram_join.ngram_components(empty).collect() == []
    long = " ".join(f"w{i % 50021}" for i in range(300_000))
    rows = [(7, long), (3, long + " end"), (5, "short")]
    got = {r["id"]: r["component_id"] for r in ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {7: 3, 3: 3, 5: 5}


def test_word_hashes_follow_words(monkeypatch):
    from linkgraph.llm import words
    text = "The the\tTHE  é É naïve\x0bend " * 50
    data = lowered(text.encode())
    hashes = hash_words(data)
    plain = brute.words(text)
    assert len(hashes) == len(plain)
    assert len(set(hashes.tolist())) == len(set(plain))
    monkeypatch.setattr(words, "PIECE", 7)
    assert (hash_words(data) == hashes).all()
    assert len(shingles(hashes[:2], 3)) == 1 and len(shingles(hashes[:0], 3)) == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(200, 200), (None, 3), (201, 202), (202, 201)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {201: 201, 202: 201}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
