"""Periodic runs, token files and ranked search."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkgraph.llm import ball_search, direct_codes, periodic_runs, queries, token_files
from linkgraph.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id bigint, text string, found int, __text string, n int"


# periodic runs

def brute_runs(words, least=24, times=3):
    """Runs by comparing every word with the one a period on."""
    best = {}
    for period in range(1, len(words) // times + 1):
        i = 0
        while i + period < len(words):
            if words[i] != words[i + period]:
                i += 1
                continue
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if length >= max(least, times * period):
                best.setdefault((start, length), period)
    return sorted(((s, n, p) for (s, n), p in best.items()), key=lambda run: (run[0], run[2]))


def brute_row(doc_id, text, least=24):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, least)
    drop = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda run: (-(run[1] * 10**12 // run[2]), run[0], run[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else best[1] * 1000 // best[2],
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def periodic_words(rng, n, kinds):
    words = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 10:
            start, period = rng.randrange(n - 5), rng.randint(1, 6)
            for i in range(start + period, min(n, start + rng.randint(5, 60))):
                words[i] = words[i - period]
    return words


@pytest.mark.parametrize("least,times", [(3, 3), (8, 3), (24, 3), (10, 4)])
def test_runs_equal_brute_force(least, times):
    rng = random.Random(least * times)
    for _ in range(800):
        words = periodic_words(rng, rng.randint(0, 90), rng.randint(1, 4))
        found = periodic_runs.runs_of(np.array(words, dtype=np.int64), least, times)
        assert found == brute_runs(words, least, times), words


def test_runs_of_hard_texts_are_found_in_time():
    line = np.arange(40)
    assert periodic_runs.runs_of(np.zeros(200_000, dtype=np.int64)) == [(0, 200_000, 1)]
    apart = np.concatenate([np.concatenate([[100 + k], line]) for k in range(3000)])
    assert periodic_runs.runs_of(apart) == []
    many = np.concatenate([np.concatenate([[100 + k], np.zeros(300, dtype=np.int64)]) for k in range(300)])
    assert len(periodic_runs.runs_of(many)) == 300


def test_places_keep_order():
    rng = random.Random(4)
    places, plain = periodic_runs.Places([5]), [5]
    for place in rng.sample(range(6, 100_000), 9000) + [1]:
        places.add(place)
        plain.append(place)
    assert list(places) == sorted(plain) and places.n == len(plain)
    plain.sort()
    for wanted in (0, 1, 2, 5000, 99_999, 100_000):
        assert places.from_on(wanted) == next((p for p in plain if p >= wanted), None)


def test_runs_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{x}" for x in periodic_words(rng, rng.randint(0, 120), rng.randint(1, 3)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (None, "a b " * 30), (7, "x " * 500), (7, "x " * 500),
             (1003, " a b\x1c " * 40), (1004, "a A " * 40)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path))
    want = [brute_row(*row) for row in rows]
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]


def test_runs_with_clashing_columns_and_empty_tables(spark):
    rows = [(1, "a b " * 20 + "c", 5, "t", 3), (2, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    got = {r["doc_id"]: r for r in periodic_runs.with_runs(frame.drop("__text")).collect()}
    assert got[1]["n"] == 3 and got[1]["found"]["runs"][0].asDict() == {"start": 0, "length": 40, "period": 2}
    assert got[1]["found"]["collapsed"] == "a b c" and got[2]["found"]["collapsed"] == ""
    same = {r["doc_id"]: r for r in periodic_runs.collapse_runs(frame).collect()}
    assert same[1]["text"] == "a b c" and same[1]["found"] == 5 and same[1]["__text"] == "t" and same[2]["text"] is None
    assert periodic_runs.with_runs(frame.limit(0)).count() == 0


# token files

@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 2**32), (1000, 50_000), (5000, 2**20), (4096, 16)])
def test_codes_round_trip(n, top):
    rng = np.random.default_rng(n + top)
    values = (rng.integers(0, top, n) * rng.random(n) ** 4).astype(np.uint64)
    found = direct_codes.Segment(b"\0" * 3 + direct_codes.encode_segment(values, [None], [0, n], 4, 5, 6), 3)
    assert (found.part, found.number, found.first, found.ids, found.doc_ids) == (4, 5, 6, n, [None])
    assert (found.range(0, n) == values).all()
    for i in rng.integers(0, n, 50) if n else []:
        assert found.get(int(i)) == values[i]
    for start, end in np.sort(rng.integers(0, n + 1, (30, 2)), axis=1).tolist():
        assert (found.range(start, end) == values[start:end]).all()


def test_pieces_give_the_ids_of_whole_texts():
    encoder, plain = token_files.text_encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    rng = random.Random(3)
    parts = ["a", "B", "the", " ", "  ", "\n", "\t", "'s", "'S", ".", "!?", " .", "1", "é", "日本", " ", " ", "\x1c", "\x85",
             "<|endoftext|>", "<|endo", "😀", "I'll", "\r\n", "_", "ß"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        ids = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == ids, text


def test_tokenizers_that_join_words_get_whole_texts(tmp_path):
    settings = json.loads(open(VOCABULARY, encoding="utf-8").read())
    assert token_files._cuts_at_spaces(settings)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None},
                   {"added_tokens": [{**settings["added_tokens"][0], "content": "a b"}]}):
        assert not token_files._cuts_at_spaces({**settings, **change})
    other = public_tokenizers.path("word_bpe_49k.json")
    ids = Tokenizer.from_file(other).encode("Some  words, 12.", add_special_tokens=False).ids
    assert np.frombuffer(token_files.text_encoder(other)(["Some  words, 12."])[0], "<u4").tolist() == ids


def brute_tokens(rows, end=2):
    plain, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in sorted(rows):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_query_equals_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["foo", "Bar.", "baz\n\nqux", "Ünï", "12"]) for _ in range(rng.randint(0, 60))))
            for i in rng.sample(range(10_000), 200)]
    rows += [(20_000, None), (20_001, ""), (20_002, "word " * 30_000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for size in (1 << 20, 300):
        monkeypatch.setattr(token_files, "SEGMENT_IDS", size)
        got = queries.op13_token_files(spark, str(tmp_path)).orderBy("doc_id")
        assert list(map(tuple, got.collect())) == brute_tokens([(i, t or "") for i, t in rows])


def test_any_token_is_read_by_its_number(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    rows = [(i, f"text number {i} of the table, " * (i % 7), 9) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part int")
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(docs, path, VOCABULARY, end_id=2)
    plain, stream = Tokenizer.from_file(VOCABULARY), []
    for doc_id, text, _ in rows:
        stream += [(doc_id, token) for token in plain.encode(text, add_special_tokens=False).ids + [2]]
    read = {r["doc_id"]: r["ids"] for r in token_files.read_tokens(spark, path).collect()}
    assert read == {i: [t for d, t in stream if d == i] for i, _, _ in rows}
    asked = [0, 1, 5, 5, len(stream) - 1, len(stream), -1, None] + random.Random(1).sample(range(len(stream)), 100)
    index = token_files.with_starts(token_files.token_index(spark, path))
    for by_name in (10_000, 0):
        monkeypatch.setattr(token_files, "FILES_BY_NAME", by_name)
        got = token_files.tokens_at(index, spark.createDataFrame([(p,) for p in asked], "position bigint")).collect()
        want = [(p, *stream[p]) for p in asked if p is not None and 0 <= p < len(stream)]
        assert sorted(map(tuple, got)) == sorted(want)


def test_tokens_of_repeated_rows_nulls_and_nothing(spark):
    rows = [(None, "b"), (3, "x y"), (3, "x y"), (3, "z"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, token_files.token_digest(docs, VOCABULARY, 2).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 3, 3, 3] and [r[1] for r in got][0] == 0
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    assert sorted(r[2] for r in got) == [1, 2, 2, 3, 3]
    assert token_files.token_digest(docs.limit(0), VOCABULARY, 2).count() == 0


# ranked search

def brute_search(docs, items, k=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    split = lambda t: term.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
    counts = [(i, Counter(split(t))) for i, t in docs]
    held = Counter(t for _, c in counts for t in c)
    n_docs, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in counts:
            n = sum(c.values())
            score = 0
            for t in set(split(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * (10 + (90 * n * n_docs) // total)))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, doc_id, -score))
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "A1"]
    docs = [(i, ", ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 40))))
            for i in range(n)]
    docs += [(n + i, docs[i % 5][1].upper() + "!") for i in range(40)]  # ties
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("leaf,item_terms", [(32, 1 << 16), (2, 40), (1, 1 << 16)])
def test_search_equals_brute_force(spark, monkeypatch, leaf, item_terms):
    docs, items = corpus(leaf, 300)
    docs += [(9000, None), (9001, ""), (9002, ".,;"), (None, "w1 w2"), (None, "w1 w2"), (5, docs[5][1]), (9003, "w1 " * 5000)]
    items += [(100, None), (101, "..."), (102, "nowhere"), (None, "w1 w3"), (3, "w2 w2 W2")]
    monkeypatch.setattr(ball_search, "LEAF", leaf)
    left = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, at int").repartition(3)
    right = spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, rank int")
    got = ball_search.top_documents(left, right, item_terms=item_terms)
    key = lambda row: tuple(str(x) for x in row)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_search(docs, items), key=key)


def test_search_of_nothing(spark):
    docs, items = corpus(1, 5)
    left = spark.createDataFrame(docs, "doc_id bigint, text string")
    right = spark.createDataFrame(items, "item_id bigint, text string")
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.limit(0), right.limit(0))):
        got = ball_search.top_documents(a, b)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 10**6, (8, 50)) * (rng.random((8, 50)) < 0.3)
    rows = (centres[rng.integers(0, 8, 800)] + rng.integers(0, 2000, (800, 50))).astype(np.float64) * 5000
    flat = np.concatenate([np.flatnonzero(c) for c in centres])
    sizes = np.array([np.count_nonzero(c) for c in centres])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    balls = ball_search.Balls(rows, 16)
    bounds = balls.bounds(flat, starts, sizes)
    exact = np.add.reduceat(rows[:, flat].astype(np.int64), starts, axis=1)
    for node, (low, high) in enumerate(balls.span):
        assert (bounds[node] >= exact[balls.order[low:high]].max(axis=0)).all()
    best = [[] for _ in sizes]
    looked = ball_search.search_block(balls, list(range(800)), flat, starts, sizes, best, 10)
    leaves = sum(not c for c in balls.children)
    assert looked < leaves * len(sizes) / 2
    for item, heap in enumerate(best):
        order = sorted((-int(s), i) for i, s in enumerate(exact[:, item]))[:10]
        assert sorted((-s, -i) for s, _, i in heap) == order
