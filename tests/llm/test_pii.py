import hashlib
import random
import time

import pytest

from linkgraph.llm import pii
from tests.llm import brute


def test_plain_spans_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(4000):
        text = "".join(rng.choice("ab1190.@-_%+ ()é9") for _ in range(rng.randrange(120)))
        assert pii.plain_spans(text) == brute.personal(text), text


@pytest.mark.parametrize("text,kind,part", [
    ("mail j0hn.doe (at) example [dot] com now", "email", "j0hn.doe (at) example [dot] com"),
    ("mail ann@exаmple.com now", "email", "ann@exаmple.com"),
    ("to ann at mail dot example dot org please", "email", "ann at mail dot example dot org"),
    ("call plus one five five five one two three four five six seven ok", "phone",
     "plus one five five five one two three four five six seven"),
    ("card ４１１１１１１１１１１１１１１１ x", "card", "４１１１１１１１１１１１１１１１"),
    ("from one nine two dot one six eight dot one dot four.", "ip", "one nine two dot one six eight dot one dot four"),
    ("a​nn@example.com", "email", "a​nn@example.com"),
])
def test_disguised_spans_are_in_the_source(text, kind, part):
    spans = pii.all_spans(text)
    assert (kind, part, True) in [(k, text[a:b], added) for k, a, b, added in spans]


@pytest.mark.parametrize("text", [
    "look at the dot and at one or two or three", "meet at noon", "one two three", "für dich, été, niño", "", None,
    "(at) [dot] {at}", "dot at dot at"])
def test_clean_texts_have_no_spans(text):
    assert pii.all_spans(text) == []


def test_plain_spans_stay_and_redaction_follows():
    text = "x a.b@c.de, card 4111 1111 1111 1111, 10.0.0.1 and +1 (269) 555-3296; bob [at] c [dot] de"
    spans = pii.all_spans(text)
    assert [s[:3] for s in spans if not s[3]] == sorted(brute.personal(text), key=lambda s: pii.KINDS.index(s[0]))
    assert pii.redacted(text, spans) == "x [EMAIL], card [CARD], [IP] and [PHONE]; [EMAIL]"


def test_time_is_linear():
    started = time.time()
    for unit in ("@", "1", "1.", "a", "(", " ", "+1", "one ", "a@", "１", "dot "):
        pii.all_spans(unit * 60_000)
    assert time.time() - started < 60


def test_digest_and_edge_rows(spark):
    rows = [(1, "m a@b.cd 1.2.3.4", "e"), (1, "m a@b.cd 1.2.3.4", "e"), (2, None, None), (None, "", "x"), (3, "z" * 300_000 + " q@r.st", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = [tuple(r) for r in pii.span_digest(docs).collect()]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    base = "email:2:8,ip:9:16"
    want = [(1, 1, 1, 0, 0, sha(base), base, 0)] * 2 + [(2, 0, 0, 0, 0, sha(""), "", 0), (None, 0, 0, 0, 0, sha(""), "", 0)]
    long = "email:300001:300007"
    want.append((3, 1, 0, 0, 0, sha(long), long, 0))
    assert sorted(got, key=str) == sorted(want, key=str)
    assert pii.span_digest(docs.limit(0)).collect() == []


def test_redact_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "to a@b.cd", "k", 9), (2, None, None, None), (2, "", "k", 7)],
                                 "doc_id bigint, text string, personal string, n_chars bigint")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "to [EMAIL]", "k", 10), (2, None, None, None), (2, "", "k", 0)], key=str)
    named = pii.with_personal_spans(docs).where("doc_id = 1").first()["personal"]
    assert [(s["kind"], s["start"], s["end"], s["added"]) for s in named] == [("email", 3, 9, False)]
