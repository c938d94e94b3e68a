"""Patterns against plain regular expressions, message passing against all labellings."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.llm import personal_data as pd_
from oreflow.llm import queries

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, digit in enumerate(reversed(number)):
        value = int(digit) * (2 if i % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def plain(text):
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    cards = [(m.span(), digits(m.group())) for m in CARD.finditer(text)]
    found += [(2, *span) for span, d in cards if 13 <= len(d) <= 19 and luhn(d)]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return found


def test_patterns_like_plain_expressions():
    source = random.Random(1)
    for _ in range(30_000):
        text = "".join(source.choice("a0123456789.@+-() %é\n") for _ in range(source.randrange(50)))
        assert pd_.base_spans(text) == plain(text)
    for text in ("a@b.c@d.e", "x@y@z.w", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111 +1 (377) 555-0271", "0000255.1.1.1"):
        assert pd_.base_spans(text) == plain(text)


def test_long_texts_take_time_in_proportion():
    field = pd_.Field(np.zeros((40, 6)), np.zeros((6, 6)), np.zeros((6, 6)))
    for text in ("1" * 1_000_000, "a" * 1_000_000 + "@", "a@" * 500_000, "1." * 500_000, "+1 " * 300_000, "." * 10**6 + "1"):
        start = time.monotonic()
        pd_.spans_of([text], field if text.count(" ") == 0 else None)
        assert time.monotonic() - start < 60


@pytest.mark.parametrize("edges", [[(0, 1), (1, 2), (2, 3)], [(0, 1), (0, 2), (0, 3)]])
def test_messages_are_exact_on_trees(edges):
    random_ = np.random.default_rng(3)
    unary, chain, skip = random_.normal(size=(4, 6)), random_.normal(size=(6, 6)), random_.normal(size=(6, 6))
    graph = pd_.Graph(np.arange(4), np.arange(4), 4, np.array(edges[:2]), np.array(edges[2:]))
    odds = np.zeros((4, 6))
    for labels in itertools.product(range(6), repeat=4):
        score = sum(unary[i, k] for i, k in enumerate(labels))
        score += sum(chain[labels[a], labels[b]] for a, b in edges[:2])
        score += sum(skip[labels[a], labels[b]] for a, b in edges[2:])
        for i, k in enumerate(labels):
            odds[i, k] += np.exp(score)
    exact = odds / odds.sum(axis=1, keepdims=True)
    assert np.allclose(pd_.Field(unary, chain, skip).marginals(graph), exact, atol=5e-3)


def test_loops_come_near_all_labellings():
    random_ = np.random.default_rng(4)
    unary, chain, skip = 2 * random_.normal(size=(4, 6)), np.eye(6), np.eye(6)
    edges = [(0, 1), (1, 2), (2, 3), (0, 3)]
    graph = pd_.Graph(np.arange(4), np.arange(4), 4, np.array(edges[:3]), np.array(edges[3:]))
    best = max(
        itertools.product(range(6), repeat=4),
        key=lambda y: sum(unary[i, k] for i, k in enumerate(y)) + sum(y[a] == y[b] for a, b in edges),
    )
    assert tuple(pd_.Field(unary, chain, skip).marginals(graph).argmax(axis=1)) == best


@pytest.fixture(scope="module")
def field(spark):
    return pd_.learned(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_similar_words_get_one_label(field):
    text = (
        "Call +1 (377) 555-0271 now. Much later: 377 555-0271 again, in 2024, v3.0. token = "
        '"9233a8ecf7c5b09fe5949719b6b82bc439e9329b" and so on; 9233a8ecf7c5b09fe5949719b6b82bc439e9329b here'
    )
    found = [(pd_.KINDS[k], text[a:b], base) for k, a, b, base in pd_.spans_of([text], field)[0]]
    secret = ("secret", "9233a8ecf7c5b09fe5949719b6b82bc439e9329b", False)
    assert found == [("phone", "+1 (377) 555-0271", True), ("phone", "377 555-0271", False), secret, secret]
    alone = "In 2024 we sold 377 of 500, version 3.0."
    assert pd_.spans_of([alone, ""], field) == [[], []]


def test_hidden_labels_are_found(spark, field):
    """Half of the texts taught the field; on the others it finds secrets by its weights alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text IS NOT NULL")
    model = pd_.learned(docs.where("doc_id % 2 = 0"))
    texts = [r["text"] for r in docs.where("doc_id % 2 = 1").select("text").collect()]
    truth = {(i, m.span(1)) for i, t in enumerate(texts) for m in pd_._SECRET.finditer(t)}
    found = {(i, (a, b)) for i, s in enumerate(pd_.spans_of(texts, model)) for k, a, b, _ in s if k == 4}
    assert truth and len(truth & found) >= 0.9 * len(truth) and len(found - truth) <= 0.1 * len(found)


def test_nulls_clashes_repeats_and_masks(spark, field):
    rows = [(1, None, "x"), (2, "", "y"), (3, "mail a.b@c.de or 10.0.0.1", None), (3, "mail a.b@c.de or 10.0.0.1", None)]
    docs = spark.createDataFrame(rows, "id int, text string, personal string")
    for model in (field, None):
        found = pd_.with_personal_data(docs, model).withColumn("spans", pd_.listed(F.col("personal")))
        assert found.columns == ["id", "text", "personal", "spans"]
        spans = sorted((r["id"], r["text"], r["spans"]) for r in found.collect() if r["text"])
        assert spans == [(3, rows[2][1], "email:5:13,ip:17:25")] * 2
        assert {r["spans"] for r in found.collect() if not r["text"]} == {""}
        texts = sorted(str(r["text"]) for r in pd_.without_personal_data(docs, model).collect())
        assert texts == ["", "None", "mail [email] or [ip]", "mail [email] or [ip]"]
    assert pd_.with_personal_data(docs.limit(0), None).count() == 0
    assert pd_.learned(docs.limit(0)) is None
    assert pd_.learned(docs.where("text = ''")) is None


def test_query_has_the_patterns_spans(spark):
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_personal_data(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain(texts[r["doc_id"]])
        named = [f"{pd_.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for k, _, _ in spans) for i in range(4)]
        assert set(named) <= set(r["spans"].split(","))
