"""BM25 retrieval against every item in every window, and the recall of altered items."""

import math
import random
from collections import Counter

import duckdb
import pytest

from oreflow.llm import decontamination as d
from oreflow.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def items():
    return duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet' ORDER BY item_id").fetchall()


def plain_matches(texts, items):
    """{(document, item): (score, question, answer)} by the definition alone."""
    split = [(i, d.words_of(t), d.question_and_answer(t)) for i, t in items]
    count, mean = len(split), sum(len(w) for _, w, _ in split) / len(split)
    frequency = Counter(w for _, ws, _ in split for w in set(ws))
    strides, weighed = {}, []
    for item, ws, parts in split:
        if ws:
            level = max(8, 2 ** math.ceil(math.log2(len(ws))))
            strides[level] = max(strides.get(level, 1), len(ws))
            norm = 1.2 * (0.25 + 0.75 * len(ws) / mean)
            weights = {
                w: math.log1p((count - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * 2.2 / (n + norm)
                for w, n in Counter(ws).items()
            }
            weighed.append((item, level, weights, sum(weights.values()), parts))
    best = {}
    for doc, text in texts:
        ws = d.words_of(text)
        for level, stride in strides.items():
            for begin in range(0, len(ws), stride):
                window = set(ws[begin : begin + 2 * stride])
                for item, own, weights, total, parts in weighed:
                    if own != level:
                        continue
                    score = sum(x for w, x in weights.items() if w in window) / total
                    shares = [len(p & window) / len(p) if p else 1.0 for p in parts]
                    if score >= 0.7 and min(shares) >= 0.8:
                        best[doc, item] = max(best.get((doc, item), (0,)), (min(score, 1.0), *shares))
    return best


def altered(text, how, rng):
    """The text with a tenth of its words changed, cut out or moved."""
    words = text.split()
    some = rng.sample(range(len(words)), max(1, len(words) // 10))
    if how == "changed":
        return " ".join("zzqx" if i in some else w for i, w in enumerate(words))
    left = [w for i, w in enumerate(words) if i not in some]
    if how == "moved":
        for i in some:
            left.insert(rng.randrange(len(left) + 1), words[i])
    return " ".join(left)


def planted(items, rng):
    """Texts that hold an altered item each, between words of other items; (document, item) -> text."""
    pool = [w for _, t in items for w in (t or "").split()]
    rows = {}
    for number, (item, text) in enumerate(items):
        for how in ("changed", "cut", "moved"):
            around = [" ".join(rng.choices(pool, k=rng.randrange(120))) for _ in range(2)]
            rows[f"{number}-{how}", item] = f"{around[0]} {altered(text, how, rng)} {around[1]}"
    return rows


@pytest.mark.parametrize("block", [1, 3, 16])
def test_every_score_is_that_of_brute_force(items, block, monkeypatch):
    rng = random.Random(block)
    monkeypatch.setattr(d, "BLOCK", block)
    monkeypatch.setattr(d, "_AT_ONCE", 1 << rng.choice([6, 12, 20]))
    some = rng.sample(items, min(40, len(items))) + [(-1, None), (-2, ""), (-3, "one"), (-4, "one")]
    rows = planted([r for r in some if r[1] and len(r[1].split()) > 1], rng)
    texts = [(doc, t) for (doc, _), t in rows.items()] + [("", None), ("e", ""), ("o", "One. " * 99)]
    frequency = Counter(w for _, t in some for w in set(d.words_of(t)))
    mean = sum(len(d.words_of(t)) for _, t in some) / len(some)
    index = d.Index(some, frequency, len(some), mean)
    got = index.matches([t for _, t in texts])
    found = {(doc, m[0]): m[1:] for (doc, _), ms in zip(texts, got, strict=True) for m in ms}
    expected = plain_matches(texts, some)
    assert found.keys() == expected.keys() and ("o", -3) in found and ("o", -4) in found
    assert all(found[k] == pytest.approx(expected[k]) for k in expected)


def test_altered_items_are_recalled(spark, items):
    rows = planted([r for r in items if len(r[1].split()) >= 10], random.Random(7))
    docs = spark.createDataFrame([(doc, t) for (doc, _), t in rows.items()], "doc_id string, text string")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, bench).collect()}
    recall = len(got & rows.keys()) / len(rows)
    print("recall", recall, {h: sum(k[0].endswith(h) for k in got & rows.keys()) for h in ("changed", "cut", "moved")}, len(rows))
    assert recall >= 0.9


def test_one_index_after_the_other_finds_the_same(spark, monkeypatch):
    docs, bench = queries.table(spark, SF, "documents"), queries.table(spark, SF, "benchmark")
    docs = docs.withColumnRenamed("source", "matches")
    whole = sorted(d.contaminated(docs, bench).collect())
    monkeypatch.setattr(d, "ITEM_BYTES", 4000)
    parts = sorted(d.contaminated(docs, bench).collect())
    assert whole and [r[:2] for r in parts] == [r[:2] for r in whole]
    assert d.with_matches(docs, bench).columns.count("matches") == 1
