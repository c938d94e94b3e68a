"""The fingerprints, lists and links that the pipeline's stage for near-duplicates takes its candidates from."""

import random

import numpy as np
import pytest

import corpus_pipeline
from oreflow.llm import near_copies
from oreflow.llm.components import components


def similar(chance, shared, own, other):
    """Hashes of two texts' shingles."""
    values = chance.integers(0, 1 << 64, shared + own + other, np.uint64, endpoint=False)
    return values[: shared + own], np.concatenate([values[:shared], values[shared + own :]])


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 600])
def test_fingerprint_has_the_bits_of_over_half_of_the_hashes(n):
    hashes = np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64)
    bits = np.unpackbits(near_copies._widened(hashes), axis=1).sum(axis=0)
    assert near_copies.fingerprint(hashes).tolist() == np.packbits(2 * bits > n).tolist()


@pytest.mark.parametrize("short", [256, 3])
def test_links_connect_what_meets_and_is_alike(spark, monkeypatch, short):
    monkeypatch.setattr(near_copies, "SHORT_LIST", short)
    chance = np.random.default_rng(1)
    prints = [near_copies.fingerprint(chance.integers(0, 1 << 63, 9, np.uint64)) for _ in range(20)]
    for start in range(4):
        found = prints[start]
        for _ in range(25):
            found = found ^ np.packbits(chance.random(8 * len(found)) < chance.choice([0.02, 0.15, 0.25]))
            prints.append(found)
    prints = np.array(prints)
    high, low = near_copies._carried(prints)
    keys, entries = near_copies._keys(prints), near_copies._entry(high, low).tolist()
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            apart = np.unpackbits(prints[i, -16:] ^ prints[j, -16:])
            shared = (apart.reshape(-1, 4).sum(axis=1) == 0).sum()
            if (keys[i] == keys[j]).any() and shared >= near_copies.MIN_SHARED and apart.sum() <= near_copies.MAX_BITS:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    rows = spark.createDataFrame([(bytearray(p.tobytes()),) for p in prints], "print binary")
    got = {r["node"]: r["root"] for r in components(near_copies.linked_entries(rows), "t").collect()}
    expected = {e: min(entries[j] for j in range(len(root)) if root[j] == root[i]) for i, e in enumerate(entries)}
    assert {e: got.get(e, e) for e in entries} == expected
    assert 20 < len(set(expected.values())) < 100


@pytest.mark.parametrize("sizes, least", [((144, 18, 18), 1995), ((16, 0, 4), 1995), ((12, 1, 2), 1990), ((5, 0, 1), 1990)])
def test_similar_texts_meet_and_are_alike(sizes, least):
    chance, found = np.random.default_rng(8), 0
    for _ in range(2000):
        prints = np.array([near_copies.fingerprint(h) for h in similar(chance, *sizes)])
        keys = near_copies._keys(prints)
        found += (keys[0] == keys[1]).any() and near_copies.alike(*near_copies._carried(prints), 0, np.array([1]))[0]
    assert found >= least


def test_unlike_texts_are_not_alike():
    chance = np.random.default_rng(2)
    high, low = chance.integers(0, 1 << 64, (2, 100_000), np.uint64, endpoint=False)
    assert near_copies.alike(high, low, np.arange(99_999), np.arange(1, 100_000)).sum() <= 3


def test_four_of_five_shingles_are_always_found(spark):
    chance, rows = random.Random(6), []
    for at in range(600):
        words = [str(chance.randint(0, 10**6)) for _ in range(9)]
        rows += [(2 * at, " ".join(words[:8])), (2 * at + 1, " ".join(words))]
    rows += [(5_000, "a b c d e f g h i"), (5_001, "b c d e f g h i j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [*range(0, 1200, 2), 5_000, 5_001]


def test_stage_takes_its_candidates_from_fingerprints(spark, monkeypatch):
    words = [str(i) for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-2])), (3, " ".join(reversed(words)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]
    monkeypatch.setattr(near_copies, "MAX_BITS", -1)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 2, 3]
