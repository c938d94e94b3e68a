"""The pipeline's stage for near-duplicates, against brute force."""

import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from oreflow.llm import near_copies

SF = "/root/testdata/sf0.01"


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """The least id of each group that is connected by similarities of 0.8 or more."""
    sets, holders = [plain_shingles(t) for _, t in rows], {}
    for at, found in enumerate(sets):
        for shingle in found or {()}:
            holders.setdefault(shingle, []).append(at)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in {j for shingle in a or {()} for j in holders[shingle] if j < i}:
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    groups = {}
    for at, (id, _) in enumerate(rows):
        groups.setdefault(find(at), []).append(id)
    return sorted(min(ids) for ids in groups.values())


@pytest.mark.parametrize("block", [near_copies.BLOCK, 7])
def test_stage_finds_similar_texts(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    chance = random.Random(4)
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    rows += [(100_000, None), (100_001, " "), (100_002, "a b c"), (100_003, "A b  c"), (100_004, "a b d")]
    for base in range(30):
        words = [str(chance.randint(0, 999)) for _ in range(120)]
        for copy in range(12):
            words = words[:]
            words[chance.randrange(120)] = "x"
            rows.append((200_000 + 100 * base + copy, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in kept) == plain_kept(rows)


def test_null_ids_and_no_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (4, "c d"), (None, "c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted(map(str, (r["doc_id"] for r in kept))) == ["4", "None"]
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), SF).count() == 0


def test_recall_of_the_bands_at_the_threshold():
    chance = np.random.default_rng(8)
    found = 0
    for _ in range(1000):
        values = chance.integers(0, 1 << 63, 180, np.uint64) * np.uint64(2)
        a, b = near_copies.bands(values[:162]), near_copies.bands(values[18:])  # 144 of 180
        found += any(x == y for x, y in zip(a, b, strict=True))
    assert found >= 998
