"""Codes against plain loops over Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from oreflow.llm import vector_codes as vc


def nearest(part, book):
    return min(range(len(book)), key=lambda i: (sum((a - b) ** 2 for a, b in zip(part, book[i])), i))


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dimension = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dimension]
    width = dimension // parts
    cut = [[[math.floor(4096 * x) for x in v[p * width : (p + 1) * width]] for p in range(parts)] for _, v, _ in kept]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = [[] for _ in book]
            for v in cut:
                members[nearest(v[p], book)].append(v[p])
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for e, m in zip(book, members)]
    sums, out = {}, []
    for (i, _, lab), v in zip(kept, cut):
        code = [nearest(x, book) for x, book in zip(v, books)]
        error = sum((a - b) ** 2 for x, k, book in zip(v, code, books) for a, b in zip(x, book[k]))
        sums[lab] = sums.get(lab, 0) + error
        out.append((i, "".join(f"{k:02x}" for k in code), error, lab))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    top = (1 << 63) - 1
    return sorted(((i, c, min(e, top), min(sums[lab], top), digest) for i, c, e, lab in out), key=str)


def vectors(n, dimension, scale, seed):
    source = random.Random(seed)
    return [[source.gauss(0, scale) for _ in range(dimension)] for _ in range(n)]


CASES = {
    "many": [(i, v, i % 3 if i % 7 else None) for i, v in enumerate(vectors(300, 16, 0.2, 1))],
    "few": [(9 - i, v, None) for i, v in enumerate(vectors(5, 8, 1, 2))],
    "coarse": [(i % 50, [float(round(x)) for x in v], i) for i, v in enumerate(vectors(200, 8, 1, 3))],
    "huge": [(i, v, 1) for i, v in enumerate(vectors(60, 16, 1e9, 4))],
    "copies": [(i, [0.5] * 8, 0) for i in range(100)],
    "odd": [(1, None, 1), (2, [math.nan] * 8, 1), (3, [None] + [1.0] * 7, 1), (4, [math.inf] * 8, 2), (None, [0.1] * 8, 5)]
    + [(6, [0.2] * 8, 5), (6, [0.2] * 8, 5), (7, [0.3] * 16, 5)],
    "none": [(1, None, 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_like_plain_loops(spark, case):
    rows = [(*r, "x") for r in CASES[case]]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string")
    found = vc.compressed(docs)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(CASES[case])


def test_rare_labels_meet_by_shuffling(spark):
    rows = [(i, v, 0 if i < 1500 else i // 2) for i, v in enumerate(vectors(3000, 8, 1, 5))]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vc.compressed(docs).collect()
    sums = {}
    for r in found:
        label = rows[r["vec_id"]][2]
        sums[label] = sums.get(label, 0) + r["error"]
    assert len(found) == 3000 and all(r["label_error"] == sums[rows[r["vec_id"]][2]] for r in found)


def test_search_ends_at_a_strictly_greater_gap():
    # The gap of the sums is exactly the distance: the entry of lower index is still found.
    entries = np.array([[2, 2], [0, 0]])
    index, distance = vc.nearest(np.array([[1, 1], [3, 3], [0, 1]]), entries)
    assert index.tolist() == [0, 0, 1] and distance.tolist() == [2, 2, 1]


def test_uncuttable_vectors_are_an_error(spark):
    docs = spark.createDataFrame([(1, [1.0] * 9, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="9 components"):
        vc.compressed(docs)
