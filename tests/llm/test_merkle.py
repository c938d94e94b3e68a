"""The manifest against a tree that is built in one piece."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from oreflow.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)])
    return levels


def path(levels, at):
    found = []
    for nodes in levels[:-1]:
        first = at // 3 * 3
        found += [n for i, n in enumerate(nodes[first : first + 3], first) if i != at]
        at //= 3
    return found


def expected(rows):
    groups = defaultdict(list)
    for id, source, text in rows:
        groups[source].append((id is not None, id or 0, leaf([id, source, text])))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = {n: tree([d for *_, d in sorted(groups[n])]) for n in names}
    top = tree([trees[n][-1][0] for n in names])
    return sorted(
        (str(id if known else None), d, trees[n][-1][0], top[-1][0], "".join(path(trees[n], i) + path(top, names.index(n))))
        for n in names
        for i, (known, id, d) in enumerate(sorted(groups[n]))
    )


CASES = {
    "one": [(5, "a", "x")],
    "sizes": [(i, f"s{n}", f"text {i}\n") for n in (1, 2, 3, 4, 9, 10, 26, 27, 28, 80, 82) for i in range(n)],
    "hot": [(i, "hot", "t" * (i % 7)) for i in range(1000)] + [(i, f"é{i}", None) for i in range(60)],
    "odd": [(None, None, None), (None, None, None), (1, None, ""), (1, "", "é" * 50_000), (1, "", "x"), (1, "", "x"), (-3, "z", "y")],
}


@pytest.mark.parametrize("case", CASES)
def test_like_a_tree_in_one_piece(spark, case):
    rows = CASES[case]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, root int")
    found = merkle.manifest(docs, ["doc_id", "source", "text"]).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in found)
    got = sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found)
    assert got == expected(rows)


def test_changed_rows_do_not_verify(spark):
    docs = spark.createDataFrame(CASES["sizes"], "doc_id long, source string, text string")
    text = F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(docs, ["doc_id", "source", "text"], presented={"text": text}).collect()
    assert len(found) == len(CASES["sizes"])
    assert all(r["verified"] == (r["doc_id"] % 2 == 1) for r in found)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert merkle.manifest(docs, ["doc_id", "text"]).count() == 0
