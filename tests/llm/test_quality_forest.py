"""The threshold of the isolation forest, against all labelled rows."""

from oreflow.llm import quality_forest

SF = "/root/testdata/sf0.01"


def parted(good, bad, threshold):
    above = lambda scores: sum(s > threshold for s in scores) / len(scores)
    return above(bad) - above(good)


def test_threshold_parts_bad_from_good(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows, threshold = quality_forest.scored(docs, labels)
    known = rows.where("not base_failed").join(labels, "doc_id").select("quality", "anomaly").collect()
    good, bad = ([r["anomaly"] for r in known if r["quality"] == q] for q in (1, 0))
    best = max(parted(good, bad, t) for t in {*good, *bad})
    assert parted(good, bad, threshold) > best - 0.01


def test_best_threshold():
    best = quality_forest.best_threshold
    assert best([(0.3, 90, 1), (0.5, 20, 1), (0.6, 4, 8)]) == 0.5
    assert best([(0.3, 90, 0), (0.5, 6, 9), (0.6, 4, 1)]) == 0.3
    assert best([(0.3, 1, 9), (0.5, 9, 1)]) == 1.0
    assert best([(0.3, 0, 9)]) == best([]) == 1.0
    assert best([(0.3, 990, 0), (0.5, 8, 0), (0.6, 2, 0)]) == 0.5
