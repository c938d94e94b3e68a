"""Licences whose rarest word in the corpus lies outside their key phrase."""

import time

from oreflow.llm.licences import LICENCES, with_licences


def test_key_phrases_are_looked_up(spark):
    rows = [(1, "licensed under CC BY-NC 3.0"), (2, "the Lesser General Public License")]
    # '4' and 'gnu' are the rarest words here, and hold less than the share that may be missing.
    rows += [(10 + i, "by cc nc licensed under 0 lesser public general license") for i in range(6)]
    rows += [(20 + i, "4 gnu") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in with_licences(docs).collect()}
    assert got[1].split(",") == ["cc-by", "cc-by-nc"]
    assert got[2].split(",") == ["gpl", "lgpl"]
    assert all(got[10 + i] == "" for i in range(6))


def test_whole_texts_are_found_with_a_few_other_words(spark):
    whole = next(t for t in LICENCES if t.label == "mit" and len(t.words) > 100)
    changed = [("x" if at % 10 == 0 and at not in whole.key_places else w) for at, w in enumerate(whole.words)]
    torn = [w for at, w in enumerate(whole.words) if at not in whole.key_places]
    rows = [(1, " ".join(changed)), (2, " ".join(torn[4:])), (3, "The software. " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in with_licences(docs).collect()}
    assert got[1]["labels"] == "mit" and 0.6 <= got[1]["score"] < 1
    assert got[2]["labels"] == got[3]["labels"] == ""


def test_five_megabytes_of_one_phrase_take_seconds(spark):
    # The length hangs on the row, or the optimizer would make the text a constant of the plan.
    times = 5_000_000 // 6
    docs = spark.range(1).selectExpr("id AS doc_id", f"repeat('cc by ', CAST({times} + id AS int)) AS text")
    begun = time.monotonic()
    row = with_licences(docs).drop("text", "found").head()
    assert time.monotonic() - begun < 60
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (2 * times, times, 0, 2 * times - 2)
    assert row["labels"] == "cc-by"


def test_clashing_columns_are_replaced(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, "All rights reserved", "b")], "doc_id long, text string, labels string")
    got = with_licences(docs)
    assert got.columns.count("labels") == 1
    assert sorted(r["labels"] for r in got.collect()) == ["", "reserved"]
    assert with_licences(docs.limit(0)).count() == 0
