"""Packing, preferences, web records, the pipeline, and every query that has SQL."""

import glob
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from oreflow.llm import packing, preferences, queries, tokens, warc
from oreflow.llm.common import saved

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    result = duck.execute(queries.ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    theirs = Counter(tuple(str(row[names.index(c)]) for c in sorted(names)) for row in result.fetchall())
    assert Counter(tuple(str(row[c]) for c in sorted(names)) for row in df.collect()) == theirs


@pytest.mark.parametrize("queues", [255, 2, 0])
@pytest.mark.parametrize("weights", [None, {"s0": 1, "s1": 5, "s2": 2, None: 3}, {"s1": 4, "absent": 9}])
def test_packing_is_whole_and_gapless(spark, monkeypatch, queues, weights):
    monkeypatch.setattr(packing, "QUEUES", queues)
    monkeypatch.setattr(packing, "MEMBERS", 2)
    path = tokens.vocabulary(queries.VOCABULARY)
    texts = [None, "", "x", "word " * 20_000, "a b c " * 3000, "É" * 500] + ["the end " * n for n in range(40)]
    rows = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = queries.pieces(packing.packed(docs, path, weights=weights)).collect()
    library = Tokenizer.from_file(path)
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _ in rows}
    documents, sequences = {}, {}
    for p in pieces:
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] > 0 and p["doc_tokens"] == len(ids[p["doc_id"]])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p["ids_crc32"]
        documents.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for found, whole in ((documents, ids), (sequences, None)):
        for name, parts in found.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at <= packing.LENGTH if whole is None else at == len(whole[name])
    assert set(documents) == set(ids)
    assert len(sequences) <= 1.05 * sum(map(len, ids.values())) / packing.LENGTH + 2
    assert packing.packed(docs.limit(0), path).count() == 0


def test_full_windows_have_the_target_proportions():
    schedule = packing.Schedule([100_000, 250_000, 7_000, 40])
    begins, _ = schedule.segment(1)
    takes = np.diff(begins, axis=0)
    assert (takes.sum(axis=1)[:-1] == packing.LENGTH).all()
    share = schedule.totals / schedule.totals.sum() * packing.LENGTH
    assert np.abs(takes[:-1] - share).max() < 2


def _share_by_hand(totals, weights, tokens):
    """What each queue has been served after so many tokens, queues running dry one by one."""
    left, served, open_tokens = list(totals), [0.0] * len(totals), tokens
    while open_tokens > 1e-6 and any(n > 1e-9 for n in left):
        live = [q for q, n in enumerate(left) if n > 1e-9]
        whole = sum(weights[q] for q in live)
        step = min(open_tokens / whole, *(left[q] / weights[q] for q in live))
        for q in live:
            served[q] += step * weights[q]
            left[q] -= step * weights[q]
        open_tokens -= step * whole
    return np.array(served)


@pytest.mark.parametrize("weighted", [False, True])
def test_windows_of_a_thousand_sources_against_shares_by_hand(weighted):
    rng = np.random.default_rng(7)
    totals = rng.integers(1, 900, 1000)
    totals[:3] = 60_000
    weights = rng.integers(1, 9, 1000) if weighted else totals
    schedule = packing.Schedule(totals.tolist(), weights.tolist())
    before = np.zeros(len(totals))
    for number in range(schedule.segments):
        begins, _ = schedule.segment(number)
        takes = np.diff(begins, axis=0)
        assert (takes.sum(axis=1)[:-1] == packing.LENGTH).all() and (takes >= 0).all()
        assert takes[-1].sum() <= packing.LENGTH and (begins[0] == before).all()
        fair = _share_by_hand(totals, weights, number * schedule.quota)
        assert np.abs(begins[0] - fair).max() <= 1 + 1e-6
        before = begins[-1]
    assert (before == totals).all()


def test_merged_sources_keep_their_proportions(spark):
    sizes = {f"s{n:03}": 20 + 7 * (n % 13) for n in range(300)} | {None: 55}
    sums = spark.createDataFrame(list(sizes.items()), "source string, tokens long")
    merges = {r["source"]: [m.asDict() for m in r["merges"]] for r in packing._merges(sums).collect()}
    assert set(merges) == set(sizes)
    merged, total, taken = packing.Merges(), sum(sizes.values()), {}
    for source, size in sizes.items():
        # The same places whether a source is one document or several.
        whole = merged.placed(merges[source], 0, size)
        halves = merged.placed(merges[source], 0, size // 2) + merged.placed(merges[source], size // 2, size - size // 2)
        flat = [[at + k for _, n, at in parts for k in range(n)] for parts in (whole, halves)]
        assert flat[0] == flat[1] and sum(n for _, n, _ in whole) == size
        taken.update(dict.fromkeys(flat[0], source))
    assert sorted(taken) == list(range(total))
    # Up to any place a source is no further from its proportion than its share of a window of each merge.
    served = Counter()
    for at in range(total):
        if at % packing.LENGTH == 0:
            for name, size in sizes.items():
                groups = [sum(m["totals"]) for m in merges[name]]
                assert abs(served[name] - size * at / total) < sum(packing.LENGTH * size / g + 2 for g in groups)
        served[taken[at]] += 1


def test_preferences_render_the_prefix_once(spark):
    kind = "conv_id long, turn long, role string, text string"
    chosen = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "q"), (None, None, None, None)]
    rejected = [(1, 0, "user", "hi"), (1, 1, "assistant", "no<|"), (2, 0, "user", "q"), (2, 0, "user", "q")]
    rows = preferences.preference_rows(spark.createDataFrame(chosen, kind), spark.createDataFrame(rejected, kind))
    rows = rows.cache()
    got = Counter((r["conv_id"], r["part"], r["rendered"], r["is_target"]) for r in rows.collect())
    for r in rows.collect():  # the loss is of text and end mark, not of the role's line
        spanned = r["is_target"] and r["rendered"][r["target_begin"] : r["target_end"]]
        assert spanned in (False, "yes<|im_end|>", "no< |<|im_end|>")
        assert r["is_target"] or (r["target_begin"], r["target_end"]) == (None, None)
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert got == Counter(
        [
            (1, "prompt", turn("user", "hi"), False),
            (1, "chosen", turn("assistant", "yes"), True),
            (1, "rejected", turn("assistant", "no< |"), True),
            (2, "chosen", turn("user", "q"), False),
            (2, "rejected", turn("user", "q"), False),
            (2, "rejected", turn("user", "q"), False),
            (None, "chosen", turn("", ""), False),
        ]
    )
    empty = spark.createDataFrame([], kind)
    assert preferences.preference_rows(empty, preferences.neighbours_as_rejected(empty)).count() == 0


def test_warc_files_hold_the_records(spark, folder):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<title>T é</title><p>one<br>two &amp; three<script>x</script>"), (None, None, None)],
        "page_id long, url string, html string",
    )
    source = warc.responses(pages)
    records = source.unionByName(warc.derivatives(source))
    warc.write_warc(records, folder + "/w")
    parsed = []
    for path in glob.glob(folder + "/w/part-*"):
        data = open(path, "rb").read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            parsed.append((fields[b"WARC-Type"], fields.get(b"WARC-Refers-To"), rest[:size]))
            data = rest[size + 4 :]
    assert Counter(t for t, _, _ in parsed) == {b"response": 2, b"metadata": 2, b"conversion": 2}
    assert "T é\none\ntwo & three".encode() in [block for t, _, block in parsed if t == b"conversion"]
    assert all(refers for t, refers, _ in parsed if t != b"response")


def test_pipeline_stages_keep_their_columns(spark):
    odd = spark.createDataFrame(
        [(None, None, None, 1, None, "x", 1), (1, "", "en", 0, "s", None, 2), (1, "the and of " * 30, "en", 0, "s", "a", 3)]
        + [(2, "der die das " * 5, "de", 0, None, "b", 4)] * 2,
        "doc_id long, text string, lang string, n_chars long, source string, fingerprint string, spans int",
    )
    for docs in (odd, odd.limit(0), spark.read.parquet(f"{SF}/documents.parquet")):
        for name, stage in corpus_pipeline.STAGES:
            after = saved(stage(spark, docs, SF), name)
            assert after.count() <= docs.count() or name == "packing"
            assert name == "packing" or after.dtypes == docs.dtypes
            docs = after
