"""The corpus operators on small texts, against brute force."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from oreflow.llm import decontamination, languages, quality_forest, queries, repeats, simhash, suffixes, tokens
from oreflow.llm.components import components
from oreflow.llm.licences import with_licences

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints):
    """The least number reachable over links of at most three bits."""
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(fingerprints):
        for j in range(i):
            if (a ^ fingerprints[j]).bit_count() <= 3:
                a_root, b_root = find(i), find(j)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return [find(i) for i in range(len(fingerprints))]


def test_simhash_query_matches_brute_force(spark, texts):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op1_simhash(spark, SF).collect()}
    texts = sorted(texts)
    prints = [plain_fingerprint(t) for _, t in texts]
    roots = plain_components(prints)
    assert got == {
        d: (f"{p:016x}", texts[r][0]) for (d, _), p, r in zip(texts, prints, roots, strict=True)
    }


@pytest.mark.parametrize("short, sublist", [(64, 2048), (8, 10), (4, 10_000), (10_000, 1)])
def test_links_connect_what_lies_within_three_bits(spark, monkeypatch, short, sublist):
    monkeypatch.setattr(simhash, "SHORT_LIST", short)
    monkeypatch.setattr(simhash, "SHORT_SUBLIST", sublist)
    chance = random.Random(3)
    values = [chance.getrandbits(63) for _ in range(60)]
    for value in values[:4]:
        for _ in range(60):
            for bit in chance.sample(range(63), chance.randint(1, 3)):
                value ^= 1 << bit
            values.append(value)
    values = sorted(set(values))
    rows = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.linked_fingerprints(rows), "t").collect()}
    expected = [values[r] for r in plain_components(values)]
    assert [got.get(v, v) for v in values] == expected


def test_near_duplicates_keep_one_row(spark):
    rows = [(5, "a b c d"), (3, "A b  C d"), (None, None), (9, ""), (7, "q r s t"), (7, "q r s t")]
    kept = simhash.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(3, "A b  C d"), (7, "q r s t"), (9, "")]
    assert simhash.drop_near_duplicates(frame(spark, [])).count() == 0


def test_suffix_arrays_and_prefixes():
    chance = random.Random(1)
    for _ in range(300):
        most = chance.choice([1, 2, 3, 250])
        data = bytes(chance.randint(0, most) for _ in range(chance.randint(1, 50)))
        data = data[:7] * chance.randint(1, 5) + data
        symbols = np.frombuffer(data, np.uint8)
        order = suffixes.suffix_array(symbols)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        shared = suffixes.common_prefixes(symbols, order, 20)
        for before, at in zip(order, order[1:], strict=False):
            same = 0
            while same < 20 and max(before, at) + same < len(data) and data[before + same] == data[at + same]:
                same += 1
            assert shared[at] == same


def plain_removed(texts, window=repeats.WINDOW):
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    for t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                covered[i : i + window] = b"\1" * window
        yield covered


@pytest.mark.parametrize("crowded", [repeats.CROWDED, 3])
def test_repeats_match_brute_force(spark, texts, monkeypatch, crowded):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    long = texts[0][1][:900]
    rows = texts[:80] + [(1000, None), (1001, ""), (1002, "ab" * 400), (1003, "a" * 700), (None, long)]
    rows += [(1004, "é" * 300 + long[:450]), (1005, long[200:] + "x"), (1006, long), (1006, long)]
    got = repeats.without_repeats(frame(spark, rows)).collect()
    data = [(t or "").encode() for _, t in rows]
    expected = Counter(
        (d, bytes(b for b, c in zip(t, covered, strict=True) if not c), len(t))
        for (d, _), t, covered in zip(rows, data, plain_removed(data), strict=True)
    )
    assert Counter((r["doc_id"], bytes(r["kept"]), r["n_bytes"]) for r in got) == expected
    assert repeats.without_repeats(frame(spark, [])).count() == 0


def test_decontamination_finds_whole_items(spark, texts):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    spaced = lambda t: b" " + b" ".join(decontamination.words_of(t)) + b" "
    expected = {(d, i) for d, t in texts for i, item in items if spaced(item) in spaced(t)}
    planted = frame(spark, [(9001, "so. " + items[0][1].upper() + " end"), (9002, None), (None, "")])
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = queries.op2_decontamination(spark, SF).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    assert {r["doc_id"] for r in decontamination.contaminated(planted, bench).collect()} == {9001}
    assert decontamination.drop_contaminated(planted, bench).count() == 2
    assert decontamination.contaminated(planted, bench.limit(0)).count() == 0


def test_language_is_learned_from_the_other_documents(spark):
    rows = queries.op8_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    right = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0]
    assert right > 0.97 and rows.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_texts(spark):
    rows = [(None, None, None), (1, "", "en"), (2, "12 3!", "en"), (3, "abc", "fr"), (3, "abc", "fr")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for model in (None, languages.train_on(odd)):
        found = [(r["text"], r["lang_pred"]) for r in languages.predicted(model, odd).collect()]
        assert all(lang == "und" for text, lang in found if text != "abc")
    assert languages.keep_identified(odd.limit(0)).count() == 0


def test_counts_are_those_of_the_library(spark):
    path = tokens.vocabulary(queries.VOCABULARY)
    tokenizer = tokens.Words(path).tokenizer
    chance = random.Random(3)
    signs = ["a", "é", " ", "\n", "<|endoftext|>", "Bc", "'s", "1", ".", "　", "́", ","]
    for _ in range(200):
        text = "".join(chance.choice(signs) for _ in range(chance.randint(0, 200)))
        count = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert tokens.spliced_count(tokenizer, text, chance.randint(1, 30), chance.randint(1, 9)) == count
        assert len(tokens.Words.of(path).encode(text)) == 4 * count
    rows = [(1, None), (2, ""), (3, "word. " * 9000), (4, "x" * 40_000), (None, "<|ENDOFTEXT|> a")]
    for r in tokens.counted(frame(spark, rows), path).collect():
        assert r["n_tokens"] == len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
        assert r["n_bytes"] == len((r["text"] or "").encode())


def plain_statistics(text):
    words, grams = WORDS.findall(text or ""), Counter()
    for i in range(len(words) - 4):
        grams[tuple(words[i : i + 5])] += 1
    covered = {
        j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)
    }
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            repeated += line in seen
            seen.add(line)
    signs = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), signs, repeated, len(covered)


def test_quality_statistics_and_rules(spark, texts):
    for text in [None, "", "a b c d e a b c d e f", "a a a a a a a", "l\nl\n \nl", "\x1cx \x85y"]:
        assert quality_forest.statistics(text)[:5] == plain_statistics(text)
    by_id = dict(texts)
    for r in queries.op10_quality(spark, SF).collect():
        values = plain_statistics(by_id[r["doc_id"]])
        assert tuple(r)[1:6] == values
        assert r["base_failed"] == (values[0] < 10 or 100 * values[4] > 20 * values[0])
        assert not (r["kept"] and r["base_failed"])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_forest.judged(frame(spark, [(None, None), (1, "a")]), labels).where("kept").count() == 0
    assert quality_forest.judged(frame(spark, []), labels).count() == 0


def test_licences_of_odd_texts(spark):
    rows = [(None, None), (1, ""), (2, "CC  BY\ncc-by cc K by aLL rights reserved"), (2, "x")]
    got = [tuple(r)[2:7] for r in with_licences(frame(spark, rows)).collect()]
    assert got[2] == (10, 3, 0, 7, "cc-by,reserved")
    assert [g[:2] for g in got[:2]] == [(0, 0), (0, 0)] and got[3] == (1, 0, None, None, "")
