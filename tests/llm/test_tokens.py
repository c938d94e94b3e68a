"""Token ids and counts against the library, over letters of all scripts."""

import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from oreflow.llm import languages, tokens
from oreflow.llm.queries import VOCABULARY

#: Letters that lower-casing or composing turns into several characters or none, marks, and spaces.
ODD = [*"\u0130\u0131\u017f\u0149\u01f0\u0390\u03a3\u03c2\u00df\u1e9e\ufb05\ufb01\u0958\u095c\ufb1d\ufb1f\ufb2a\u2126\u212b"]
ODD += [*"\u0307\u0301\u0338\u0331\u00a0\u3000\u200b\uac00\u1100\u1161H"]
LETTERS = [chr(c) for c in range(0x80, 0x3400) if unicodedata.category(chr(c))[0] in "LMN"]


def made(source):
    letters = source.choice([ODD + [*"abIS"], source.sample(LETTERS, 6) + [*"aZ"], [*"abcXYZ.,'!?"] + ODD, [*"ab.,!'s<|>-="]])
    words = ["".join(source.choices(letters, k=source.randrange(1, 7))) for _ in range(source.randrange(8))]
    if source.random() < 0.05:
        words.append("<|endoftext|>" + source.choice(["", ".", "x", "!"]))
    return source.choice([" ", "\n", "  "]).join(words)


def test_ids_are_the_library_s():
    path = tokens.vocabulary(VOCABULARY)
    library, source = Tokenizer.from_file(path), random.Random(5)
    words = tokens.Words(path)
    for number in range(200):
        texts = ["", *[made(source) for _ in range(60)]]
        if number % 50 == 0:
            words = tokens.Words(path)
        ids, counts = words.encode_all(pa.array(texts))
        theirs = [row.ids for row in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(t) for t in theirs]
        assert ids.tolist() == [i for t in theirs for i in t]
        assert words.count_all(pa.array(texts)).tolist() == counts.tolist()


@pytest.mark.parametrize("first", ["\u0130stanbul g\u00fczel bir \u015fehir", "\u0958\u0932\u092e", "\ufb2a xyz"])
def test_no_text_changes_the_ids_of_later_ones(first):
    path = tokens.vocabulary(VOCABULARY)
    library, words = Tokenizer.from_file(path), tokens.Words(path)
    for text in (first, "g\u00fczel \u015fehir", "yak bir xyz."):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_kept_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 10)
    path = tokens.vocabulary(VOCABULARY)
    words, library = tokens.Words(path), Tokenizer.from_file(path)
    for text in ("a bb ccc dddd eeeee f g h i j k", "x" * 5000 + " l m n", "o p q a bb", "r s t " + "y" * 100 + "."):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(words.kept.words) < 20


def test_counts_have_clashing_names_and_huge_texts(spark):
    path = tokens.vocabulary(VOCABULARY)
    texts = [None, "", "a. b", "word, and " * 40_000, "x" * 20_000]
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "n_bytes int, text string, n_tokens string")
    library = Tokenizer.from_file(path)
    rows = tokens.counted(docs.withColumnRenamed("n_bytes", "i"), path).collect()
    for r in rows:
        text = texts[r["i"]] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))


def test_copies_do_not_fill_the_language_sample(spark):
    copies = [(i, "the same text again", "en") for i in range(2000)]
    rows = copies + [(5000 + i, f"text number {chr(97 + i % 26) * (i // 26 + 1)}", "en") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    sample = languages._sample(docs, "text", "lang").collect()
    assert len({r["hash"] for r in sample}) == languages.TEXTS_PER_LANGUAGE
    assert len(sample) == languages.TEXTS_PER_LANGUAGE * languages.WINDOWS_PER_TEXT
