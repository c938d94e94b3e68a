"""Token ids and token counts of whole texts with a tokenizer that drops white space.

Such a tokenizer (a ``tokenizers`` file whose tokens never span white space, as its words
end at it) reads a text as its white-space separated words, one after the other. So words
are encoded once per process and kept while they are few. What the ids of a word are is
proven before it is kept: it is encoded by itself, or among words of letters that have one
end-of-word token each.

A huge text is counted in overlapping chunks that are encoded with offsets. Two chunks are
spliced at a boundary that is proven stable: both encodings end a token before the same
white space and start one after it, and they agree on all tokens between the first and last
white space that they share. If there is no such boundary the overlap is widened, at last to
the whole chunk, and then the chunk itself.
"""

import json
import os
import re
import sys
import threading
import types
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import blank_text, slices_of

#: Texts of more characters are counted in chunks of so many, which overlap by so many.
CHUNK = 1 << 14
OVERLAP = 1 << 8
#: About how many words a process keeps, and the longest that is kept; others are encoded anew.
KEPT_WORDS = 1_000_000
KEPT_LETTERS = 48
#: Seconds for which they are kept after a task.
KEPT_SECONDS = 30.0
#: Bytes of text whose words are told apart at once.
SLICE = 1 << 23
_STORE = "_words_by_tokenizer"
_TAIL = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")


def vocabulary(file: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(file)


def drops_white_space(path: str) -> bool:
    """Whether a tokenizer's pre-tokenizer removes what lies between its words."""
    with open(path, encoding="utf-8") as file:
        steps = json.load(file).get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    return first.get("behavior") == "Removed" and "\\s" in str(first.get("pattern"))


class _Kept:
    """Words and their ids in a few arrays, a tenth of what a dictionary of them takes."""

    def __init__(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray):
        self.words, self.sizes, self.ids = words, sizes, ids
        self.starts = np.cumsum(sizes) - sizes

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 if it is not here."""
        return pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()

    def ids_at(self, at: int) -> bytes:
        return self.ids[self.starts[at] : self.starts[at] + self.sizes[at]].tobytes()

    def plus(self, words: list[str], ids: list[bytes]) -> "_Kept":
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return _Kept(
            pa.concat_arrays([self.words, pa.array(words, pa.string())]),
            np.concatenate([self.sizes, sizes]),
            np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")]),
        )


class Words:
    """A tokenizer with the ids of the words it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not drops_white_space(path):
            raise ValueError("the tokenizer keeps white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kept = _Kept(pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, "<u4"))
        tokens = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(tokens.values()) + 1, bool)
        self.ends_word[[at for token, at in tokens.items() if token.endswith("</w>")]] = True

    @staticmethod
    def of(path: str) -> "Words":
        """The one of this process: tasks that follow one another share what it has met."""
        store = sys.modules.setdefault(_STORE, types.ModuleType(_STORE)).__dict__
        return store.get(path) or store.setdefault(path, Words(path))

    @staticmethod
    @contextmanager
    def shared(path: str) -> Iterator["Words"]:
        """``of`` for one task. Some seconds after the last task it is dropped, so that later
        work has its memory."""
        words, store = Words.of(path), sys.modules[_STORE].__dict__
        if "timer" in store:
            store["timer"].cancel()
        store[path] = words
        try:
            yield words
        finally:
            store["timer"] = threading.Timer(KEPT_SECONDS, Words._drop, [path])
            store["timer"].daemon = True
            store["timer"].start()

    @staticmethod
    def _drop(path: str) -> None:
        sys.modules[_STORE].__dict__.pop(path, None)
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as unsigned 32-bit integers."""
        return self.encode_all(pa.array([text]))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, one after the other, and the number of each text's ids."""
        words, places, counts = self._looked_up(texts)
        sizes = words.sizes[places]
        at = np.repeat(words.starts[places] - (np.cumsum(sizes) - sizes), sizes)
        return words.ids[at + np.arange(len(at))], counts

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        return self._looked_up(texts)[-1]

    def _looked_up(self, texts: pa.Array) -> tuple[_Kept, np.ndarray, np.ndarray]:
        """All different words of ``texts``, the places of the texts' words among these, and
        the number of each text's ids."""
        # As the tokenizer does; not where it reads special tokens.
        plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        words = pc.ascii_split_whitespace(pc.if_else(plain, pc.ascii_lower(texts), texts))
        of_text = words.value_lengths().to_numpy()
        found = words.flatten().dictionary_encode()
        known, places = self._known(found.dictionary)
        places = places[found.indices.to_numpy()]
        sums = np.concatenate([[0], np.cumsum(known.sizes[places])])
        ends = np.cumsum(of_text)
        return known, places, sums[ends] - sums[ends - of_text]

    def _known(self, words: pa.Array) -> tuple[_Kept, np.ndarray]:
        """What is kept and the words that are not, and the places of all of ``words`` in it."""
        known, places = self.kept, self.kept.find(words)
        missing = places < 0
        if missing.any():
            new = words.filter(pa.array(missing)).to_pylist()
            ids = self._ids_of(new)
            places = np.where(missing, len(known.words) + np.cumsum(missing) - 1, places)
            if len(known.words) < KEPT_WORDS:
                short = [at for at, word in enumerate(new) if len(word) <= KEPT_LETTERS]
                self.kept = known.plus([new[at] for at in short], [ids[at] for at in short])
            known = known.plus(new, ids)
        return known, places

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of different words that are not kept.

        Punctuation after a word's last letter is a word of its own to the tokenizer, so such
        words are made of two. What is new is encoded in one call.
        """
        parts = []
        for word in words:
            stem = word.rstrip(_TAIL)
            two = stem != word and _ends_as_letter(stem, word)
            parts.append((stem, word[len(stem) :]) if two else (word,))
        different = list({part for pair in parts for part in pair})
        places = self.kept.find(pa.array(different, pa.string()))
        ids = self._encode_words([w for w, at in zip(different, places, strict=True) if at < 0])
        ids.update((w, self.kept.ids_at(at)) for w, at in zip(different, places, strict=True) if at >= 0)
        return [b"".join([ids[part] for part in pair]) for pair in parts]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words that are not kept.

        Words that are letters to the tokenizer too are encoded as one text and told apart by
        the end-of-word tokens, if these are as many as the words: each has one at least, so
        then each has one. Other words are encoded one by one.
        """
        kinds = [_letters(word) for word in words]
        letters = [word for word, plain in zip(words, kinds, strict=True) if plain]
        others = [word for word, plain in zip(words, kinds, strict=True) if not plain]
        ids, ends = self._joined(letters)
        if len(ends) != len(letters):
            letters, others, (ids, ends) = [], words, self._joined([])
        rows = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        data = ids.tobytes()
        cuts = zip(letters, [0, *ends[:-1]], ends, strict=True) if letters else ()
        found = {word: data[4 * begin : 4 * end] for word, begin, end in cuts}
        found.update((word, np.array(row.ids, "<u4").tobytes()) for word, row in zip(others, rows, strict=True))
        return found

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of some words as one text, and after which of them words end."""
        row = self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0]
        ids = np.array(row.ids, "<u4")
        return ids, (np.flatnonzero(self.ends_word[ids]) + 1).tolist()


def _letters(text: str) -> bool:
    """Whether a word is still nothing but letters once it is composed and lower-cased."""
    return text.isalpha() if text.isascii() else unicodedata.normalize("NFC", text).lower().isalpha()


def _ends_as_letter(stem: str, word: str) -> bool:
    """Whether what follows ``stem`` in ``word``, ASCII punctuation, begins a new word to the tokenizer."""
    if "<|" in word:  # may begin a special token
        return False
    return stem[-1:].isalnum() if stem.isascii() else _letters(stem)


def _encoded(tokenizer, text: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a chunk, and where in the text each token begins and ends."""
    found = tokenizer.encode(text[begin:end], add_special_tokens=False)
    places = np.array(found.offsets, np.int64).reshape(-1, 2) + begin
    return np.array(found.ids, np.int64), places[:, 0], places[:, 1]


def _splice(left, right, text: str, begin: int, end: int) -> int | None:
    """A stable boundary of two encodings in their overlap, or None."""
    spaces = [m.start() for m in _SPACE.finditer(text, begin, end)]
    if not spaces:
        return None
    first, last = spaces[0], spaces[-1]
    shared = []
    for ids, begins, ends in (left, right):
        inside = (begins > first) & (ends <= last)
        shared.append((ids[inside], begins[inside], ends[inside]))
        if ((begins <= last) & (ends > last)).any() or ((begins <= first) & (ends > first)).any():
            return None
    agree = all(np.array_equal(a, b) for a, b in zip(*shared, strict=True))
    return last if agree else None


def spliced_count(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of ``text``, from overlapping chunks."""
    count, cut, begin = 0, 0, 0
    end = min(len(text), chunk)
    left = _encoded(tokenizer, text, begin, end)
    while end < len(text):
        width, boundary = overlap, None
        reach = min(len(text), end + chunk)
        while boundary is None:
            start = max(cut, end - width)
            right = _encoded(tokenizer, text, start, reach)
            boundary = _splice(left, right, text, start, end)
            if boundary is None and start == cut:
                break
            width *= 2
        if boundary is None:  # one word so far: the chunk takes in the next one
            left, end = right, reach
            continue
        count += int(((left[1] >= cut) & (left[2] <= boundary)).sum())
        cut, end, left = boundary, reach, right
    return count + int((left[1] >= cut).sum())


def _counts(words: Words, texts: pa.Array) -> np.ndarray:
    """The number of tokens of each text; huge texts are counted in chunks."""
    huge = pc.greater(pc.utf8_length(texts), CHUNK)
    counts = words.count_all(pc.if_else(huge, "", texts))
    for at in np.flatnonzero(huge.to_numpy(zero_copy_only=False)):
        counts[at] = spliced_count(words.tokenizer, texts[at].as_py())
    return counts


def counted(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (of the text in UTF-8) and ``n_tokens``; these names are replaced.

    ``path`` is a ``tokenizers`` file that every executor has. The counts are those of the
    library over the whole text, without special tokens added, truncation or padding. A
    null text is empty and has none. Each row is counted by itself.
    """
    if not drops_white_space(path):
        raise ValueError("the tokenizer keeps white space")

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with Words.shared(path) as words:
            for series in batches:
                rows = pa.RecordBatch.from_arrays([pa.array(series, pa.string())], names=["text"])
                counts = [_counts(words, part.column(0)) for part in slices_of(rows, 0, SLICE)]
                yield pd.Series(np.concatenate([np.zeros(0, np.int64), *counts]))

    return docs.withColumns(
        {
            "\u0001bytes": F.octet_length(blank_text(text)).cast("long"),
            "\u0001tokens": count(blank_text(text)),
        }
    ).withColumns({"n_bytes": F.col("\u0001bytes"), "n_tokens": F.col("\u0001tokens")}).drop(
        "\u0001bytes", "\u0001tokens"
    )
