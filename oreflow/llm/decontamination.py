"""Benchmark decontamination by BM25 over an inverted index of test items.

Every passage of every training text is a query. An item's score is the share of its own
BM25 weight that the passage's words hold (1 if all of its words are there). The index holds
a posting list for each word, its items in order, cut at fixed blocks of items, with the
largest weight of the whole list and of each block. Retrieval returns every item at or above
``THRESHOLD`` and skips the others by upper bounds, as in block-max WAND: a passage is passed
over if the largest weights of its words' lists do not reach the threshold, a block of items
if the largest weights of its blocks do not, and only postings of blocks that are left are
read and added up. The bounds are computed for many passages at a time, so there is no cursor
that moves from pivot to pivot.

A retrieved item must be verified: of the words of its question, and of those of its answer,
the passage must hold the share ``OVERLAP``. The answer is an item's last sentence, or the
last third of its words if it has one sentence; the question is what comes before.

Passages are windows of twice the longest item, every such length, so that each place where
an item could stand lies whole in a window. Items are grouped by their length to powers of
two, each group with its own windows. The index is built for parts of at most about
``ITEM_BYTES`` of items. If there are several, the texts are searched with one after the
other: the matches so far are written before the next index is built, so the driver and the
executors hold one at a time, whatever the number of items.
"""

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import blank_text, packed_rows, quoted, saved, unpacked_rows

K1, B = 1.2, 0.75
THRESHOLD = 0.7
OVERLAP = 0.8
#: Text of the items of one index.
ITEM_BYTES = 4 << 20
#: Items of a block with an upper bound of its own.
BLOCK = 16
#: Postings and block bounds that are added up together.
_AT_ONCE = 1 << 18
#: Items of fewer words share one group.
SHORT = 8
#: Characters of the texts that are searched together.
_TEXT_AT_ONCE = 1 << 18
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def _letter_table() -> bytes:
    """ASCII letters in lower case, digits and bytes beyond ASCII as they are, else a space."""
    keep = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(128)) + bytes(range(128, 256))
    return keep.lower()


_LETTERS = _letter_table()
#: The same words as a pattern for Spark.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LETTERS).split()


def question_and_answer(text: str | None) -> tuple[set[bytes], set[bytes]]:
    """The distinct words of an item's question and of its answer."""
    sentences = [s for s in _SENTENCE_END.split(text or "") if words_of(s)]
    words = words_of(text)
    cut = len(words) - (len(words_of(sentences[-1])) if len(sentences) > 1 else -(-len(words) // 3))
    return set(words[:cut]), set(words[cut:])


@dataclass
class _Lists:
    """Posting lists of all words, one after the other: word ``w`` has the entries ``begins[w]`` to ``begins[w + 1]``."""

    begins: np.ndarray
    places: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, words: np.ndarray, places: np.ndarray, weights: np.ndarray, count: int) -> "_Lists":
        """From entries ordered by word, then place."""
        return cls(np.searchsorted(words, np.arange(count + 1)), places, weights)

    def entries(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry of the lists of ``words`` the number of its word among them, and the entry."""
        sizes = self.begins[words + 1] - self.begins[words]
        owner = np.repeat(np.arange(len(words)), sizes)
        return owner, np.arange(len(owner)) + np.repeat(self.begins[words] - np.cumsum(sizes) + sizes, sizes)


@dataclass
class _Group:
    """The index of the items of similar length; items are numbered in their order.

    Words have the group's own numbers, the last being all words that it does not have.
    ``bound`` is the largest weight in each word's list, ``blocks`` has it by block of items,
    and ``postings`` has the weights by word and block, then item.
    """

    stride: int = 1
    items: list[int] = field(default_factory=list)
    found: list[tuple[int, int, float]] = field(default_factory=list)
    numbers: np.ndarray | None = None
    bound: np.ndarray | None = None
    blocks: _Lists | None = None
    postings: _Lists | None = None

    def add(self, item: int, size: int, weights: dict[int, float]) -> None:
        self.found += [(term, len(self.items), weight) for term, weight in weights.items()]
        self.items.append(item)
        self.stride = max(self.stride, size)

    def finish(self, terms: int) -> None:
        """Turn what was added into posting lists and bounds."""
        self.found.sort()
        term, place, weight = (np.array(c) for c in zip(*self.found, strict=True))
        self.found = []
        used, word = np.unique(term, return_inverse=True)
        self.numbers = np.full(terms + 1, len(used))
        self.numbers[used] = np.arange(len(used))
        self.bound = np.append(np.maximum.reduceat(weight, np.flatnonzero(np.diff(word, prepend=-1))), 0.0)
        count = -(-len(self.items) // BLOCK)
        new = np.flatnonzero(np.diff(word * count + place // BLOCK, prepend=-1))
        self.blocks = _Lists.of(word[new], place[new] // BLOCK, np.maximum.reduceat(weight, new), len(used) + 1)
        # One list of postings for each block that a word has.
        self.postings = _Lists(np.append(new, len(place)), place, weight)


class Index:
    """An inverted index of items, ``frequency`` being the items with a word among ``count``."""

    def __init__(self, items: list[tuple], frequency: dict[bytes, int], count: int, mean: float):
        self.ids = [item for item, _ in items]
        self.parts = [question_and_answer(text) for _, text in items]
        self.terms: dict[bytes, int] = {}
        groups: dict[int, _Group] = {}
        for number, (_, text) in enumerate(items):
            words = words_of(text)
            if not words:
                continue
            level = max(SHORT, 1 << (len(words) - 1).bit_length())
            group = groups.setdefault(level, _Group())
            norm = K1 * (1 - B + B * len(words) / mean)
            own = {}
            for word, times in Counter(words).items():
                df = frequency.get(word, 1)
                idf = np.log1p((count - df + 0.5) / (df + 0.5))
                term = self.terms.setdefault(word, len(self.terms))
                own[term] = idf * times * (K1 + 1) / (times + norm)
            total = sum(own.values())
            group.add(number, len(words), {term: weight / total for term, weight in own.items()})
        self.groups = [groups[level] for level in sorted(groups)]
        for group in self.groups:
            group.finish(len(self.terms))

    def _retrieved(self, group: _Group, terms: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """(document, first word, place of the item, score) of every item that reaches the threshold in a passage."""
        own = group.numbers[terms]
        chunks = -(-sizes // group.stride)
        firsts = np.cumsum(chunks) - chunks
        doc = np.repeat(np.arange(len(sizes)), sizes)
        chunk = firsts[doc] + (np.arange(len(terms)) - starts[doc]) // group.stride
        total = int(chunks.sum())
        ends_doc = np.zeros(total, bool)
        ends_doc[(firsts + chunks - 1)[chunks > 0]] = True
        least = np.float32(THRESHOLD - 1e-4)  # rounding must not hide a passage
        sums = np.bincount(chunk, group.bound[own], total)
        following = np.append(sums[1:], 0.0)
        likely = sums + np.where(ends_doc, 0.0, following) >= least
        # Each word counts for the passage that its chunk begins, and for the one before.
        known = own < len(group.bound) - 1
        chunk, own = chunk[known], own[known]
        before = chunk - 1
        second = (before >= 0) & ~ends_doc[before] & likely[before]
        first = likely[chunk]
        size = len(group.bound)
        keys = np.concatenate((chunk[first] * size + own[first], before[second] * size + own[second]))
        keys = np.unique(keys)
        if not len(keys):
            return
        passage, word = keys // size, keys % size
        begins = np.flatnonzero(np.diff(passage, prepend=-1))
        reaches = np.add.reduceat(group.bound[word], begins) >= least
        counts = np.diff(begins, append=len(keys))
        word = word[np.repeat(reaches, counts)]
        passage, counts = passage[begins[reaches]], counts[reaches]
        owners = np.repeat(np.arange(len(sizes)), chunks)
        ends = np.cumsum(counts)
        # Passages are taken together until the entries of their words' block lists fill the work memory.
        work = np.cumsum(np.diff(group.blocks.begins)[word])
        low = 0
        while low < len(passage):
            done = work[ends[low - 1] - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(work[ends - 1], done + _AT_ONCE, "right")))
            inner = np.repeat(np.arange(high - low), counts[low:high])
            for at, place, score in _reaching(group, inner, word[ends[low] - counts[low] : ends[high - 1]], least):
                p = passage[low + at]
                yield int(owners[p]), int(p - firsts[owners[p]]) * group.stride, place, score
            low = high

    def matches(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text (item, score, question, answer) of its verified items, the best passage of each."""
        words = [words_of(t) for t in texts]
        best: list[dict[int, tuple]] = [{} for _ in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        find, other = self.terms.get, len(self.terms)
        terms = np.array([find(w, other) for ws in words for w in ws], np.int64)
        starts = np.cumsum(sizes) - sizes
        for group in self.groups if len(terms) else ():
            for doc, begin, place, score in self._retrieved(group, terms, starts, sizes):
                if score < THRESHOLD:
                    continue
                present = set(words[doc][begin : begin + 2 * group.stride])
                item = group.items[place]
                shares = [len(p & present) / len(p) if p else 1.0 for p in self.parts[item]]
                if min(shares) >= OVERLAP:
                    found = (min(1.0, score), *shares)
                    best[doc][item] = max(best[doc].get(item, found), found)
        return [[(self.ids[i], *found[i]) for i in sorted(found)] for found in best]


def _sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, the sum of each one's weights, and which of them each key is."""
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, weights, len(distinct)), at


def _reaching(group: _Group, passage: np.ndarray, word: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
    """(passage, place, score) of the items that reach ``least``, of (passage, word) pairs without repeats."""
    owner, entry = group.blocks.entries(word)
    count, block = -(-len(group.items) // BLOCK), group.blocks.places[entry]
    _, bounds, at = _sums(passage[owner] * count + block, group.blocks.weights[entry])
    left = bounds[at] >= least
    owner, entry = owner[left], entry[left]
    of, posting = group.postings.entries(entry)
    keys = passage[owner[of]] * len(group.items) + group.postings.places[posting]
    keys, scores, _ = _sums(keys, group.postings.weights[posting])
    for key, score in zip(keys[scores >= least].tolist(), scores[scores >= least].tolist(), strict=True):
        yield *divmod(key, len(group.items)), score


def _indexes(benchmark: DataFrame, id: str, text: str) -> Iterator[bytes]:
    """Pickled indexes of parts of the items, each built when it is asked for, with word statistics over all items."""
    items = benchmark.select(F.col(quoted(id)).alias("item"), blank_text(text).alias("text"))
    items = saved(items, "benchmark")
    words = F.array_distinct(
        F.transform(F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)), _ascii_lower)
    )
    size = F.size(F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)))
    count, mean, total = items.agg(
        F.count("*"), F.avg(size), F.sum(F.octet_length("text").cast("long"))
    ).head()
    if not count or not mean:
        return
    frequency = items.select(F.explode(words).alias("word")).groupBy("word").count()
    blocks = -(-total // ITEM_BYTES)
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for block in range(blocks):
        part = numbered.where(F.col("block") == block)
        known = part.select(F.explode(words).alias("word")).distinct()
        found = frequency.join(known, "word", "left_semi").collect()
        rows = sorted(
            ((r["item"], r["text"]) for r in part.collect()), key=lambda r: (str(r[0]), r[1])
        )
        yield cloudpickle.dumps(Index(rows, {r["word"].encode(): r["count"] for r in found}, count, mean))


def _ascii_lower(word: F.Column) -> F.Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(word, upper, upper.lower())


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``_TEXT_AT_ONCE`` characters."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= _TEXT_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


def _searching(sent: Broadcast, kind: T.ArrayType):
    """The function that searches texts with an index that was sent to the executors."""

    @F.pandas_udf(kind)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, names = pickle.loads(sent.value), ("item", "score", "question", "answer")
        for texts in batches:
            rows: list = []
            for part in _parts(texts.tolist()):
                rows += [[dict(zip(names, m, strict=True)) for m in ms] for ms in index.matches(part)]
            yield pd.Series(rows, dtype=object)

    return search


def with_matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with ``matches``, an array of (item, score, question, answer); replaces that name.

    Empty where a text holds no item. Null and empty texts and items match nothing; repeated
    items match each for itself; rows are searched one by one and whole. ``score`` is the
    share of the item's BM25 weight, ``question`` and ``answer`` are the shares of its words
    that the best passage holds.
    """
    kind = T.ArrayType(
        T.StructType(
            [T.StructField("item", benchmark.schema[item_id].dataType)]
            + [T.StructField(n, T.DoubleType()) for n in ("score", "question", "answer")]
        )
    )
    context = docs.sparkSession.sparkContext
    found, sent = "\u0001matches", None
    rows = docs.withColumn(found, F.array().cast(kind))
    for pickled in _indexes(benchmark, item_id, item_text):
        if sent is not None:
            rows = saved(rows, "searched")
            sent.destroy()
        sent = context.broadcast(pickled)
        rows = rows.withColumn(found, F.concat(found, _searching(sent, kind)(blank_text(text))))
    return rows.withColumn("matches", F.col(found)).drop(found)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """(``id``, ``item_id``, score, question_overlap, answer_overlap): every text that holds an item."""
    rows = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).alias("text"))
    rows = with_matches(rows, benchmark, item_id=item_id).select("id", F.explode("matches").alias("m"))
    return rows.select(
        F.col("id").alias(id),
        F.col("m.item").alias(item_id),
        F.col("m.score").alias("score"),
        F.col("m.question").alias("question_overlap"),
        F.col("m.answer").alias("answer_overlap"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the texts that hold an item of ``benchmark``."""
    kept = with_matches(packed_rows(docs, text), benchmark).where(F.size("matches") == 0)
    return unpacked_rows(kept, docs, text)
