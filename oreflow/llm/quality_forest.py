"""Quality rules on whole texts, and an isolation forest on their statistics.

A tree splits a small sample at random statistics and values until its rows are alone; a row
that is alone early is unlike the others. The mean depth over all trees gives a score, 1 for
the most anomalous. The threshold comes from all labelled rows: it is the score at which the
share of bad texts above it exceeds the share of good texts above it by most.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import blank_text, quoted, saved

LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
GRAM = 5
SYMBOLS = "#*$%&|<>"
#: The forest: trees, rows of a tree's sample; together the bound of the rows that it learns from.
TREES = 100
TREE_ROWS = 256
#: The bins of scores whose labels are counted for the threshold.
BINS = 10_000
#: The share of good labelled texts that may score above the threshold, if none is labelled bad.
LOST = 0.005
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_letters")
_EULER = 0.5772156649015329
# Bytes that are part of a letter, or white space: what is left are other signs.
_LETTERS = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha() or c in b" \t\n\r\x0b\x0c")


def statistics(text: str | None) -> tuple[int, ...]:
    """The values of ``STATISTICS`` for a text.

    Words are what lies between ASCII white space; a line is equal to an earlier one byte by
    byte and counts if it has a word; repeated words lie in windows of five words that occur
    twice or more. ``n_letters`` counts ASCII letters and all characters beyond ASCII.
    """
    text = text or ""
    words = text.encode().split()
    if not words:
        return (0,) * len(STATISTICS)
    lines = [line for line in text.split("\n") if line.encode().split()]
    grams = list(zip(*(words[i:] for i in range(GRAM)), strict=False))
    repeated = 0
    if len(set(grams)) < len(grams):
        times, end = Counter(grams), 0
        for at, gram in enumerate(grams):
            if times[gram] > 1:
                repeated += at + GRAM - max(at, end)
                end = at + GRAM
    blank = sum(map(text.count, " \t\n\r\x0b\x0c"))
    return (
        len(words),
        len(text) - blank,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        len(set(words)),
        len(text) - blank - len(text.encode().translate(None, _LETTERS)),
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``stats``, a struct of ``STATISTICS`` as longs; a null text has none."""

    @F.pandas_udf(", ".join(f"{name} long" for name in STATISTICS))
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype="int64")

    return docs.withColumn("stats", count(blank_text(text)))


def features(stats: np.ndarray) -> np.ndarray:
    """What the forest sees: sizes as logarithms, the rest as shares."""
    words, chars, symbols, dups, repeats, lines, distinct, letters = stats.astype(float).T
    some, all_chars = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack(
        [
            np.log1p(words),
            chars / some,
            symbols / some,
            dups / np.maximum(lines, 1),
            repeats / some,
            np.log1p(words / np.maximum(lines, 1)),
            distinct / some,
            letters / all_chars,
        ],
        axis=1,
    )


def _mean_depth(rows: np.ndarray) -> np.ndarray:
    """The mean depth of an unsuccessful search in a random tree of so many rows."""
    rows = np.asarray(rows, float)
    many = np.maximum(rows, 2.0)
    depth = 2 * (np.log(many - 1) + _EULER) - 2 * (many - 1) / many
    return np.where(rows < 2, 0.0, np.where(rows == 2, 1.0, depth))


class Forest:
    """Isolation trees as arrays: feature, split, left child (the right one follows), depth."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS):
        chance = np.random.default_rng(11)
        self.size = min(tree_rows, len(rows))
        self.levels = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        self.trees = [self._grow(rows, chance) for _ in range(trees)]

    def _grow(self, rows: np.ndarray, chance: np.random.Generator) -> tuple[np.ndarray, ...]:
        sample = rows[chance.choice(len(rows), self.size, replace=False)]
        nodes = [[-1, 0.0, 0, 0.0]]
        todo = [(0, sample, 0)]
        while todo:
            node, part, level = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if level >= self.levels or len(part) < 2 or not len(usable):
                nodes[node][3] = level + float(_mean_depth(len(part)))
                continue
            feature = int(chance.choice(usable))
            split = float(chance.uniform(low[feature], high[feature]))
            below = part[:, feature] <= split
            nodes[node][:3] = [feature, split, len(nodes)]
            nodes += [[-1, 0.0, 0, 0.0], [-1, 0.0, 0, 0.0]]
            todo += [(nodes[node][2], part[below], level + 1), (nodes[node][2] + 1, part[~below], level + 1)]
        return tuple(np.array(column) for column in zip(*nodes, strict=True))

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly scores of rows, from 0 to 1."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, left, depth in self.trees:
            node = np.zeros(len(rows), int)
            for _ in range(self.levels):
                inner = feature[node] >= 0
                right = rows[every, np.maximum(feature[node], 0)] > split[node]
                node = np.where(inner, left[node] + right, node)
            total += depth[node]
        usual = max(float(_mean_depth(self.size)), 1e-9)
        return 2.0 ** (-total / len(self.trees) / usual)


def best_threshold(bins: list[tuple[float, int, int]]) -> float:
    """The threshold for (highest score, good, bad) of bins in the order of their scores.

    Of thresholds that part as well the highest is taken. Without bad texts ``LOST`` of the
    good ones may lie above it; without good ones it is 1.
    """
    all_good, all_bad = (sum(b[at] for b in bins) for at in (1, 2))
    if not all_good:
        return 1.0
    if not all_bad:
        above = 0
        for highest, good, _ in reversed(bins):
            above += good
            if above > LOST * all_good:
                return highest
    # In whole numbers: (bad above / all bad - good above / all good) * all good * all bad.
    best, threshold, lead = 0, 1.0, 0
    for before, (_, good, bad) in zip([*bins[-2::-1], (0.0, 0, 0)], bins[::-1], strict=True):
        lead += bad * all_good - good * all_bad
        if lead > best:
            best, threshold = lead, before[0]
    return threshold


def scored(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality") -> tuple[DataFrame, float]:
    """(rows, threshold): ``docs`` but its text, with ``stats``, ``base_failed`` and ``anomaly``.

    The forest learns from at most ``TREES * TREE_ROWS`` texts that pass the base rules,
    chosen by a hash of their statistics and id. The threshold is ``best_threshold`` of all
    texts that pass and are labelled good (``quality`` 1) or bad (0), counted on the executors
    by bins of their scores; at 1 no text exceeds it. Null texts are empty, and fail the base rules. A null id has no label;
    repeated rows are judged alike.
    """
    others = [quoted(c) for c in docs.columns if c.lower() not in {text.lower(), "stats", "base_failed", "anomaly"}]
    rows = with_statistics(docs.select(*others, F.col(quoted(text)).alias("\u0001text")), "\u0001text")
    rows = saved(rows.drop("\u0001text"), "quality")
    words, repeats = F.col("stats.n_words"), F.col("stats.n_repeat_words")
    rows = rows.withColumn(
        "base_failed", (words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * words)
    )
    passing = rows.where("not base_failed")
    order = F.xxhash64(quoted(id), "stats")
    chosen = passing.select("stats.*", order.alias("order"))
    # Rows of the lowest hashes, several times as many as wanted: a task sends few of its own.
    wanted = min(1.0, 4 * TREES * TREE_ROWS / max(1, passing.count()))
    chosen = chosen.where(F.col("order") <= min((1 << 63) - 1, int(wanted * (1 << 64)) - (1 << 63)))
    chosen = chosen.orderBy("order", *STATISTICS)
    sample = np.array([tuple(r)[: len(STATISTICS)] for r in chosen.limit(TREES * TREE_ROWS).collect()])
    if not len(sample):
        return rows.withColumn("anomaly", F.lit(0.0)), 1.0
    forest = Forest(features(sample))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for stats in batches:
            yield pd.Series(forest.scores(features(stats[list(STATISTICS)].to_numpy())))

    rows = rows.withColumn("anomaly", score("stats"))
    marks = labels.select(F.col(quoted(id)).alias("of"), F.col(quoted(quality)).alias("mark"))
    marks = marks.where("mark in (0, 1)").groupBy("of").agg(
        F.max((F.col("mark") == 1).cast("int")).alias("good"), F.max((F.col("mark") == 0).cast("int")).alias("bad")
    )
    known = rows.where("not base_failed").join(marks, F.col(quoted(id)) == marks["of"])
    bins = known.groupBy(F.ceil(F.col("anomaly") * BINS).alias("bin")).agg(
        F.max("anomaly").alias("highest"), F.sum("good").alias("good"), F.sum("bad").alias("bad")
    )
    return rows, best_threshold([tuple(r)[1:] for r in bins.orderBy("bin").collect()])


def judged(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``scored`` with ``kept``: neither failed by the base rules nor an anomaly."""
    rows, threshold = scored(docs, labels, id, text)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= threshold))
