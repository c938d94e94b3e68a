"""Language identification with a convolutional network over bytes, trained in numpy.

A text is cut into windows of ``WINDOW`` bytes, the last one padded with spaces. Filters of
several widths slide over a window, each filter keeps its largest value in it, and a
softmax over the rectified values gives the window's languages. A text's languages are the
mean over all of its windows, weighted by their bytes.

As its input is one byte of 256, a filter is a table of weights per byte and place. For
prediction neighbouring places are joined to tables of byte pairs.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import blank_text, packed_rows, quoted, unpacked_rows

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bounds of the training sample: languages (the most frequent), texts of each, windows of each.
LANGUAGES = 256
TEXTS_PER_LANGUAGE = 400
WINDOWS_PER_TEXT = 2
EPOCHS = 12
UNDETERMINED = "und"
#: The pipeline keeps a document whose language has at least this score.
LEAST_SCORE = 0.3
_WINDOWS_AT_ONCE = 64


@dataclass
class Model:
    """Languages, per width the filters (place, byte, filter), and the weights of the softmax."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    base: np.ndarray


def windows_of(data: bytes) -> np.ndarray:
    """The bytes as rows of ``WINDOW``; one row of spaces if there are none."""
    count = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(count * WINDOW), np.uint8).reshape(count, WINDOW)


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Model:
    """Fit a model to windows (rows of bytes) with the numbers of their languages."""
    chance = np.random.default_rng(7)
    n, hidden = len(windows), FILTERS * len(WIDTHS)
    model = Model(
        languages,
        [chance.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(hidden, np.float32),
        chance.normal(0, 0.1, (hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    parameters = [*model.filters, model.bias, model.weights, model.base]
    means = [np.zeros_like(p) for p in parameters]
    squares = [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(EPOCHS):
        order = chance.permutation(n)
        for at in range(0, n, 64):
            x, y = windows[order[at : at + 64]], labels[order[at : at + 64]]
            rows = np.arange(len(x))
            highest, places = [], []
            for table in model.filters:
                width = len(table)
                value = sum(table[j][x[:, j : WINDOW - width + 1 + j]] for j in range(width))
                place = value.argmax(axis=1)
                places.append(place)
                highest.append(np.take_along_axis(value, place[:, None, :], 1)[:, 0, :])
            pooled = np.concatenate(highest, axis=1) + model.bias
            active = np.maximum(pooled, 0)
            error = _softmax(active @ model.weights + model.base)
            error[rows, y] -= 1
            error /= len(x)
            back = (error @ model.weights.T) * (pooled > 0)
            slopes = []
            for number, (table, place) in enumerate(zip(model.filters, places, strict=True)):
                slope = np.zeros_like(table)
                part = back[:, number * FILTERS : (number + 1) * FILTERS]
                for j in range(len(table)):
                    byte = x[rows[:, None], place + j]
                    np.add.at(slope[j], (byte, np.arange(FILTERS)[None, :]), part)
                slopes.append(slope)
            slopes += [back.sum(axis=0), active.T @ error, error.sum(axis=0)]
            step += 1
            for p, slope, mean, square in zip(parameters, slopes, means, squares, strict=True):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                rate = 0.01 / (1 - 0.9**step)
                p -= (rate * mean / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


class _Predictor:
    """A model with tables of byte pairs."""

    def __init__(self, model: Model):
        self.model = model
        self.tables = []
        for table in model.filters:
            pairs = [
                (table[j][:, None, :] + table[j + 1][None, :, :]).reshape(65536, FILTERS)
                for j in range(0, len(table) - 1, 2)
            ]
            self.tables.append((len(table), pairs, table[-1] if len(table) % 2 else None))

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        pairs_at = x[:, :-1].astype(np.intp) << 8 | x[:, 1:]
        highest = []
        for width, pairs, single in self.tables:
            span = WINDOW - width + 1
            value = pairs[0][pairs_at[:, :span]]
            for number, table in enumerate(pairs[1:], 1):
                value += table[pairs_at[:, 2 * number : 2 * number + span]]
            if single is not None:
                value += single[x[:, width - 1 : width - 1 + span]]
            highest.append(value.max(axis=1))
        active = np.maximum(np.concatenate(highest, axis=1) + self.model.bias, 0)
        return _softmax(active @ self.model.weights + self.model.base)

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each text's language, and its probability."""
        rows = [windows_of(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(r) for r in rows])
        x = np.concatenate(rows)
        parts = range(0, len(x), _WINDOWS_AT_ONCE)
        found = np.concatenate([self.windows(x[at : at + _WINDOWS_AT_ONCE]) for at in parts])
        sizes = np.full(len(x), float(WINDOW))
        last = np.append(np.flatnonzero(np.diff(owner)), len(x) - 1)
        sizes[last] = [(len(t) - 1) % WINDOW + 1 if t else 1 for t in texts]
        total = np.zeros((len(texts), found.shape[1]))
        np.add.at(total, owner, found * sizes[:, None])
        total /= total.sum(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        return best, total[np.arange(len(texts)), best]


def held_out(id: str) -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(quoted(id)).cast("string")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, hash, part): windows of a bounded number of different texts per language.

    They are the texts of least hash, so the same in every run; copies of a text count once.
    """
    rows = docs.select(F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", F.xxhash64("text").alias("hash"), "text")
    languages = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("hash").alias("texts"))
    # Of a language's different texts about so many pass, the same share of all hashes.
    share = F.least(F.lit(1.0), F.lit(8.0 * TEXTS_PER_LANGUAGE) / F.col("texts"))
    languages = languages.orderBy(F.desc("n"), "lang").limit(LANGUAGES).select(F.col("lang").alias("of"), share.alias("share"))
    chars = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    parts = [
        F.substring("text", F.pmod(F.xxhash64("text", F.lit(i)), chars).cast("int") + 1, F.lit(WINDOW))
        for i in range(WINDOWS_PER_TEXT)
    ]
    least = (F.col("hash") / float(1 << 64)) + 0.5 <= F.col("share")
    few = rows.join(F.broadcast(languages), (F.col("lang") == F.col("of")) & least)
    few = few.groupBy("lang", "hash").agg(F.any_value(F.array(*parts)).alias("parts"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash")).alias("place")
    short = few.select("lang", "hash", "parts", place).where(F.col("place") <= TEXTS_PER_LANGUAGE)
    return short.select("lang", "hash", F.explode("parts").alias("part"))


def train_on(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """A model of the labelled texts that are not held out; None without any.

    The sample that reaches the driver is bounded by ``LANGUAGES``, ``TEXTS_PER_LANGUAGE``
    and ``WINDOWS_PER_TEXT`` windows of ``WINDOW`` characters. It is chosen by a hash of the
    texts, so it does not depend on the order of rows.
    """
    usable = docs.where(~held_out(id) & F.col(quoted(id)).isNotNull())
    sample = sorted((r["lang"], r["hash"], r["part"]) for r in _sample(usable, text, lang).collect())
    if not sample:
        return None
    languages = sorted({s[0] for s in sample})
    number = {name: at for at, name in enumerate(languages)}
    windows = np.concatenate([windows_of(part.encode()[:WINDOW]) for _, _, part in sample])
    return train(windows, np.array([number[name] for name, _, _ in sample]), languages)


def predicted(model: Model | None, docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), replacing columns of those names.

    A text that is null or has no letter, or any text without a model, is ``und`` with score
    0. Texts are read whole, and each row by itself, so repeated rows have equal results.
    """
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predictor = _Predictor(model)
        for texts in batches:
            found = []
            for at in range(0, len(texts), 64):
                best, score = predictor.texts([t.encode() for t in texts[at : at + 64]])
                found += [(model.languages[b], float(s)) for b, s in zip(best, score, strict=True)]
            yield pd.DataFrame(found, columns=["lang", "score"])

    letters = F.col(quoted(text)).isNotNull() & F.col(quoted(text)).rlike(r"\p{L}")
    rows = docs.withColumn("\u0001found", predict(blank_text(text)))
    found = F.col("\u0001found")
    return rows.withColumns(
        {
            "lang_pred": F.when(letters, found["lang"]).otherwise(UNDETERMINED),
            "score": F.when(letters, F.least(found["score"], F.lit(1.0))).otherwise(0.0),
        }
    ).drop("\u0001found")


def keep_identified(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the documents whose language is undetermined or scores too low.

    The model learns from the labelled documents themselves. Without labels there is no
    model, and all documents go.
    """
    model = train_on(docs, id, text, lang)
    found = predicted(model, packed_rows(docs, text), "text")
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return unpacked_rows(kept, docs, text)
