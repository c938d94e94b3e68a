"""Compression of vectors into short codes, one codebook for each part of a vector.

A vector's components become integers and are cut into equal parts. Every part position has
a codebook, learned by rounds of assigning each part to its nearest entry and moving each
entry to the mean of its parts. A part's nearest entry is found by equal-average search: the
entries are sorted by the sum of their components; from the part's own sum the search goes
outward, the nearer sum first, and ends when the squared gap of the sums over the dimension
strictly exceeds the best squared distance, which no entry beyond can then undercut.

Each round is one pass over the vectors in which a task adds up what it has assigned; only
these sums, whose number is that of the codebooks' components, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import arrow_schema, quoted, saved

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Integer components beyond this size count as this size, and errors beyond a long as its largest.
LARGEST = 1 << 62
_LONGEST = (1 << 63) - 1
#: A label of more than one in so many rows is frequent; there are fewer than so many of them.
FREQUENT = 1000


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite numbers: 64-bit integers if no distance can overflow them."""
    scaled = np.clip(np.floor(vectors * SCALE), -LARGEST, LARGEST)
    if not scaled.size or np.abs(scaled).max() * vectors.shape[1] < 1 << 30:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], object).reshape(scaled.shape)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part and its squared distance, by equal-average search."""
    parts, entries = parts.astype(np.result_type(parts, entries)), entries.astype(np.result_type(parts, entries))
    dimension, sums = parts.shape[1], entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, entries = sums[order], entries[order]
    own = parts.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best = np.zeros(len(parts), parts.dtype)
    index = np.full(len(parts), -1)
    active = np.arange(len(parts))
    while len(active):
        below, above = left[active], right[active]
        has_below, has_above = below >= 0, above < len(sums)
        gap_below = own[active] - sums[np.maximum(below, 0)]
        gap_above = sums[np.minimum(above, len(sums) - 1)] - own[active]
        downward = has_below & (~has_above | (gap_below <= gap_above).astype(bool))
        gap = np.where(downward, gap_below, gap_above)
        near = (gap * gap <= best[active] * dimension).astype(bool) | (index[active] < 0)
        going = (has_below | has_above) & near
        active, downward = active[going], downward[going]
        at = np.where(downward, left[active], right[active])
        difference = parts[active] - entries[at]
        distance, found = (difference * difference).sum(axis=1), order[at]
        equal = (distance == best[active]).astype(bool) & (found < index[active])
        better = (index[active] < 0) | (distance < best[active]).astype(bool) | equal
        best[active[better]], index[active[better]] = distance[better], found[better]
        left[active[downward]] -= 1
        right[active[~downward]] += 1
    return index, best


def _vectors(batch: pa.RecordBatch, dimension: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows whose vector has ``dimension`` components, and their integers."""
    sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
    batch = batch.filter(pa.array(sizes == dimension))
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return batch, integers(values.reshape(batch.num_rows, dimension))


def _finite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose vector is not null and holds finite numbers only."""
    for batch in batches:
        batch = batch.filter(batch.column("vector").is_valid())
        sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
        finite = np.isfinite(batch.column("vector").flatten().to_numpy(zero_copy_only=False))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        bad = np.bincount(owner[~finite], minlength=len(sizes))
        yield batch.filter(pa.array(bad == 0))


def _cut(vectors: np.ndarray) -> list[np.ndarray]:
    return np.split(vectors, PARTS, axis=1)


def _moved(rows: DataFrame, books: list[np.ndarray], dimension: int) -> list[np.ndarray]:
    """The codebooks after one round."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            _, vectors = _vectors(batch, dimension)
            for part, (values, book) in enumerate(zip(_cut(vectors), books, strict=True)):
                index, _ = nearest(values, book)
                counts[part] += np.bincount(index, minlength=len(book))
                for entry in np.unique(index):
                    sums[part][entry] += values[index == entry].sum(axis=0)
        found = [
            (part, entry, at, Decimal(int(total)), int(counts[part][entry]))
            for part, entries in enumerate(sums)
            for entry, totals in enumerate(entries)
            if counts[part][entry]
            for at, total in enumerate(totals)
        ]
        if found:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "at", "total", "n"])

    sums = rows.select("vector").mapInArrow(
        add_up, "part int, entry int, at int, total decimal(38,0), n long"
    )
    moved = [b.astype(object) for b in books]
    for row in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        moved[row["part"]][row["entry"], row["at"]] = int(row["total"]) // row["n"]
    return [_narrow(b) for b in moved]


def _narrow(book: np.ndarray) -> np.ndarray:
    """64-bit integers where they leave distances exact."""
    largest = max((abs(int(x)) for x in book.flat), default=0)
    return book.astype(np.int64 if largest * book.shape[1] * PARTS < 1 << 30 else object)


def learned(rows: DataFrame) -> tuple[list[np.ndarray], int]:
    """The codebooks of (id, vector), and the vectors' length; none without vectors.

    A codebook starts as the parts of the vectors with the ``ENTRIES`` smallest ids (null ids
    last, repeated ids by vector). The first of them sets the length; it must be a multiple
    of ``PARTS``.
    """
    ordered = rows.orderBy(F.asc_nulls_last("id"), "vector")
    first = ordered.select(F.size("vector").alias("n")).head()
    if first is None:
        return [], 0
    dimension = first["n"]
    if dimension % PARTS:
        raise ValueError(f"vectors of {dimension} components can't be cut into {PARTS} parts")
    start = ordered.where(F.size("vector") == dimension).limit(ENTRIES).select("vector").collect()
    vectors = integers(np.array([r["vector"] for r in start], float).reshape(len(start), dimension))
    books = [_narrow(b) for b in _cut(vectors)]
    for _ in range(ROUNDS):
        books = _moved(rows, books, dimension)
    return books, dimension


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.flat).encode()).hexdigest()


def compressed(docs: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(``id``, code, error, label_error, codebooks_sha256): every vector's code and its error.

    Rows whose vector is null or holds null or non-finite components are dropped, also those
    of another length than the vector with the smallest id. ``code`` has two hexadecimal
    digits for each part, ``error`` is the squared distance to the coded vector, and
    ``label_error`` the sum of errors of the rows with the same label (null labels are one).
    Repeated rows and ids are rows of their own. No vectors give no rows. Other columns are
    not read, so their names can't clash.

    The kept vectors are written to the work folder once and read in each round, the codes
    once. Frequent labels, fewer than ``FREQUENT``, are broadcast; all others are joined by
    shuffling, where no label has more than that share of the rows.
    """
    rows = docs.select(
        F.col(quoted(id)).alias("id"),
        F.col(quoted(label)).alias("label"),
        F.col(quoted(vector)).cast("array<double>").alias("vector"),
    )
    rows = saved(rows.mapInArrow(_finite, rows.schema), "vectors")
    books, dimension = learned(rows)
    schema = T.StructType(
        [rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    arrow = arrow_schema(schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch, vectors = _vectors(batch, dimension)
            codes, errors = np.zeros((batch.num_rows, PARTS), np.uint8), 0
            for part, (values, book) in enumerate(zip(_cut(vectors), books, strict=True)):
                codes[:, part], distance = nearest(values, book)
                errors = errors + distance.astype(object)
            columns = [[row.tobytes().hex() for row in codes], [min(int(e), _LONGEST) for e in np.broadcast_to(errors, batch.num_rows)]]
            columns = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *columns], schema=arrow)

    if not books:
        coded = docs.sparkSession.createDataFrame([], schema)
    else:
        coded = saved(rows.mapInArrow(encode, schema), "vector-codes")
    n_rows = coded.count()
    sums = coded.groupBy(F.col("label").alias("of")).agg(
        F.count("*").alias("n"), F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST)).cast("long").alias("sum")
    )
    sums = saved(sums, "vector-labels")
    frequent = sums.where(F.col("n") * FREQUENT > n_rows).select("of", "sum", F.lit(True).alias("is_frequent"))
    marked = coded.join(F.broadcast(frequent), coded["label"].eqNullSafe(frequent["of"]), "left").drop("of")
    rare = sums.where(F.col("n") * FREQUENT <= n_rows).select("of", F.col("sum").alias("rare_sum"))
    others = marked.where("is_frequent IS NULL").join(rare, F.col("label").eqNullSafe(F.col("of")))
    columns = [F.col("id").alias(id), "code", "error"]
    digest = F.lit(books_digest(books)).alias("codebooks_sha256")
    return (
        marked.where("is_frequent")
        .select(*columns, F.col("sum").alias("label_error"), digest)
        .union(others.select(*columns, F.col("rare_sum").alias("label_error"), digest))
    )
