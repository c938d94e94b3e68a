"""Removal of repeated byte strings with suffix arrays over shards that share content.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts anywhere else. A
suffix takes part with its first ``WINDOW`` bytes, its window. Suffixes are dealt to shards
by an anchor, the least hash among the ``GRAM``-byte strings of the window: equal windows
have equal anchors and so meet. Consecutive suffixes with one anchor travel as a fragment.

* An anchor that occurs once cannot hold a repeat; its text never travels.
* Fragments of the same content are counted, not gathered: a passage that stands in a third
  of all documents is one row per task before the shuffle, and if it is the only content of
  its anchor, all of its windows are repeated.
* Where an anchor has different fragments, one copy of each goes to a shard. There the
  suffixes are sorted by induced sorting, and the permuted common prefixes tell which
  windows occur twice.
* An anchor with very many fragments would not fit a shard: its windows are counted by hash
  instead, again combined before the shuffle.

A content hash has 64 bits and is only compared under the same 64-bit anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import (
    arrow_schema,
    blank_text,
    packed_rows,
    quoted,
    runs_of,
    saved,
    with_arrays,
    with_fields,
)
from oreflow.llm.suffixes import common_prefixes, suffix_array

WINDOW = 200
GRAM = 32
#: Bytes hashed at once; longer texts go in pieces that overlap by a window.
PIECE = 1 << 17
#: Bytes of fragments that one suffix array covers; an anchor is never split between two.
SHARD = 1 << 20
#: Occurrences from which an anchor with different fragments is counted by window hashes.
CROWDED = 20_000
_PLACE_BITS = 24
_SEPARATOR = b"\xff"  # stands in no UTF-8 text


def _scrambled(values: np.ndarray) -> np.ndarray:
    """The 64-bit values scrambled in place (wrapping multiplications and shifts)."""
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        values ^= values >> np.uint64(32)
        values *= np.uint64(factor)
    return values


_BYTE_VALUES = _scrambled(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0x2545F4914F6CDD1D
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each ``GRAM``-byte string of ``data``, scrambled."""
    powers = np.full(len(data), _FACTOR, np.uint64)
    np.multiply.accumulate(powers, out=powers)
    powers *= _BYTE_VALUES[data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.add.accumulate(powers, out=sums[1:])
    found = sums[GRAM:] - sums[:-GRAM]
    shifts = np.full(len(found), _INVERSE, np.uint64)
    np.multiply.accumulate(shifts, out=shifts)
    found *= shifts
    return _scrambled(found)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from the runs up to and from a block edge."""
    count = len(values)
    padded = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:count] = values
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[: count - width + 1], upto[width - 1 : count])


def anchored_runs(pieces: list[tuple[int, int, bytes]]) -> list[np.ndarray] | None:
    """Columns of the fragments of some texts: owner, start, windows, anchor, content.

    A piece is an owner, the place of its first byte in the owner's text, and bytes.
    """
    pieces = [p for p in pieces if len(p[2]) >= WINDOW]
    if not pieces:
        return None
    text = b"".join(p[2] for p in pieces)
    hashes = gram_hashes(np.frombuffer(text, np.uint8))
    packed = hashes >> np.uint64(_PLACE_BITS)
    packed <<= np.uint64(_PLACE_BITS)
    packed |= np.arange(len(hashes), dtype=np.uint64)
    place = _least(packed, WINDOW - GRAM + 1)
    place &= np.uint64((1 << _PLACE_BITS) - 1)
    place = place.view(np.int64)
    ends = np.cumsum([len(p[2]) for p in pieces])
    for end in ends[:-1].tolist():  # windows that reach over the end of a piece
        place[end - WINDOW + 1 : end] = -1
    cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
    start = np.concatenate(([0], cuts))
    count = np.diff(start, append=len(place))
    anchor = place[start]
    inside = anchor >= 0
    start, count, anchor = start[inside], count[inside], hashes[anchor[inside]].view(np.int64)
    stop = start + count - 1 + WINDOW
    digest = xxhash.xxh3_64_intdigest
    contents = [digest(text[s:e]) for s, e in zip(start.tolist(), stop.tolist(), strict=True)]
    contents = np.array(contents, np.uint64).view(np.int64)
    piece = np.searchsorted(ends, start, "right")
    owner, first = np.array([p[0] for p in pieces]), np.array([p[1] for p in pieces])
    offset = first - (ends - np.array([len(p[2]) for p in pieces]))
    return [owner[piece], start + offset[piece], count, anchor, contents]


def _pieces(owner: int, text: bytes) -> Iterator[tuple[int, int, bytes]]:
    for at in range(0, max(1, len(text) - WINDOW + 1), PIECE):
        yield owner, at, text[at : at + PIECE + WINDOW - 1]


def _fragments(keyed: DataFrame) -> DataFrame:
    """The fragments of (id, check, text): where they stand, their anchor and content hash."""
    schema = T.StructType(
        [keyed.schema["id"], keyed.schema["check"]]
        + [T.StructField(n, T.LongType()) for n in ("start", "windows", "anchor", "content")]
    )
    arrow = arrow_schema(schema)

    def rows(batch: pa.RecordBatch, pieces: list) -> Iterator[pa.RecordBatch]:
        if found := anchored_runs(pieces):
            owner, *columns = map(pa.array, found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), *columns], schema=arrow
            )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for owner, text in enumerate(batch.column(2)):
                for piece in _pieces(owner, text.as_py().encode()):
                    held.append(piece)
                    size += len(piece[2])
                    if size >= PIECE:
                        yield from rows(batch, held)
                        held, size = [], 0
            yield from rows(batch, held)

    return keyed.mapInArrow(split, schema)


def _asked_for(texts: DataFrame) -> DataFrame:
    """(anchor, content, copies, crowded, bytes) of the fragments asked for in each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, asked in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py().encode()
                for x in asked.as_py():
                    end = x["start"] + x["windows"] - 1 + WINDOW
                    out.append((x["anchor"], x["content"], x["copies"], x["crowded"], data[x["start"] : end]))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out, strict=True)],
                    names=["anchor", "content", "copies", "crowded", "bytes"],
                )

    kinds = "anchor long, content long, copies long, crowded boolean, bytes binary"
    return texts.mapInArrow(cut, kinds)


def repeated_windows(fragments: list[bytes]) -> list[np.ndarray]:
    """For each fragment a mask of the windows that occur twice or more in the fragments."""
    data = np.frombuffer(_SEPARATOR.join(fragments), np.uint8)
    order = suffix_array(data)
    shared = common_prefixes(data, order, WINDOW)
    # A suffix repeats if it agrees with the one before it, or the one after it does.
    marks = shared >= WINDOW
    marks[order[:-1]] |= marks[order[1:]]
    out, at = [], 0
    for fragment in fragments:
        out.append(marks[at : at + len(fragment) - WINDOW + 1])
        at += len(fragment) + 1
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, content, first, last): runs of repeated windows, from rows sorted by anchor."""
    held: list[pa.RecordBatch] = []
    size = 0

    def results() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        copies = table.column("copies").to_pylist()
        masks = repeated_windows(table.column("bytes").to_pylist())
        of, first, last = [], [], []
        for at, mask in enumerate(masks):
            starts, ends = _runs(mask if copies[at] == 1 else np.ones(len(mask), bool))
            of += [at] * len(starts)
            first += starts.tolist()
            last += (ends - 1).tolist()
        if of:
            yield pa.RecordBatch.from_arrays(
                [
                    table.column("anchor").take(of).combine_chunks(),
                    table.column("content").take(of).combine_chunks(),
                    pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()),
                ],
                names=["anchor", "content", "first", "last"],
            )

    for batch in runs_of(batches, "anchor"):
        anchors = batch.column("anchor").to_numpy()
        sizes = np.array([len(x) + 1 for x in batch.column("bytes").to_pylist()])
        cuts = np.flatnonzero(np.diff(anchors)) + 1
        begin = 0
        for end in [*cuts.tolist(), len(anchors)]:
            size += int(sizes[begin:end].sum())
            held.append(batch.slice(begin, end - begin))
            begin = end
            if size >= SHARD:
                yield from results()
                held, size = [], 0
    if held:
        yield from results()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, content, copies, first, window): each window of a fragment by its hash."""
    for batch in batches:
        for at, data in enumerate(batch.column("bytes").to_pylist()):
            count = len(data) - WINDOW + 1
            hashes = [xxhash.xxh3_64_intdigest(data[i : i + WINDOW]) for i in range(count)]
            same = [pa.array([batch.column(c)[at].as_py()] * count, pa.int64()) for c in range(3)]
            window = pa.array(np.array(hashes, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(np.arange(count)), window],
                names=["anchor", "content", "copies", "first", "window"],
            )


def _crowded_windows(fragments: DataFrame) -> DataFrame:
    """Like ``_search`` for anchors of very many fragments, by counted hashes."""
    hashed = fragments.select("anchor", "content", "copies", "bytes").mapInArrow(
        _hashed, "anchor long, content long, copies long, first long, window long"
    )
    counted = hashed.groupBy("anchor", "window").agg(F.sum("copies").alias("n"))
    twice = counted.where("n > 1").drop("n")
    return hashed.join(twice, ["anchor", "window"], "left_semi").select(
        "anchor", "content", "first", F.col("first").alias("last")
    )


def _spans(keyed: DataFrame) -> DataFrame:
    """(id, check, spans): the repeated runs of each text as a list of (begin, end)."""
    fragments = _fragments(keyed)
    anchors = fragments.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high")
    )
    twice = anchors.where("n > 1").select(
        "anchor", (F.col("low") != F.col("high")).alias("mixed"), (F.col("n") > CROWDED).alias("crowded")
    )
    repeated = saved(fragments.join(twice, "anchor"), "repeats")

    mixed = repeated.where("mixed")
    contents = mixed.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"),
        F.first("crowded").alias("crowded"),
        F.min(F.struct("id", "check", "start", "windows")).alias("at"),
    )
    asked = contents.groupBy("at.id", "at.check").agg(
        F.collect_list(
            F.struct("at.start", "at.windows", "anchor", "content", "copies", "crowded")
        ).alias("asked")
    )
    same = keyed["id"].eqNullSafe(asked["id"]) & (keyed["check"] == asked["check"])
    cut = saved(_asked_for(keyed.join(asked, same).select("text", "asked")), "repeats-fragments")
    # Identical rows of the input answer the same request more than once.
    sparse = cut.where("not crowded").dropDuplicates(["anchor", "content"])
    sorted_found = sparse.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _search, "anchor long, content long, first long, last long"
    )
    crowded = _crowded_windows(cut.where("crowded").dropDuplicates(["anchor", "content"]))
    found = sorted_found.union(crowded)

    # One row per fragment, so that a fragment's many copies meet one row each.
    listed = found.groupBy("anchor", "content").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )
    part = mixed.join(listed, ["anchor", "content"]).select(
        "id",
        "check",
        F.transform(
            "runs",
            lambda run: F.struct(
                (F.col("start") + run["first"]).alias("begin"),
                (F.col("start") + run["last"] + WINDOW).alias("end"),
            ),
        ).alias("spans"),
    )
    end = F.col("start") + F.col("windows") - 1 + WINDOW
    whole = repeated.where("not mixed").select(
        "id", "check", F.array(F.struct(F.col("start").alias("begin"), end.alias("end"))).alias("spans")
    )
    spans = whole.union(part).groupBy("id", "check")
    return spans.agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order; those that overlap or touch are one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", as_text: bool = False
) -> DataFrame:
    """The columns of ``docs`` but ``text``, then ``kept``, ``removed`` and ``n_bytes``.

    ``removed`` lists as (begin, end) the maximal runs of bytes that are covered by a
    ``WINDOW``-byte string which also starts elsewhere, in the same text or another;
    ``kept`` is the other bytes, and ``n_bytes`` counts all. With ``as_text`` it is a
    string, without the characters that lose some of their bytes. Columns of those three
    names are replaced.

    A null text is empty; texts shorter than a window are kept whole. Identical rows (also
    with the same or a null id) are copies of one another, and all lose what they share. No
    rows give no rows. Texts are read whole.
    """
    new = {"kept", "removed", "n_bytes"}
    others = [c for c in docs.columns if c.lower() not in new | {text.lower()}]
    keyed = docs.select(
        F.struct(*[quoted(c) for c in others]).alias("whole"),
        F.col(quoted(id)).alias("id"),
        blank_text(text).alias("text"),
    )
    keyed = keyed.withColumn("check", F.xxhash64("text"))
    spans = _spans(keyed.select("id", "check", "text")).select(
        F.col("id").alias("of"), F.col("check").alias("of_check"), "spans"
    )
    here = keyed["id"].eqNullSafe(spans["of"]) & (keyed["check"] == spans["of_check"])
    joined = keyed.join(spans, here, "left").select("whole", "text", "spans")
    schema = with_fields(
        joined.select("whole").schema,
        [
            ("kept", "string" if as_text else "binary"),
            ("removed", "array<struct<begin:bigint,end:bigint>>"),
            ("n_bytes", "long"),
        ],
    )
    arrow = arrow_schema(schema)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, sizes = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_py().encode()
                gone = merged([(s["begin"], s["end"]) for s in spans.as_py() or ()])
                edges = [0, *[e for span in gone for e in span], len(data)]
                parts = [data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                if as_text:
                    kept.append("".join(part.decode(errors="ignore") for part in parts))
                else:
                    kept.append(b"".join(parts))
                removed.append([{"begin": a, "end": b} for a, b in gone])
                sizes.append(len(data))
            arrays = {"kept": pa.array(kept, arrow.field("kept").type), "n_bytes": sizes}
            arrays["removed"] = pa.array(removed, arrow.field("removed").type)
            yield with_arrays(batch, arrow, arrays)

    done = joined.mapInArrow(remove, schema)
    return done.select("whole.*", "kept", "removed", "n_bytes")


def drop_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text, and ``n_chars`` to match.

    A character that loses some of its bytes goes whole; a null text becomes empty. All
    rows stay.
    """
    cleaned = without_repeats(packed_rows(docs, text, id), "id", "text", as_text=True)
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.col("kept").alias(c))
        elif c == "n_chars":
            columns.append(F.length("kept").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"whole.{quoted(c)}"))
    return cleaned.select(*columns)
