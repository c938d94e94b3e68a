"""SimHash near-duplicates by an inverted index of byte positions with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most three bits agree in
at least five positional bytes, so among the first seven positions they agree in at least
four. Every distinct fingerprint is therefore posted under each choice of four of those
seven positions (35 postings); a posting list holds the fingerprints that share four
positional bytes. Within a list the shared bytes of a pair are tallied over all eight
positions, pairs that reach the guaranteed five are retained, and their bits compared.
Posting under four bytes rather than one keeps the lists short: a list of single bytes
would hold a 256th of the corpus.

A long list is split by each further byte, whose sublists share five bytes and so hold at
most 2**24 distinct fingerprints. They are searched by flipping bits, in time linear in
their length, and give a star per connected part instead of all pairs. Equal fingerprints
are one entry from the start, so copies never meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import (
    arrow_schema,
    packed_rows,
    quoted,
    runs_of,
    saved,
    unpacked_rows,
    with_arrays,
    with_fields,
)
from oreflow.llm.components import components

MAX_BITS = 3
MIN_BYTES = 8 - MAX_BITS
POSTED = 4
CHOICES = list(combinations(range(POSTED + MAX_BITS), POSTED))
#: Lists up to this length are compared pairwise, longer ones are split by a further byte.
SHORT_LIST = 64
#: Sublists up to this length are compared pairwise, longer ones by flipping bits.
SHORT_SUBLIST = 2048
_BITS_AT_ONCE = 1 << 14


def fingerprint(text: str | None, words_per_shingle: int = 3, seed: int = 42) -> int:
    """SimHash of a text's word shingles; zero if it has no words (or is null)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < words_per_shingle:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        starts = starts[: len(words) - words_per_shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[s:e], seed)
            for s, e in zip(starts, ends[words_per_shingle - 1 :].tolist(), strict=True)
        ]
    values = np.array(hashes, np.uint64).byteswap().view(np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), _BITS_AT_ONCE):
        counts += np.unpackbits(values[at : at + _BITS_AT_ONCE], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(values)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``fingerprint``, the 64 bits as a signed long."""
    # The text travels once, also if it is kept.
    sent = [*keep, text] if text not in keep else keep
    source, at = docs.select(*[quoted(c) for c in sent]), sent.index(text)
    schema = with_fields(docs.select(*[quoted(c) for c in keep]).schema, [("fingerprint", "long")])
    arrow = arrow_schema(schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            found = np.array([fingerprint(t.as_py()) for t in texts], np.uint64)
            yield with_arrays(batch, arrow, {"fingerprint": found.view(np.int64)})

    return source.mapInArrow(add, schema)


def _positional_byte(position: int) -> F.Column:
    return F.shiftrightunsigned("fp", 8 * (7 - position)).bitwiseAND(F.lit(255))


def _postings(fingerprints: DataFrame) -> DataFrame:
    """(posting, fp): one row per choice of positions; the choice and its bytes in a long."""
    keys = []
    for number, choice in enumerate(CHOICES):
        key = F.lit(number).cast("long")
        for position in choice:
            key = F.shiftleft(key, 8).bitwiseOR(_positional_byte(position))
        keys.append(key)
    return fingerprints.select("fp", F.explode(F.array(*keys)).alias("posting"))


def _first_choice() -> np.ndarray:
    """For a bit mask of agreeing posted positions, the first choice within it (or -1)."""
    table = np.full(1 << (POSTED + MAX_BITS), -1, np.int64)
    for mask in range(len(table)):
        for number, choice in enumerate(CHOICES):
            if all(mask >> p & 1 for p in choice):
                table[mask] = number
                break
    return table


def _retained(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether pairs link, and the mask of posted positions that they share."""
    same = (a ^ b).byteswap().view(np.uint8).reshape(-1, 8) == 0
    tally = same.sum(axis=1)
    links = tally >= MIN_BYTES
    links[links] = np.bitwise_count(a[links] ^ b[links]) <= MAX_BITS
    mask = same[:, : POSTED + MAX_BITS] @ (1 << np.arange(POSTED + MAX_BITS))
    return links, mask


class _Parts:
    """Connected parts of the members of one list."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _link_sublist(fps: np.ndarray, at: np.ndarray, parts: _Parts) -> None:
    """Link the members ``at``, which all share five positional bytes, in ``parts``."""
    values = fps[at]
    if len(values) <= SHORT_SUBLIST:
        for i in range(len(values) - 1):
            near = np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= MAX_BITS)
            if len(near):
                parts.link(np.full(len(near), at[i]), at[near + i + 1])
        return
    order = np.argsort(values)
    values, at = values[order], at[order]
    varying = np.bitwise_or.reduce(values ^ values[0])
    bits = [np.uint64(1) << np.uint64(b) for b in range(64) if int(varying) >> b & 1]
    for n in range(1, MAX_BITS + 1):
        for flips in combinations(bits, n):
            wanted = values ^ np.bitwise_or.reduce(np.array(flips, np.uint64))
            place = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            found = np.flatnonzero(values[place] == wanted)
            if len(found):
                parts.link(at[found], at[place[found]])


def _link_long_list(fps: np.ndarray, choice: int) -> tuple[np.ndarray, np.ndarray]:
    """A star per connected part of a long list."""
    parts = _Parts(len(fps))
    columns = fps.byteswap().view(np.uint8).reshape(-1, 8)
    for position in sorted(set(range(8)) - set(CHOICES[choice])):
        order = np.argsort(columns[:, position], kind="stable")
        cuts = np.flatnonzero(np.diff(columns[order, position])) + 1
        for at in np.split(order, cuts):
            if len(at) > 1:
                _link_sublist(fps, at, parts)
    leaves = np.flatnonzero(parts.root != np.arange(len(fps)))
    return fps[leaves], fps[parts.root[leaves]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each posting list; the rows are sorted by posting."""
    first_choice = _first_choice()
    for batch in runs_of(batches, "posting"):
        postings = batch.column("posting").to_numpy()
        fps = batch.column("fp").to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.diff(postings, prepend=postings[0] - 1))
        sizes = np.diff(starts, append=len(postings))
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        long_lists = sizes > SHORT_LIST
        for start, size in zip(starts[long_lists], sizes[long_lists], strict=True):
            choice = int(postings[start] >> (8 * POSTED))
            found.append(_link_long_list(fps[start : start + size], choice))
        size_at = np.repeat(sizes, sizes)
        place = np.arange(len(postings)) - np.repeat(starts, sizes)
        size_at[size_at > SHORT_LIST] = 0
        for step in range(1, int(size_at.max(initial=0))):
            at = np.flatnonzero(place + step < size_at)
            a, b = fps[at], fps[at + step]
            linked, mask = _retained(a, b)
            # Of the lists that hold a pair, the first short one need not be this one if
            # that one is long; a pair of a long list is linked there, so it isn't lost.
            linked &= first_choice[mask] == postings[at] >> (8 * POSTED)
            found.append((a[linked], b[linked]))
        a = np.concatenate([x for x, _ in found]).view(np.int64)
        b = np.concatenate([x for _, x in found]).view(np.int64)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def linked_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (``fp``) at three bits or fewer."""
    postings = _postings(fingerprints).repartition("posting").sortWithinPartitions("posting")
    return postings.mapInArrow(_links, "a long, b long")


def simhash_components(
    docs: DataFrame, id: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row of ``docs`` with its ``fingerprint`` and ``component_id``.

    ``component_id`` is the smallest id of the documents reachable over links of at most
    three differing bits, the row's own included. ``keep`` names the columns to return (all
    by default; ``fingerprint``, ``component_id`` and ``row_in_run`` replace columns of those
    names). ``row_in_run`` numbers the rows.

    Null and empty texts have fingerprint zero and link like any other. A null id never is
    the smallest; a component of null ids only has a null ``component_id``. Repeated rows
    are returned as often as they come. Texts are read whole. No rows give no rows.

    Written to the work folder: the kept columns with the fingerprint, and the rounds of
    the components over distinct fingerprints that have a link.
    """
    keep = list(docs.columns) if keep is None else keep
    rows = with_fingerprints(docs, text, [c for c in keep if c.lower() != "component_id"])
    rows = rows.withColumn("row_in_run", F.monotonically_increasing_id())
    rows = saved(rows, "simhash")
    nodes = rows.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min(quoted(id)).alias("least_id")
    )
    roots = components(linked_fingerprints(nodes.select("fp")), "simhash-links")
    grouped = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    least = grouped.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = grouped.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(members, rows["fingerprint"] == members["fp"]).drop("fp")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``simhash_components``.

    The row with the smallest id stays (the earliest among repeated rows). Where a component
    has null ids only, a row of each of its fingerprints stays.
    """
    packed = packed_rows(docs, text, id)
    marked = simhash_components(packed, "id", "text", keep=["whole", "id", "text"])
    groups = marked.groupBy(
        "component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    )
    first = groups.agg(F.min(F.struct(F.col("id").isNull(), "id", "row_in_run")).alias("first"))
    kept = first.select(F.col("first.row_in_run").alias("row_in_run"))
    return marked.join(kept, "row_in_run", "left_semi").transform(unpacked_rows, docs, text)
