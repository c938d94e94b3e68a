"""Near copies by SimHash: wide fingerprints, an index of byte positions, an exact check.

Two texts are near copies if their sets of ``SHINGLE``-word shingles have a Jaccard
similarity of ``LEAST`` or more. A bit of a text's fingerprint is set if over half of the
shingles' hashes have it. At similarity 0.8 about 15 % of the bits differ, 10 of 64, so the
few bits of ``simhash.py`` do not do here: a fingerprint has 272 bytes. It is posted under
each pair of neighbours of its first 256 bytes, and a list holds the fingerprints that share
both bytes at these positions; texts of similarity 0.8 share one with probability 0.9999
(0.999 if they have 12 shingles in common or fewer). The last 16 bytes travel with each
posting. Within a list the half bytes that a pair shares there are tallied, pairs that reach
``MIN_SHARED`` are retained, and their bits compared.

Fingerprints that are linked so, over others too, form a group. All texts of a group are
then compared by their shingles, so no pair is linked that is less similar than ``LEAST``.
A group of more than ``BLOCK`` texts is dealt out by pairs of blocks. Equal texts (by their
words) are one entry from the start. Lists and blocks give a star per connected part instead
of its pairs. The bits of four shingles swing most; texts of five shingles are also linked to
those that have four of them by the sums of their hashes, without the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import (
    arrow_schema,
    packed_rows,
    runs_of,
    saved,
    slices_of,
    unpacked_rows,
    with_arrays,
    with_fields,
)
from oreflow.llm.components import components
from oreflow.llm.simhash import _Parts

SHINGLE = 5
#: The least similarity, as a fraction.
LEAST = (4, 5)
#: Pairs of bytes of a fingerprint that it is posted under.
LISTS = 128
#: Bytes of a fingerprint that its postings carry, and of those: the half bytes that a pair
#: shares at least, and the bits that differ at most.
CARRIED = 16
MIN_SHARED = 5
MAX_BITS = 38
#: Lists up to this length are compared all at once, longer ones member by member.
SHORT_LIST = 256
#: Members of a group that are compared in one task with those of one other block.
BLOCK = 2048
_BYTES = 2 * LISTS + CARRIED
_FACTORS = np.random.default_rng(5).integers(0, 1 << 63, (2, _BYTES // 8), np.uint64) * np.uint64(2) + np.uint64(1)
#: The bits of a byte, each in a byte of its own.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()
_HALF = np.uint64(32)
#: Hashes that can be added up in a byte.
_AT_ONCE = 255
_POSTED_AT_ONCE = 256
_LINKS_AT_ONCE = 1 << 18
#: Bytes of text whose words a task holds at once, but for a longer text.
SLICE = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    """The lower-case words (ASCII letters only are lowered) between ASCII white space."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes]) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; a shorter text is one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    joined = (b" ".join(words[i : i + SHINGLE]) for i in range(n))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 7) for s in joined), np.uint64, n))


def _widened(hashes: np.ndarray) -> np.ndarray:
    """As many bytes of each hash as a fingerprint has."""
    wide = hashes[:, None] * _FACTORS[0]
    wide ^= wide >> _HALF
    wide *= _FACTORS[1]
    wide ^= wide >> _HALF
    return wide.view(np.uint8)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The bytes of the SimHash of a text's shingles; zero without shingles."""
    counts = np.zeros(8 * _BYTES, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        spread = _SPREAD.take(_widened(hashes[at : at + _AT_ONCE]), mode="clip")
        counts += spread.sum(axis=0).view(np.uint8)
    return np.packbits(2 * counts > len(hashes))


def _keys(prints: np.ndarray) -> np.ndarray:
    """The keys of the lists of each fingerprint: the list's number and its two bytes."""
    return prints[:, : 2 * LISTS].copy().view(np.uint16) + (np.arange(LISTS, dtype=np.int32) << 16)


def bands(hashes: np.ndarray) -> list[int]:
    """The keys of the lists of a text's fingerprint; none without shingles."""
    return _keys(fingerprint(hashes)[None])[0].tolist() if len(hashes) else []


def _carried(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two numbers that the postings of each fingerprint carry."""
    found = prints[:, 2 * LISTS :].copy().view(np.uint64)
    return found[:, 0], found[:, 1]


def _entry(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """One signed long for both numbers."""
    return (high ^ low * _FACTORS[0, 0]).view(np.int64)


def _fours(hashes: np.ndarray) -> list[int] | None:
    """The sums of the hashes of each four of four or five shingles."""
    if len(hashes) not in (4, 5):
        return None
    total = hashes.sum(keepdims=True)
    return (total if len(hashes) == 4 else total - hashes).view(np.int64).tolist()


def _with_fingerprints(rows: DataFrame) -> DataFrame:
    """``rows`` with ``node``, a hash of the text's words, and what its shingles give (null without words)."""
    fields = [("node", "long"), ("print", "binary"), ("entry", "long"), ("fours", "array<bigint>")]
    schema = with_fields(rows.schema, fields)
    arrow, at = arrow_schema(schema), rows.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices_of(whole, at, SLICE)):
            prints = np.zeros((batch.num_rows, _BYTES), np.uint8)
            nodes, empty, fours = [], [], []
            for i, text in enumerate(batch.column(at)):
                words = words_of(text.as_py())
                hashes = shingles(words)
                prints[i] = fingerprint(hashes)
                nodes.append(xxhash.xxh64_intdigest(b" ".join(words), 7))
                empty.append(not words)
                fours.append(_fours(hashes))
            found = {
                "node": np.array(nodes, np.uint64).view(np.int64),
                "print": pa.array([None if none else p.tobytes() for none, p in zip(empty, prints, strict=True)], pa.binary()),
                "entry": _entry(*_carried(prints)),
                "fours": pa.array(fours, pa.list_(pa.int64())),
            }
            yield with_arrays(batch, arrow, found)

    return rows.mapInArrow(add, schema)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, high, low) of (print)."""
    for batch in (b.slice(at, _POSTED_AT_ONCE) for b in batches for at in range(0, b.num_rows, _POSTED_AT_ONCE)):
        prints = np.array([np.frombuffer(p.as_py(), np.uint8) for p in batch.column(0)])
        carried = [pa.array(np.repeat(c.view(np.int64), LISTS)) for c in _carried(prints)]
        yield pa.RecordBatch.from_arrays([pa.array(_keys(prints).ravel()), *carried], names=["key", "high", "low"])


def alike(high: np.ndarray, low: np.ndarray, i: np.ndarray | int, j: np.ndarray) -> np.ndarray:
    """Whether the members ``i`` and ``j`` share enough half bytes and differ in few enough bits."""
    apart = np.stack([high[i] ^ high[j], low[i] ^ low[j]])
    touched = apart | apart >> np.uint64(1)
    touched = (touched | touched >> np.uint64(2)) & np.uint64(0x1111111111111111)
    near = 2 * CARRIED - np.bitwise_count(touched).sum(axis=0, dtype=np.int64) >= MIN_SHARED
    near[near] = np.bitwise_count(apart[:, near]).sum(axis=0, dtype=np.int64) <= MAX_BITS
    return near


def _link_long_list(high: np.ndarray, low: np.ndarray, start: int, end: int, parts: _Parts) -> None:
    """Link the members from ``start`` to ``end`` in ``parts``; connected ones are not compared."""
    for i in range(start, end - 1):
        other = np.flatnonzero(parts.root[i + 1 : end] != parts.root[i]) + i + 1
        near = other[alike(high, low, i, other)]
        if len(near):
            root = parts.root[start:end]
            joined = np.append(parts.root[near], parts.root[i])
            root[np.isin(root, joined)] = joined.min()
            if (root == root[0]).all():
                return


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): links of the entries of each list; the rows are sorted by key."""
    for batch in runs_of(batches, "key"):
        keys = batch.column("key").to_numpy()
        high, low = (batch.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        sizes = np.diff(starts, append=len(keys))
        parts = _Parts(len(keys))
        for start, size in zip(starts[sizes > SHORT_LIST], sizes[sizes > SHORT_LIST], strict=True):
            _link_long_list(high, low, start, start + size, parts)
        ends = np.repeat(np.where(sizes > SHORT_LIST, 0, starts + sizes), sizes)
        at, step = np.arange(len(keys)), 1
        while len(at := at[at + step < ends[at]]):
            apart = at[parts.root[at] != parts.root[at + step]]
            near = apart[alike(high, low, apart, apart + step)]
            if len(near):
                parts.link(near, near + step)
            step += 1
        leaves = np.flatnonzero(parts.root != np.arange(len(keys)))
        if len(leaves):
            entries = _entry(high, low)
            columns = [pa.array(entries[i]) for i in (leaves, parts.root[leaves])]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of ``_met``, a star per connected part of those of many lists."""
    held, size = [], 0
    for batch in _met(batches):
        held.append(batch)
        size += batch.num_rows
        if size >= _LINKS_AT_ONCE:
            yield _star_of(held)
            held, size = [], 0
    if held:
        yield _star_of(held)


def _star_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    links = np.concatenate([np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches], axis=1)
    entries, places = np.unique(links, return_inverse=True)
    parts = _Parts(len(entries))
    parts.link(*places.reshape(2, -1))
    leaves = np.flatnonzero(parts.root != np.arange(len(entries)))
    columns = [pa.array(entries[i]) for i in (leaves, parts.root[leaves])]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def linked_entries(nodes: DataFrame) -> DataFrame:
    """(a, b): links of the entries whose fingerprints (``print``) meet in a list and are alike."""
    postings = nodes.select("print").where("print IS NOT NULL").mapInArrow(_postings, "key int, high long, low long")
    return postings.repartition("key").sortWithinPartitions("key").mapInArrow(_stars, "a long, b long")


def _with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingles) of (node, text)."""
    for batch in (part for whole in batches for part in slices_of(whole, 1, SLICE)):
        found = [shingles(words_of(t.as_py())).view(np.int64) for t in batch.column(1)]
        found = pa.array(found, pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["node", "shingles"])


def linked(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A star per connected part of sets that are similar enough: its other members, its least.

    Sets are visited by size: a similar one is at most so much larger.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order])
    ends = np.searchsorted(sizes, sizes * LEAST[1] // LEAST[0], "right")
    starts = np.cumsum(sizes) - sizes
    values, places = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    root, held = np.arange(len(sets)), np.zeros(len(values), bool)
    for i, end in enumerate(ends):
        apart = root[i + 1 : end] != root[i]
        if not apart.any():
            continue
        own = places[starts[i] : starts[i] + sizes[i]]
        held[own] = True
        begin, stop = starts[i + 1], starts[end - 1] + sizes[end - 1]
        shared = np.add.reduceat(held[places[begin:stop]], starts[i + 1 : end] - begin, dtype=np.int64)
        held[own] = False
        either = sizes[i + 1 : end] + sizes[i] - shared
        near = np.flatnonzero(apart & (LEAST[1] * shared >= LEAST[0] * either)) + i + 1
        if len(near):
            joined = np.append(root[near], root[i])
            root[np.isin(root, joined)] = joined.min()
    leaves = np.flatnonzero(root != np.arange(len(sets)))
    return order[leaves], order[root[leaves]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): links within each part of a group; the rows are sorted by part."""
    for batch in runs_of(batches, "part"):
        parts = batch.column("part").to_numpy()
        nodes = batch.column("node").to_numpy()
        sets = batch.column("shingles")
        starts = np.flatnonzero(np.diff(parts, prepend=parts[0] - 1))
        a, b = [], []
        for start, end in zip(starts, np.append(starts[1:], len(parts)), strict=True):
            if end - start > 1:
                members = [sets[i].values.to_numpy() for i in range(start, end)]
                leaves, roots = linked(members)
                a.append(nodes[start + leaves])
                b.append(nodes[start + roots])
        if a:
            columns = [pa.array(np.concatenate(c)) for c in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _linked_fives(nodes: DataFrame) -> DataFrame:
    """(a, b): links of texts of five shingles, or of the same four, to one of four of them."""
    sums = nodes.select("node", F.explode("fours").alias("sum"), (F.size("fours") == 1).alias("four"))
    fours = sums.where("four").groupBy("sum").agg(F.min("node").alias("b"))
    return sums.join(fours, "sum").select(F.col("node").alias("a"), "b")


def _linked_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links that connect all texts of a group of fingerprints that are near copies."""
    groups = components(linked_entries(nodes), "near-prints").withColumnRenamed("node", "of")
    members = nodes.where("print IS NOT NULL").select("node", "entry", "first.row_in_run")
    members = members.join(groups, members["entry"] == groups["of"], "left")
    members = members.select("node", "row_in_run", F.coalesce("root", "entry").alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    members = members.join(sizes, "key").select(
        "node", "row_in_run", "key", blocks.alias("blocks"), F.pmod(F.xxhash64("node", "key"), blocks).cast("int").alias("own")
    )
    members = saved(members, "near-groups")
    listed = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    listed = listed.select("node", part.alias("part"))
    texts = rows.select("row_in_run", "text").join(members.select("node", "row_in_run"), "row_in_run")
    sets = texts.select("node", "text").mapInArrow(_with_shingles, "node long, shingles array<bigint>")
    met = listed.join(sets, "node").select("part", "node", "shingles")
    links = met.repartition("part").sortWithinPartitions("part").mapInArrow(_links, "a long, b long")
    return links.union(_linked_fives(nodes))


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of texts that are connected by near copies.

    The row with the smallest id stays (null ids come last; the earliest among repeated
    rows). Texts without words are equal, also null. Texts are read whole.

    Written to the work folder: the rows with their fingerprints, a row per different text,
    the members of groups of several, and the rounds of the components.
    """
    rows = _with_fingerprints(packed_rows(docs, text, id))
    rows = saved(rows.withColumn("row_in_run", F.monotonically_increasing_id()), "near-copies")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row_in_run")).alias("first")
    prints = [F.any_value(c).alias(c) for c in ("print", "entry", "fours")]
    nodes = saved(rows.groupBy("node").agg(first, *prints), "near-nodes")
    roots = components(_linked_nodes(rows, nodes), "near-links").withColumnRenamed("node", "of")
    grouped = nodes.join(roots, nodes["node"] == roots["of"], "left")
    kept = grouped.groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
    kept = kept.select("first.row_in_run")
    return rows.join(kept, "row_in_run", "left_semi").transform(unpacked_rows, docs, text)
