"""Packing of token streams into sequences by deficit round-robin over source queues.

Every source is a queue of its documents' tokens. Each sequence, a window, visits all
queues: a queue earns its share of the window's tokens, is served the whole tokens of what
it has earned, and carries the rest as its deficit into the next window; the tokens then
still open go to the largest deficits. So every window has the target proportions.

Windows are planned in segments that do not depend on one another. What each queue has been
served when a segment begins follows from the totals, its deficit there being the fraction
that is rounded off; so deficits carry over from segment to segment and from task to task
without one task's waiting for another. A document only needs the totals of the queues and
the place of its first token in its queue to be cut into its pieces.

Sources may be any number. Those with a stated weight and the largest others have a queue of
their own; the rest feed one more queue by the same round-robin, nested: groups of about
``MEMBERS`` sources are merged into streams, groups of streams again, up to a single stream.
Each merge gives its members their proportions in every window of its own, so up to any place
a source is no further from its proportion than its share of a window of each merge; one of so
few tokens a window could come nearer only in scraps of a few tokens. A document carries the totals
of the groups above it, no task or driver all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import arrow_schema, blank_text, quoted, saved, slices_of
from oreflow.llm.tokens import SLICE, Words

LENGTH = 2048
END = 1
#: Sources with a queue of their own, the largest ones; all others are merged into one more queue.
QUEUES = 255
#: Sources, or merged streams, of one merge, about.
MEMBERS = 64
#: Windows of a segment.
SEGMENT = 64


class Schedule:
    """Which window serves which tokens of each queue."""

    def __init__(
        self, totals: list[int], weights: list[float] | None = None, length: int = LENGTH, keep: int = 1000
    ):
        """``totals`` are the queues' tokens, ``weights`` the target proportions (by default
        the totals themselves). A queue that runs dry leaves its share to the others.
        ``keep`` bounds the planned segments that are kept for further documents."""
        self.totals = np.array(totals, np.int64)
        self.weights = np.array(totals if weights is None else weights, float)
        if (self.weights[self.totals > 0] <= 0).any():
            raise ValueError("a queue with tokens needs a share")
        self.length = length
        queues = len(totals)
        # A segment has room for what rounding may add to its queues.
        self.windows = max(SEGMENT, -(-2 * queues * SEGMENT // length))
        self.quota = self.windows * length - queues
        full = np.where(self.totals > 0, self.totals / np.maximum(self.weights, 1e-300), 0)
        self.dry = np.sort(full)  # the times at which queues run dry
        self.done = np.array([np.minimum(self.totals, self.weights * t).sum() for t in self.dry])
        self.segments = int(-(-self.totals.sum() // self.quota))
        self.known: dict[int, tuple] = {}
        self.keep = keep

    def served(self, segment: int) -> np.ndarray:
        """The tokens of each queue before a segment, never less than before the last one."""
        if segment >= self.segments:
            return self.totals
        time = np.interp(segment * self.quota, [0, *self.done], [0, *self.dry])
        return np.minimum(self.totals, (self.weights * time).astype(np.int64))

    def segment_of(self, queue: int, place: int) -> int:
        """The segment that serves a queue's token."""
        low, high = 0, self.segments - 1
        time = place / self.weights[queue]
        guess = int(np.interp(time, [0, *self.dry], [0, *self.done]) // self.quota)
        low, high = max(0, min(guess - 1, high)), min(high, max(guess + 1, 0))
        if self.served(low)[queue] > place or self.served(high + 1)[queue] <= place:
            low, high = 0, self.segments - 1
        while low < high:
            middle = (low + high + 1) // 2
            if self.served(middle)[queue] <= place:
                low = middle
            else:
                high = middle - 1
        return low

    def segment(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window and queue the queue's first token, and the first token's offset."""
        if number in self.known:
            return self.known[number]
        first = self.served(number)
        left = self.served(number + 1) - first
        share = left * (self.length / max(1, left.sum()))
        deficit = np.zeros(len(left))
        takes = []
        while left.any():
            deficit += share
            take = np.minimum(np.maximum(deficit, 0).astype(np.int64), left)
            if (over := int(take.sum()) - self.length) > 0:
                for queue in np.argsort(deficit - take):
                    cut = min(over, int(take[queue]))
                    take[queue] -= cut
                    over -= cut
            room = min(self.length - int(take.sum()), int((left - take).sum()))
            while room:
                open_queues = np.flatnonzero(left > take)
                order = open_queues[np.argsort(-(deficit - take)[open_queues], kind="stable")]
                each = max(1, room // len(order))
                for queue in order:
                    more = min(each, room, int(left[queue] - take[queue]))
                    take[queue] += more
                    room -= more
            deficit -= take
            left = left - take
            takes.append(take)
        takes = np.array(takes, np.int64).reshape(-1, len(first))
        begins = np.vstack([first, first + np.cumsum(takes, axis=0)])
        offsets = np.cumsum(takes, axis=1) - takes
        if len(self.known) >= self.keep:
            self.known.clear()
        self.known[number] = begins, offsets
        return begins, offsets

    def pieces(self, queue: int, place: int, count: int) -> list[np.ndarray]:
        """Start, length, sequence and offset of each piece of ``count`` tokens from ``place`` on."""
        found, number, at, end = [], self.segment_of(queue, place), place, place + count
        while at < end:
            begins, offsets = self.segment(number)
            edges = begins[:, queue]
            stop = min(end, int(edges[-1]))
            low = int(np.searchsorted(edges, at, "right")) - 1
            high = int(np.searchsorted(edges, stop, "left"))
            begin = np.maximum(edges[low:high], at)
            length = np.minimum(edges[low + 1 : high + 1], stop) - begin
            sequence = np.arange(low, high) + number * self.windows
            rows = np.stack([begin - place, length, sequence, offsets[low:high, queue] + begin - edges[low:high]])
            found.append(rows[:, length > 0])
            at, number = stop, number + 1
        return list(np.concatenate(found, axis=1))

    def merged(self, queue: int, place: int, count: int) -> list[np.ndarray]:
        """Start, length and place in the merged stream of all queues of each piece.

        The stream is the windows one after the other. Only a segment's last window has room
        left, and what was served before a segment follows from the totals.
        """
        start, length, sequence, offset = self.pieces(queue, place, count)
        segments, of = np.unique(sequence // self.windows, return_inverse=True)
        before = np.array([self.served(int(n)).sum() for n in segments])[of]
        return [start, length, before + sequence % self.windows * self.length + offset]


class Merges:
    """The places of the smaller sources' documents in the queue they share."""

    def __init__(self):
        self.known: dict[int, Schedule] = {}

    def schedule(self, node: int, totals: list[int]) -> Schedule:
        if node not in self.known:
            if len(self.known) >= 200:
                self.known.clear()
            self.known[node] = Schedule(totals, keep=4)
        return self.known[node]

    def placed(self, merges: list[dict], place: int, count: int) -> list[tuple[int, int, int]]:
        """(start, length, place in the queue) of each piece of ``count`` tokens from ``place`` on.

        ``merges`` lead from the source upwards: node, the member's number there, and totals.
        """
        parts = [(0, count, place)]
        for merge in merges:
            schedule, above = self.schedule(merge["node"], merge["totals"]), []
            for start, length, at in parts:
                pieces = schedule.merged(merge["member"], at, length)
                above += [(start + s, n, to) for s, n, to in zip(*(c.tolist() for c in pieces), strict=True)]
            parts = above
        return parts


def _merges(rest: DataFrame) -> DataFrame:
    """(source, merges) of the sources in ``rest`` (source, tokens), by levels of groups.

    A source's first group is drawn by its hash, which leaves about ``MEMBERS`` in each; further
    up, groups are numbers in a row. Only the number of sources reaches the driver.
    """
    groups = -(-rest.count() // MEMBERS)
    drawn = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()), F.lit(max(1, groups)))
    of = rest.select("source", drawn.alias("group"), F.array().cast(_MERGES).alias("merges"))
    nodes = rest.select(F.struct(F.col("source").isNotNull(), "source").alias("name"), "tokens", drawn.alias("group"))
    first, level = True, 0
    while True:
        gathered = F.array_sort(F.collect_list(F.struct("name", "tokens")))
        merged = nodes.groupBy("group").agg(gathered.alias("members"))
        at = merged.select(
            F.col("group").alias("in"),
            F.posexplode("members").alias("member", "one"),
            F.transform("members", lambda m: m["tokens"]).alias("totals"),
        ).select("in", "member", "totals", "one.name")
        here = (
            (of["group"] == at["in"]) & of["source"].eqNullSafe(at["name"]["source"])
            if first
            else of["below"] == at["name"]
        )
        merge = F.struct(
            # No two merges of any level have the same number.
            (F.col("in") * 16 + level).alias("node"), F.col("member").cast("long").alias("member"), "totals"
        )
        of = of.join(at, here).select(
            "source",
            F.col("in").alias("below"),
            F.floor(F.col("in") / MEMBERS).alias("group"),
            F.concat("merges", F.array(merge)).alias("merges"),
        )
        if groups <= 1:
            return of.select("source", "merges")
        sums = F.aggregate("members", F.lit(0).cast("long"), lambda n, m: n + m["tokens"])
        nodes = merged.select(
            F.col("group").alias("name"), sums.alias("tokens"), F.floor(F.col("group") / MEMBERS).alias("group")
        )
        first, level, groups = False, level + 1, -(-groups // MEMBERS)


_MERGES = "array<struct<node: bigint, member: bigint, totals: array<bigint>>>"


def _tokenised(docs: DataFrame, path: str, id: str, text: str, source: str) -> DataFrame:
    """(id, source, block, before, count, ids): a document's ids, and its place in its block.

    A block is what one task has written; ``before`` are the tokens of the same source that
    stand before the document there.
    """
    rows = docs.select(
        F.col(quoted(id)).alias("id"),
        F.col(quoted(source)).cast("string").alias("source"),
        blank_text(text).alias("text"),
    )
    schema = T.StructType(
        [rows.schema["id"], rows.schema["source"]]
        + [T.StructField(n, T.LongType()) for n in ("block", "before", "count")]
        + [T.StructField("ids", T.BinaryType())]
    )
    arrow = arrow_schema(schema)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Words.shared(path) as words:
            yield from tokenised(batches, words)

    def tokenised(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        sums: dict = {}
        for batch in (part for whole in batches for part in slices_of(whole, 2, SLICE)):
            ids, counts = words.encode_all(batch.column(2))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, END)
            counts, ends = counts + 1, ends + np.arange(1, len(ends) + 1)
            before = []
            for name, count in zip(batch.column(1).to_pylist(), counts.tolist(), strict=True):
                before.append(sums.get(name, 0))
                sums[name] = before[-1] + count
            offsets = pa.py_buffer((4 * np.concatenate([[0], ends])).astype("<i4"))
            found = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(ids.astype("<u4"))])
            columns = [np.full(len(ends), block), before, counts]
            columns = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[2:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, found], schema=arrow)

    return rows.mapInArrow(tokenise, schema)


def packed(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: dict[str | None, float] | None = None,
) -> DataFrame:
    """(``id``, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents.

    ``ids`` are a piece's token ids as little-endian unsigned 32-bit integers. A document's
    ids end with ``END``, so an empty or null text is one token. ``sequence_id`` names a
    sequence of at most ``LENGTH`` tokens, in which pieces lie without gap from offset 0; only
    the last sequence of a segment has room left. ``weights`` are target proportions by
    source; sources it does not name share further weight by their tokens, at as much a token
    as the named ones have. By default all sources do, so that all run dry together. A weight
    for a source with tokens must be above 0; names without tokens count for nothing. A null
    source is a source of its own. Repeated rows are documents of their own. No rows give no
    rows.

    The tokens are written to the work folder once. The totals of at most ``QUEUES`` sources
    and of those that ``weights`` names reach the driver.
    """
    tokens = saved(_tokenised(docs, path, id, text, source), "packing")
    blocks = tokens.groupBy("block", "source").agg(F.sum("count").alias("tokens"))
    sums = saved(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "packing_sources")
    total = sums.agg(F.sum("tokens")).head()[0] or 0
    spark = docs.sparkSession
    stated = spark.createDataFrame([(n,) for n in weights or ()], "name string")
    named = sums.join(F.broadcast(stated), sums["source"].eqNullSafe(stated["name"]), "left_semi").collect()
    others = sums.join(F.broadcast(stated), sums["source"].eqNullSafe(stated["name"]), "left_anti")
    own = named + others.orderBy(F.desc("tokens"), F.asc_nulls_first("source")).limit(QUEUES).collect()
    totals = [r["tokens"] for r in own]
    rest = total - sum(totals)
    shares = None
    if named:
        each = sum(weights[r["source"]] for r in named) / sum(r["tokens"] for r in named)
        shares = [weights[r["source"]] for r in named] + [r["tokens"] * each for r in own[len(named) :]]
    if rest:
        totals.append(rest)
        if shares is not None:
            shares.append(rest * each)
    schedule = Schedule(totals, shares)
    queues = spark.createDataFrame([(r["source"], at) for at, r in enumerate(own)], "name string, queue long")
    earlier = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("first")
    placed = blocks.select("source", "block", first)
    placed = placed.join(F.broadcast(queues), placed["source"].eqNullSafe(queues["name"]), "left").drop("name")
    if rest:
        smaller = sums.join(F.broadcast(queues), sums["source"].eqNullSafe(queues["name"]), "left_anti")
        merges = saved(_merges(smaller).withColumnRenamed("source", "name"), "packing_merges")
        placed = placed.join(merges, placed["source"].eqNullSafe(merges["name"]), "left").drop("name")
    else:
        placed = placed.withColumn("merges", F.lit(None).cast(_MERGES))
    placed = placed.select(
        F.col("source").alias("of"), F.col("block").alias("in"), "first", "merges",
        F.coalesce("queue", F.lit(len(own))).alias("queue"),
    )
    here = (tokens["block"] == placed["in"]) & tokens["source"].eqNullSafe(placed["of"])
    rows = tokens.join(placed, here).select(
        "id", "queue", (F.col("first") + F.col("before")).alias("place"), "count", "ids", "merges"
    )
    schema = T.StructType(
        [T.StructField(id, rows.schema["id"].dataType)]
        + [
            T.StructField(n, T.BinaryType() if n == "ids" else T.LongType())
            for n in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")
        ]
    )
    arrow = arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = Merges()

        def pieces(queue: int, place: int, count: int, merges: list[dict] | None) -> list[np.ndarray]:
            if not merges:
                return schedule.pieces(queue, place, count)
            parts = merged.placed(merges, place, count)
            found = [schedule.pieces(queue, at, length) for _, length, at in parts]
            for (start, _, _), columns in zip(parts, found, strict=True):
                columns[0] = columns[0] + start
            return [np.concatenate(c) for c in zip(*found, strict=True)]

        for batch in batches:
            if not batch.num_rows:
                continue
            queues, places, counts = (batch.column(c).to_pylist() for c in range(1, 4))
            merges = batch.column(5).to_pylist()
            found = [pieces(*row) for row in zip(queues, places, counts, merges, strict=True)]
            of = [len(pieces[0]) for pieces in found]
            start, length, sequence, offset = (np.concatenate(c) for c in zip(*found, strict=True))
            owner = np.repeat(np.arange(len(of)), of)
            # A document's pieces follow one another, so all ids stay where they are.
            ids = batch.column(4)
            begins = np.frombuffer(ids.buffers()[1], "<i4")[ids.offset]
            offsets = pa.py_buffer((begins + 4 * np.concatenate([[0], np.cumsum(length)])).astype("<i4"))
            parts = pa.BinaryArray.from_buffers(pa.binary(), len(owner), [None, offsets, ids.buffers()[2]])
            columns = [start, length, parts, np.array(counts)[owner], sequence, offset]
            columns = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *columns], schema=arrow)

    return rows.mapInArrow(cut, schema)
