"""A Merkle manifest of a dataset, with an inclusion proof for every row.

The rows of each group are the leaves of a tree whose nodes have three children; the groups'
roots are the leaves of one more tree, and its root names the whole dataset.

Only every ``STEP``-th level is persisted. A node of a stored level and its descendants on
the stored level below are an aligned subtree of at most ``3 ** STEP`` of these. Proofs are
extracted from the top down: each subtree makes its interior nodes anew from its stored
descendants, adds their siblings in front of what the subtree above has given, and forgets
them. So no level is a job of its own, and no task holds more than some subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.llm.common import arrow_schema, quoted, saved

ARITY = 3
#: Levels from one stored level to the next.
STEP = 3
SUBTREE = ARITY**STEP
_DIGEST = 64
_AT_ONCE = 256


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def raised(nodes: list[str]) -> list[str]:
    """The level above some consecutive nodes that begin with a whole run."""
    return [hashed("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The levels of an aligned subtree from its stored descendants to its top."""
    found = [nodes]
    for _ in range(levels):
        found.append(raised(found[-1]))
    return found


def siblings(levels: list[list[str]], at: int) -> str:
    """The siblings on the way from a descendant to the top, level by level, left to right."""
    found = []
    for nodes in levels[:-1]:
        first = at // ARITY * ARITY
        found += nodes[first:at] + nodes[at + 1 : first + ARITY]
        at //= ARITY
    return "".join(found)


def folded(digest: str, proof: str, places: list[tuple[int, int]]) -> str:
    """The root that follows from a leaf and its siblings.

    ``places`` has the leaf's place and the number of leaves for each tree on the way.
    """
    begin = 0
    for at, n in places:
        while n > 1:
            first = at // ARITY * ARITY
            others = min(ARITY, n - first) - 1
            run = [proof[begin + _DIGEST * i : begin + _DIGEST * (i + 1)] for i in range(others)]
            begin += _DIGEST * others
            run.insert(at - first, digest)
            digest, at, n = hashed("".join(run)), at // ARITY, -(-n // ARITY)
    return digest


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def leaf(values: list[Column]) -> Column:
    """The digest of a row: of each value ``-`` if null, else its UTF-8 length, a colon and it."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _numbered(rows: DataFrame) -> DataFrame:
    """(tree, id, digest, other, at) of (tree, id, digest, other, row): places within each tree.

    The rows are sorted over all tasks; each task counts the rows of a tree it has. A tree
    that goes on from an earlier task begins with that task's count, of which there is at
    most one for each task.
    """
    ordered = rows.repartitionByRange("tree", "id", "digest", "row").sortWithinPartitions("tree", "id", "digest", "row")
    schema = T.StructType(
        [*[rows.schema[c] for c in ("tree", "id", "digest", "other")], T.StructField("task", T.IntegerType()), T.StructField("here", T.LongType())]
    )
    arrow = arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, n = object(), 0
        for batch in batches:
            here = []
            for name in batch.column("tree").to_pylist():
                n = n + 1 if name == tree else 0
                tree = name
                here.append(n)
            columns = [batch.column(c) for c in ("tree", "id", "digest", "other", "task")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(here, pa.int64())], schema=arrow)

    counted = saved(ordered.withColumn("task", F.spark_partition_id()).mapInArrow(count, schema), "merkle-leaves")
    ends = counted.groupBy("tree", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(F.col("tree").alias("of"), F.col("task").alias("in"), F.sum("n").over(earlier).alias("before"))
    before = F.broadcast(before.where("before > 0"))
    here = (counted["task"] == before["in"]) & counted["tree"].eqNullSafe(before["of"])
    at = (F.col("here") + F.coalesce("before", F.lit(0))).alias("at")
    return counted.join(before, here, "left").select("tree", "id", "digest", "other", at)


def _subtrees(nodes: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
    """(tree, top, n, members): nodes by the aligned subtree they lie in.

    ``n`` is the number of nodes of the tree on this level if all lie in the subtree, else
    null. Only a tree's first subtree can be its only one, so only those are joined.
    """
    fields = ["at", *[c for c in nodes.columns if c not in ("tree", "at")]]
    grouped = nodes.groupBy("tree", F.expr(f"at div {SUBTREE}").alias("top"))
    grouped = grouped.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("members"))
    small = sizes.where(F.col("n") <= SUBTREE).select(F.col("tree").alias("of"), "n")
    only = (F.col("top") == 0) & F.col("tree").eqNullSafe(F.col("of"))
    first = grouped.where("top = 0").join(small, only, "left").select("tree", "top", "n", "members")
    rest = grouped.where("top > 0").select("tree", "top", F.lit(None).cast("long").alias("n"), "members")
    return saved(first.union(rest), name)


def _tops(subtrees: DataFrame) -> DataFrame:
    """(tree, at, digest, is_root): the top node of each subtree."""
    schema = T.StructType(
        [
            subtrees.schema["tree"],
            T.StructField("at", T.LongType()),
            T.StructField("digest", T.StringType()),
            T.StructField("is_root", T.BooleanType()),
        ]
    )
    arrow = arrow_schema(schema)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n").to_pylist()
            tops = [
                interior(digests, STEP if n is None else height(n))[-1][0]
                for digests, n in zip(batch.column("digests").to_pylist(), sizes, strict=True)
            ]
            columns = [batch.column("tree"), batch.column("top"), pa.array(tops), pa.array([n is not None for n in sizes])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return subtrees.select("tree", "top", "n", F.col("members.digest").alias("digests")).mapInArrow(top, schema)


def _grown(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees as subtrees, lowest first, and (tree, n, digest) of the roots."""
    sizes = saved(leaves.groupBy("tree").agg(F.count("*").alias("n")), f"{name}-sizes")
    levels, roots, nodes, left = [], None, leaves, sizes
    while True:
        levels.append(_subtrees(nodes, left, f"{name}-level"))
        tops = saved(_tops(levels[-1]), f"{name}-tops")
        done = tops.where("is_root").select("tree", "digest")
        roots = done if roots is None else roots.union(done)
        nodes = tops.where("NOT is_root").select("tree", "at", "digest")
        left = left.where(F.col("n") > SUBTREE).select("tree", F.ceil(F.col("n") / SUBTREE).alias("n"))
        if nodes.isEmpty():
            break
    roots = roots.withColumnRenamed("tree", "of").join(sizes, F.col("of").eqNullSafe(sizes["tree"]))
    return levels, saved(roots.select("tree", "n", "digest"), f"{name}-roots")


def _proved(levels: list[DataFrame], heads: DataFrame, name: str) -> DataFrame:
    """(subtree's columns, proof, head) of the lowest level's subtrees.

    ``heads`` has (tree, proof, head) for every tree: the siblings above its root, and what
    its leaves are to carry. A level's subtrees get theirs from the level above, or from the
    head if they are a whole tree.
    """
    above = None
    for number in reversed(range(len(levels))):
        level = levels[number]
        whole = heads.select(F.col("tree").alias("of"), F.lit(0).cast("long").alias("over"), F.lit(True).alias("is_root"), "proof", "head")
        given = whole if above is None else whole.union(above)
        same = level["tree"].eqNullSafe(given["of"]) & (level["top"] == given["over"])
        same &= level["n"].isNotNull() == given["is_root"]
        joined = level.join(given, same).select(level["tree"], "top", "n", "members", "proof", "head")
        if number == 0:
            return joined
        above = saved(_descended(joined), f"{name}-proofs")
    raise ValueError("a tree has a level")


def _descended(subtrees: DataFrame) -> DataFrame:
    """(of, over, is_root, proof, head) for each stored descendant of the subtrees."""
    schema = T.StructType(
        [
            T.StructField("of", subtrees.schema["tree"].dataType),
            T.StructField("over", T.LongType()),
            T.StructField("is_root", T.BooleanType()),
            T.StructField("proof", T.StringType()),
            subtrees.schema["head"],
        ]
    )
    arrow = arrow_schema(schema)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            owner, over, proofs = [], [], []
            for at, (first, n, digests, proof) in enumerate(_subtree_rows(batch)):
                levels = interior(digests, STEP if n is None else height(n))
                for i in range(len(digests)):
                    owner.append(at)
                    over.append(first + i)
                    proofs.append(siblings(levels, i) + proof)
            taken = [batch.column(c).take(pa.array(owner, pa.int64())) for c in ("tree", "head")]
            columns = [taken[0], pa.array(over, pa.int64()), pa.array([False] * len(over)), pa.array(proofs, pa.string()), taken[1]]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return subtrees.select("tree", "top", "n", F.col("members.digest").alias("digests"), "proof", "head").mapInArrow(descend, schema)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for begin in range(0, batch.num_rows, _AT_ONCE):
        yield batch.slice(begin, _AT_ONCE)


def _subtree_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(place of the first descendant, n, digests, proof) of each subtree."""
    top, n, digests, proof = (batch.column(c).to_pylist() for c in ("top", "n", "digests", "proof"))
    return zip([t * SUBTREE for t in top], n, digests, proof, strict=True)


def manifest(
    docs: DataFrame,
    fields: list[str],
    id: str = "doc_id",
    group: str = "source",
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """(``id``, leaf, subroot, root, proof, folded_root, verified) of every row.

    A leaf is the digest of a row's ``fields``. The leaves of a ``group`` ascend by id (null
    ids first, repeated ids by digest), the groups by value (null first). ``proof`` has all
    siblings from the leaf to the root. ``folded_root`` is what follows from them and the
    row as it is ``presented``, with other values for some fields; without these it is the
    root. A null group is a group, repeated rows are leaves of their own, and no rows give
    no rows. Only the fields, id and group are read.

    Written to the work folder: the leaves, the nodes of every ``STEP``-th level and the proofs
    on their way down, which have a row for each ``3 ** STEP`` of the level below.
    """
    columns = {f: F.col(quoted(f)) for f in fields}
    rows = docs.select(
        F.col(quoted(group)).alias("tree"),
        F.col(quoted(id)).alias("id"),
        leaf(list(columns.values())).alias("digest"),
        leaf(list((columns | (presented or {})).values())).alias("other"),
    )
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    levels, subroots = _grown(_numbered(rows), "merkle")
    # The tree over the groups: its leaves' ids are the groups.
    tops = subroots.select(
        F.lit(0).alias("tree"), F.col("tree").alias("id"), "digest", F.col("n").alias("other"), F.lit(0).alias("row")
    )
    top_levels, root = _grown(_numbered(tops), "merkle-groups")
    head = F.struct(F.col("digest").alias("root"), F.col("n").alias("n_groups"))
    top = _proved(top_levels, root.select("tree", F.lit("").alias("proof"), head.alias("head")), "merkle-groups")
    heads = _group_heads(top)
    found = _proved(levels, heads, "merkle")
    return _leaf_rows(found, id)


def _group_heads(subtrees: DataFrame) -> DataFrame:
    """(tree, proof, head) of every group, from the lowest level of the tree over them."""
    member = subtrees.schema["members"].dataType.elementType
    head = T.StructType(
        [
            T.StructField("root", T.StringType()),
            T.StructField("subroot", T.StringType()),
            T.StructField("place", T.LongType()),
            T.StructField("n_groups", T.LongType()),
            T.StructField("n_leaves", T.LongType()),
        ]
    )
    schema = T.StructType(
        [T.StructField("tree", member["id"].dataType), T.StructField("proof", T.StringType()), T.StructField("head", head)]
    )
    arrow = arrow_schema(schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            rows = []
            heads = batch.column("head").to_pylist()
            for (n, members, proof), above in zip(_members(batch), heads, strict=True):
                levels = interior([m["digest"] for m in members], STEP if n is None else height(n))
                for i, m in enumerate(members):
                    own = (above["root"], m["digest"], m["at"], above["n_groups"], m["other"])
                    rows.append((m["id"], siblings(levels, i) + proof, dict(zip(head.names, own, strict=True))))
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return saved(subtrees.mapInArrow(spread, schema), "merkle-heads")


def _members(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in ("n", "members", "proof")), strict=True)


def _leaf_rows(subtrees: DataFrame, id: str) -> DataFrame:
    """The rows of ``manifest`` from the subtrees over the leaves."""
    member = subtrees.schema["members"].dataType.elementType
    texts = ("leaf", "subroot", "root", "proof", "folded_root")
    schema = T.StructType(
        [T.StructField(id, member["id"].dataType)]
        + [T.StructField(c, T.StringType()) for c in texts]
        + [T.StructField("verified", T.BooleanType())]
    )
    arrow = arrow_schema(schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole)):
            rows = []
            heads = batch.column("head").to_pylist()
            for (n, members, above), head in zip(_members(batch), heads, strict=True):
                levels = interior([m["digest"] for m in members], STEP if n is None else height(n))
                for i, m in enumerate(members):
                    proof = siblings(levels, i) + above
                    places = [(m["at"], head["n_leaves"]), (head["place"], head["n_groups"])]
                    root = folded(m["other"], proof, places)
                    rows.append((m["id"], m["digest"], head["subroot"], head["root"], proof, root, root == head["root"]))
            if rows:
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return subtrees.select("n", "members", "proof", "head").mapInArrow(spread, schema)
