"""SQL for the Merkle manifest and the vector codes."""

from __future__ import annotations

from oreflow.llm.merkle import ARITY
from oreflow.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

#: The polynomial of CRC-32, its bits in reverse, and what it starts from.
_POLYNOMIAL = 0xEDB88320
_ONES = 0xFFFFFFFF


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text."""
    byte = (
        f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        f"lambda x, y: xor(x // 2, (x % 2) * {_POLYNOMIAL}))"
    )
    letters = f"list_transform(range(1, len({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend({_ONES}::BIGINT, {letters}), lambda c, b: {byte}), {_ONES})"


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, pos, digest, n)."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, pos, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, pos // {ARITY}, sha256(string_agg(digest, '' ORDER BY pos)),
         (any_value(n) + {ARITY - 1}) // {ARITY}
  FROM {name} WHERE n > 1 GROUP BY tree, level, pos // {ARITY}
)"""


def _fold(name: str, start: str, nodes: str) -> str:
    """(rid, tree, level, pos, digest, n): the way of each row of ``start`` to the top."""
    return f"""
{name} AS (
  SELECT rid, tree, 0 AS level, pos, digest, n FROM {start}
  UNION ALL
  SELECT f.rid, any_value(f.tree), any_value(f.level) + 1, any_value(f.pos) // {ARITY},
         sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.digest ELSE s.digest END, '' ORDER BY s.pos)),
         (any_value(f.n) + {ARITY - 1}) // {ARITY}
  FROM {name} f JOIN {nodes} s
    ON s.tree = f.tree AND s.level = f.level AND s.pos // {ARITY} = f.pos // {ARITY}
  WHERE f.n > 1 GROUP BY f.rid
)"""


def merkle() -> str:
    crc = _crc32("CAST(doc_id AS VARCHAR)")
    return f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf,
         {_leaf(f"CASE WHEN {crc} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS shown
  FROM documents
),
leaves AS MATERIALIZED (
  SELECT *, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM hashed
),{_tree("nodes", "leaves")},
own AS MATERIALIZED (SELECT * FROM nodes),
groups AS MATERIALIZED (
  SELECT 0 AS tree, tree AS source, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n
  FROM own WHERE n = 1
),{_tree("upper", "groups")},
above AS MATERIALIZED (SELECT * FROM upper),
levels AS (
  SELECT rid, 0 AS part, s.level, s.pos, s.digest
  FROM leaves l JOIN own s ON s.tree = l.tree AND s.n > 1
   AND s.pos // {ARITY} = l.pos // (({ARITY} ** (s.level + 1))::BIGINT) AND s.pos <> l.pos // (({ARITY} ** s.level)::BIGINT)
  UNION ALL
  SELECT rid, 1, s.level, s.pos, s.digest
  FROM leaves l JOIN groups g ON g.source = l.tree JOIN above s ON s.n > 1
   AND s.pos // {ARITY} = g.pos // (({ARITY} ** (s.level + 1))::BIGINT) AND s.pos <> g.pos // (({ARITY} ** s.level)::BIGINT)
),
proofs AS (SELECT rid, string_agg(digest, '' ORDER BY part, level, pos) AS proof FROM levels GROUP BY rid),
starts AS (SELECT rid, tree, pos, shown AS digest, n FROM leaves),{_fold("folds", "starts", "own")},
middles AS MATERIALIZED (
  SELECT f.rid, 0 AS tree, g.pos, f.digest, g.n FROM folds f JOIN groups g ON g.source = f.tree WHERE f.n = 1
),{_fold("upfolds", "middles", "above")}
SELECT doc_id, leaf, g.digest AS subroot, r.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       u.digest AS folded_root, u.digest = r.digest AS verified
FROM leaves l JOIN groups g ON g.source = l.tree
JOIN (SELECT digest FROM above WHERE n = 1) r ON true
JOIN (SELECT rid, digest FROM upfolds WHERE n = 1) u ON u.rid = l.rid
LEFT JOIN proofs p ON p.rid = l.rid
"""


def _assigned(number: int) -> str:
    return f"""
assigned{number} AS MATERIALIZED (
  SELECT rid, part, entry, d FROM (
    SELECT p.rid, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
    FROM parts p JOIN book{number} b ON b.part = p.part AND b.pos = p.pos GROUP BY ALL
  ) QUALIFY row_number() OVER (PARTITION BY rid, part ORDER BY d, entry) = 1
)"""


def _moved(number: int) -> str:
    return f"""
sums{number} AS (
  SELECT a.part, a.entry, p.pos, sum(p.x) AS s, count(*) AS n
  FROM assigned{number} a JOIN parts p ON p.rid = a.rid AND p.part = a.part GROUP BY ALL
),
book{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CASE WHEN n IS NULL THEN b.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM book{number} b LEFT JOIN sums{number} USING (part, entry, pos)
)"""


def vector_codes() -> str:
    rounds = ",".join(f"{_assigned(i)},{_moved(i)}" for i in range(ROUNDS))
    return f"""
WITH finite AS (
  SELECT * FROM embeddings WHERE embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
kept AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rid FROM finite
  WHERE len(embedding) = (SELECT len(embedding) FROM finite ORDER BY vec_id NULLS LAST, embedding LIMIT 1)
),
cells AS (
  SELECT rid, unnest(range(len(embedding))) AS i, len(embedding) // {PARTS} AS width, unnest(embedding)::DOUBLE AS e FROM kept
),
parts AS MATERIALIZED (
  SELECT rid, i // width AS part, i % width AS pos, floor({SCALE} * e)::HUGEINT AS x FROM cells
),
book0 AS MATERIALIZED (SELECT part, rid AS entry, pos, x FROM parts WHERE rid < {ENTRIES}),{rounds},{_assigned(ROUNDS)},
coded AS (
  SELECT rid, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM assigned{ROUNDS} GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (rid)
"""
