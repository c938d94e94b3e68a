"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from oreflow.llm.licences import BASE, LEAST_SHARE, LICENCES
from oreflow.llm.oracles_keyed import merkle, vector_codes
from oreflow.llm.warc import ENTITIES, SPACES, STEPS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licences() -> str:
    rows = ", ".join(
        f"({number}, {_quoted(t.label)}, {at}, {_quoted(word)}, {str(at in t.key_places).lower()})"
        for number, t in enumerate(BASE + LICENCES)
        for at, word in enumerate(t.words)
    )
    return rf"""
WITH shape(t, label, q, word, in_key) AS (VALUES {rows}),
split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM split
),
hits AS (SELECT * FROM placed WHERE word IN (SELECT word FROM shape)),
idf AS (
  SELECT word, ln(1 + (SELECT count(*) FROM documents) / (1 + count(DISTINCT doc_id))) AS weight
  FROM (SELECT DISTINCT word FROM shape) LEFT JOIN hits USING (word) GROUP BY word
),
weighted AS (SELECT * FROM shape JOIN idf USING (word)),
begins AS (
  SELECT DISTINCT doc_id, w.t, place - q AS start
  FROM hits JOIN weighted w USING (word)
  WHERE (w.t, w.q) IN (SELECT (t, min(q)) FROM shape WHERE in_key GROUP BY t)
),
shares AS (
  SELECT b.doc_id, b.t, b.start, any_value(w.label) AS label,
         sum(w.weight) / any_value(total) AS share,
         count(*) FILTER (WHERE in_key) = any_value(n_key) AS verified
  FROM begins b
  JOIN weighted w ON w.t = b.t
  JOIN hits h ON h.doc_id = b.doc_id AND h.place = b.start + w.q AND h.word = w.word
  JOIN (SELECT t, sum(weight) AS total, count(*) FILTER (WHERE in_key) AS n_key
        FROM weighted GROUP BY t) sums ON sums.t = b.t
  GROUP BY ALL
),
found AS (SELECT *, t < {len(BASE)} AS base FROM shares WHERE verified AND share >= {LEAST_SHARE}),
summed AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base,
         min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         least(1.0, max(share)) AS score
  FROM found GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(coalesce(score, 0.0), 6)::DOUBLE AS score
FROM split LEFT JOIN summed USING (doc_id)
"""


_LAST_TURNS = """
last_turns AS (
  SELECT conv_id, max(turn) AS turn, max(row(turn, role, text)) AS r
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id
),
last_named AS (
  SELECT conv_id, turn, struct_extract_at(r, 2) AS role, struct_extract_at(r, 3) AS text FROM last_turns
)"""

_PREFERENCES = f"""
WITH {_LAST_TURNS},
sides AS (
  SELECT conv_id, turn, role, text, 1 AS c, 0 AS r FROM conversations
  UNION ALL
  SELECT c.conv_id, c.turn, c.role, c.text, 0, 1
  FROM conversations c JOIN last_named l USING (conv_id) WHERE c.turn < l.turn
  UNION ALL
  SELECT l.conv_id, l.turn, o.role, o.text, 0, 1
  FROM last_named l JOIN last_named o
    ON o.conv_id = CASE l.conv_id % 2 WHEN 0 THEN l.conv_id + 1 ELSE l.conv_id - 1 END
),
turns AS (
  SELECT conv_id, turn, role, text, sum(c) AS c, sum(r) AS r FROM sides GROUP BY ALL
),
ends AS (SELECT conv_id, min(turn) AS stop FROM turns WHERE c <> r GROUP BY conv_id),
parts AS (
  SELECT t.*, stop IS NULL OR turn < stop AS shared
  FROM turns t LEFT JOIN ends USING (conv_id)
),
listed AS (
  SELECT *, 'prompt' AS part, c AS times FROM parts WHERE shared
  UNION ALL SELECT *, 'chosen', c FROM parts WHERE NOT shared
  UNION ALL SELECT *, 'rejected', r FROM parts WHERE NOT shared
)
SELECT *, CASE WHEN is_target THEN length('<|im_start|>' || replace(role, '<|', '< |')) + 1 END AS target_begin,
       CASE WHEN is_target THEN length(rendered) - 1 END AS target_end
FROM (SELECT conv_id, part, turn, unnest(range(times::BIGINT)) AS copy, role,
       '<|im_start|>' || replace(role, '<|', '< |') || chr(10) || replace(text, '<|', '< |')
         || '<|im_end|>' || chr(10) AS rendered,
       part <> 'prompt' AND lower(role) = 'assistant' AS is_target
FROM listed WHERE times > 0)
"""


def _warc() -> str:
    plain = "html"
    for pattern, place in STEPS:
        plain = f"regexp_replace({plain}, {_quoted(pattern)}, {_sign(place)}, 'g')"
    for entity, sign in ENTITIES:
        plain = f"replace({plain}, {_quoted(entity)}, {_quoted(sign)})"
    for pattern, place in SPACES:
        pattern = pattern.replace(r" ", r"\x{00A0}")
        plain = f"regexp_replace({plain}, {_quoted(pattern)}, {_sign(place)}, 'g')"
    plain = f"trim(regexp_replace({plain}, '^\\n+|\\n+$', '', 'g'), ' ')"

    def urn(*parts: str) -> str:
        md5 = f"md5(concat_ws('|', {', '.join(parts)}))"
        pieces = [f"substr({md5}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return f"'<urn:uuid:' || concat_ws('-', {', '.join(pieces)}) || '>'"

    line = "chr(13) || chr(10)"
    return f"""
WITH source AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS html FROM pages),
parsed AS (
  SELECT *, 'sha256:' || sha256(html) AS payload_digest, {plain} AS plain,
         'HTTP/1.1 200 OK' || {line} || 'Content-Type: text/html; charset=utf-8' || {line}
           || 'Content-Length: ' || strlen(html) || {line} || {line} || html AS whole
  FROM source
),
named AS (
  SELECT *, {urn("'response'", "page_id::VARCHAR", "target_uri", "payload_digest")} AS refers_to FROM parsed
),
records AS (
  SELECT page_id, 'metadata' AS record_type, refers_to, target_uri, payload_digest,
         'application/warc-fields' AS content_type,
         'source-status: 200' || {line} || 'source-content-type: text/html; charset=utf-8' || {line}
           || 'source-content-length: ' || strlen(html) || {line}
           || 'source-block-digest: sha256:' || sha256(whole) || {line}
           || 'title: ' || trim(regexp_replace(
                regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '\\s+', ' ', 'g'), ' ') || {line}
           || 'outlinks: ' || len(regexp_extract_all(html, '(?i)<a\\s[^>]*href=')) || {line}
           || 'text-chars: ' || length(plain) || {line} AS block
  FROM named
  UNION ALL
  SELECT page_id, 'conversion', refers_to, target_uri, payload_digest, 'text/plain; charset=utf-8', plain
  FROM named
)
SELECT page_id, record_type, {urn("record_type", "refers_to")} AS record_id, refers_to, target_uri,
       content_type, block, 'sha256:' || sha256(block) AS block_digest, payload_digest
FROM records
"""


def _sign(place: str) -> str:
    return "chr(10)" if place == "\n" else _quoted(place)


ORACLES = {
    "op3_licences": _licences(),
    "op4_warc": _warc(),
    "op5_preferences": _PREFERENCES,
    "op12_merkle_manifest": merkle(),
    "op13_vector_codes": vector_codes(),
}
