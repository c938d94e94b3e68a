"""Personal data in whole texts: patterns, and a skip-chain conditional random field.

The patterns find e-mail and IP addresses, card and telephone numbers. The field adds what
they can't see: its nodes are the words with a digit or an ``@`` (all others have the label
"none", as a constraint), its labels the kinds of data. Neighbouring nodes share a potential,
and so do distant ones that are equal or similar: the same word, the same digits or last
digits, the same mail domain. Loopy message passing then makes the labels of a document
consistent, so a number that is a telephone number at one place is one at the others too.

The weights are learned from a bounded sample of the texts, by pseudo-likelihood: its labels
are what the patterns find, and values of assignments to secrets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import arrow_schema, blank_text, with_arrays, with_fields

#: Kinds of data in the order of results; the last is found by the field only.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
#: Different texts, and characters of each, from which the field's weights are learned.
SAMPLE_TEXTS = 2000
SAMPLE_CHARS = 20_000
#: Most rounds of message passing; it ends sooner once no message changes by more than this.
SWEEPS = 30
SETTLED = 1e-3
#: The least probability of a label.
LEAST = 0.5
#: Coupling of equal labels between similar words that the sample is added to.
COUPLING = 2.0
#: Documents are labelled together up to about so many nodes.
_NODES_AT_ONCE = 100_000

_MARKED = re.compile(r"[0-9@]")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)\b[\x20\"']*[=:][\x20\"']*([A-Za-z0-9_+/=-]{16,})")
_WORD_BREAKS = " \t\n\r\x0b\x0c"
_OUTER = "\"'`.,;:!?()[]{}<>*#$%&=|-"
_KEYWORD = re.compile(r"(?i)(token|secret|passw|key)\W*$")
_CALL = re.compile(r"(?i)(tel|phone|call|fax|mobile)\W*$")
_HEX = re.compile(r"[0-9A-Fa-f]{20,}")


def luhn(digits: str) -> bool:
    """Whether a number's check digit is right."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping addresses; each holds one ``@``, so these are visited in turn."""
    end, at = 0, text.find("@")
    while at >= 0:
        before = text[end:at][::-1]
        stop = _LOCAL_END.search(before)
        local = stop.start() if stop else len(before)
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        # Nothing before this sign can be part of a later address, but for what follows it.
        end = domain.end() if domain else at + 1
        at = text.find("@", at + 1 if not domain else end)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the patterns find, by kind, then start."""
    found = []
    if not _MARKED.search(text):
        return found
    found += [(0, a, b) for a, b in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return found


def nodes(text: str) -> list[tuple[int, int]]:
    """Start and end of each word with a digit or ``@``, without punctuation around it."""
    found, low, mark = [], 0, _MARKED.search(text)
    while mark:
        begin = max(low, max(text.rfind(c, low, mark.start()) for c in _WORD_BREAKS) + 1)
        end = mark.end()
        ends = _BREAK.search(text, end)
        low = ends.start() if ends else len(text)
        word = text[begin:low]
        start = begin + len(word) - len(word.lstrip(_OUTER))
        found.append((start, max(end, begin + len(word.rstrip(_OUTER)))))
        mark = _MARKED.search(text, low)
    return found


_BREAK = re.compile(f"[{_WORD_BREAKS}]")
_SHAPES = 40


def features(text: str, spans: list[tuple[int, int]], at: int) -> list[int]:
    """The numbers of the features that a node has; all are below ``_SHAPES``."""
    start, end = spans[at]
    word = text[start:end]
    digits = _digits(word)
    n, dots, letters = len(digits), word.count("."), any(c.isalpha() for c in word)
    found = [0, 1 + int(np.searchsorted((1, 3, 6, 8, 12, 19), n)), 8 + min(dots, 4)]
    before, after = text[max(0, start - 24) : start], text[end : end + 2]
    parts = word.split(".")
    tests = (
        "@" in word,
        "@" in word and bool(_DOMAIN.fullmatch(word.rsplit("@", 1)[1])),
        not letters and n == len(word),
        not letters and n + dots == len(word) and dots == 3 and all(p and len(p) <= 3 and int(p) <= 255 for p in parts),
        not letters and "-" in word,
        letters,
        bool(_HEX.fullmatch(word)),
        word.startswith("+") or before.endswith("+"),
        13 <= n <= 19 and not letters and luhn(digits),
        13 <= n <= 19 and not letters and not luhn(digits),
        before[-1:] in ("'", '"') and after[:1] in ("'", '"'),
        before.endswith("(") and after.startswith(")"),
        before.rstrip(" \"'")[-1:] in ("=", ":"),
        bool(_KEYWORD.search(before)),
        bool(_CALL.search(before)),
        at > 0 and not text[spans[at - 1][1] : start].strip(_OUTER + _WORD_BREAKS),
        at + 1 < len(spans) and not text[end : spans[at + 1][0]].strip(_OUTER + _WORD_BREAKS),
        len(word) >= 16 and letters and n > 0,
    )
    return found + [13 + i for i, true in enumerate(tests) if true]


def chain_edges(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Pairs of nodes with nothing but white space and punctuation between them."""
    gaps = ((i, text[a[1] : b[0]]) for i, (a, b) in enumerate(zip(spans, spans[1:], strict=False)))
    return [(i, i + 1) for i, gap in gaps if not gap.strip(_OUTER + _WORD_BREAKS)]


def skip_edges(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each node with the next one that is equal or similar: at most two edges begin at a node."""
    last: dict[tuple, int] = {}
    found = set()
    for i, (start, end) in enumerate(spans):
        word = text[start:end].lower()
        digits = _digits(word)
        if "@" in word:
            keys = [("word", word), ("domain", word.rsplit("@", 1)[1])]
        elif len(digits) >= 6 and not any(c.isalpha() for c in word):
            keys = [("digits", digits), ("tail", digits[-7:])]
        else:
            keys = [("word", word)]
        for key in keys:
            if key in last:
                found.add((last[key], i))
            last[key] = i
    chain = {(i, i + 1) for i in range(len(spans))}
    return sorted(found - chain)


@dataclass
class Graph:
    """Nodes by their features (``shapes`` with ``owner``), and both kinds of edges."""

    shapes: np.ndarray
    owner: np.ndarray
    n: int
    chain: np.ndarray
    skip: np.ndarray

    @staticmethod
    def of(texts: list[tuple[str, list[tuple[int, int]]]]) -> "Graph":
        shapes, owner, chain, skip, n = [], [], [], [], 0
        for text, spans in texts:
            for i in range(len(spans)):
                found = features(text, spans, i)
                shapes += found
                owner += [n + i] * len(found)
            chain += [(n + a, n + b) for a, b in chain_edges(text, spans)]
            skip += [(n + a, n + b) for a, b in skip_edges(text, spans)]
            n += len(spans)
        pairs = [np.array(e, np.int64).reshape(-1, 2) for e in (chain, skip)]
        return Graph(np.array(shapes, np.int64), np.array(owner, np.int64), n, *pairs)


def _summed(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The sums of rows that go to the same place."""
    return np.stack([np.bincount(at, values[:, k], n) for k in range(values.shape[1])], axis=1)


@dataclass
class Field:
    """The potentials: by feature and label, and by pairs of labels along both kinds of edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, graph: Graph) -> np.ndarray:
        """Each node's probabilities of the labels, by loopy message passing."""
        own = _summed(self.unary[graph.shapes], graph.owner, graph.n)
        edges = np.concatenate([graph.chain, graph.skip])
        n, chains = len(edges), len(graph.chain)
        source, target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        reverse = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
        kinds = ((slice(0, chains), self.chain), (slice(chains, n), self.skip))
        kinds += ((slice(n, n + chains), self.chain.T), (slice(n + chains, 2 * n), self.skip.T))
        messages = np.zeros((2 * n, own.shape[1]))
        for _ in range(SWEEPS if n else 0):
            beliefs = own + _summed(messages, target, graph.n)
            rest = beliefs[source] - messages[reverse]
            rest = np.exp(rest - rest.max(axis=1, keepdims=True))
            new = np.empty_like(messages)
            for part, pairs in kinds:
                new[part] = np.log(rest[part] @ np.exp(pairs))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = (messages + new) / 2
            if change < SETTLED:
                break
        beliefs = own + _summed(messages, target, graph.n)
        beliefs = np.exp(beliefs - beliefs.max(axis=1, keepdims=True))
        return beliefs / beliefs.sum(axis=1, keepdims=True)


def fit(graph: Graph, labels: np.ndarray, steps: int = 400, rate: float = 0.1, penalty: float = 1e-3) -> Field:
    """Weights of the greatest pseudo-likelihood, found by gradient steps of adapted length."""
    kinds = len(KINDS) + 1
    prior = np.zeros((_SHAPES + 2 * kinds, kinds))
    prior[_SHAPES + kinds :] = COUPLING * np.eye(kinds)
    weights, mean, square = prior.copy(), np.zeros_like(prior), np.zeros_like(prior)
    truth = np.eye(kinds)[labels]
    groups = ((graph.chain, slice(_SHAPES, _SHAPES + kinds)), (graph.skip, slice(_SHAPES + kinds, None)))
    for step in range(1, steps + 1):
        scores = _summed(weights[:_SHAPES][graph.shapes], graph.owner, graph.n)
        for edges, rows in groups:
            pairs = weights[rows]
            for a, b, table in ((edges[:, 0], edges[:, 1], pairs), (edges[:, 1], edges[:, 0], pairs.T)):
                scores += _summed(table[labels[a]], b, graph.n)
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True) - truth
        slope = np.zeros_like(weights)
        slope[:_SHAPES] = _summed(error[graph.owner], graph.shapes, _SHAPES)
        for edges, rows in groups:
            for a, b, turned in ((edges[:, 0], edges[:, 1], False), (edges[:, 1], edges[:, 0], True)):
                found = _summed(error[b], labels[a], kinds)
                slope[rows] += found.T if turned else found
        slope = slope / graph.n + penalty * (weights - prior)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(weights[:_SHAPES], weights[_SHAPES : _SHAPES + kinds], weights[_SHAPES + kinds :])


def weak_labels(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """Labels for learning: 0, or 1 and the kind whose span a node lies in."""
    known = [(a, b, kind + 1) for kind, a, b in base_spans(text)]
    known += [(*m.span(1), len(KINDS)) for m in _SECRET.finditer(text) if _MARKED.search(m.group(1))]
    known.sort()
    found, at = [], 0
    for start, end in spans:
        while at < len(known) and known[at][1] <= start:
            at += 1
        found.append(known[at][2] if at < len(known) and known[at][0] < end else 0)
    return found


def learned(docs: DataFrame, text: str = "text") -> Field | None:
    """The field of a table of texts; None if no text has a digit or ``@``.

    Up to ``SAMPLE_TEXTS`` different texts, those of least hash, with up to ``SAMPLE_CHARS``
    characters each reach the driver.
    """
    texts = docs.select(blank_text(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    share = min(1.0, 8 * SAMPLE_TEXTS / max(1, texts.count()))
    rows = texts.select(F.xxhash64("text").alias("key"), "text")
    if share < 1:
        rows = rows.where(F.col("key") < F.lit(int(share * (1 << 64)) - (1 << 63)))
    keys = rows.select("key").distinct().orderBy("key").limit(SAMPLE_TEXTS)
    last = keys.agg(F.max("key")).head()[0]
    if last is None:
        return None
    start = F.any_value(F.substring("text", 1, SAMPLE_CHARS)).alias("start")
    rows = rows.where(F.col("key") <= last).groupBy("key").agg(start).orderBy("key").collect()
    sample = [(r["start"], nodes(r["start"])) for r in rows]
    labels = [kind for t, spans in sample for kind in weak_labels(t, spans)]
    return fit(Graph.of(sample), np.array(labels)) if labels else None


def _added(text: str, spans: list[tuple[int, int]], kinds: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The field's spans: runs of neighbours with one label, away from the patterns' spans."""
    near = {b for _, b in chain_edges(text, spans)}
    runs: list[list[int]] = []  # kind, start, end, last node
    for i, kind in enumerate(kinds):
        if not kind:
            continue
        joins = kind - 1 in (2, 3) and i in near and runs and runs[-1][3] == i - 1 and runs[-1][0] == kind - 1
        if joins:
            runs[-1][2:] = [spans[i][1], i]
        else:
            runs.append([int(kind) - 1, *spans[i], i])
    taken: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    found, at = [], 0
    for kind, start, end, _ in runs:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            found.append((kind, start, end))
    return found


def spans_of(texts: list[str], field: Field | None) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, whether by a pattern) in each text, by kind, then start."""
    base = [base_spans(t) for t in texts]
    places = [nodes(t) if field else [] for t in texts]
    labelled = [i for i, p in enumerate(places) if p]
    added = {}
    begin = 0
    while begin < len(labelled):
        end, n = begin, 0
        while end < len(labelled) and (n < _NODES_AT_ONCE):
            n += len(places[labelled[end]])
            end += 1
        part = labelled[begin:end]
        odds = field.marginals(Graph.of([(texts[i], places[i]) for i in part]))
        kinds = np.where(odds.max(axis=1) >= LEAST, odds.argmax(axis=1), 0)
        at = 0
        for i in part:
            added[i] = _added(texts[i], places[i], kinds[at : at + len(places[i])], base[i])
            at += len(places[i])
        begin = end
    return [
        sorted([(*s, True) for s in base[i]] + [(*s, False) for s in added.get(i, [])], key=lambda s: s[:3])
        for i in range(len(texts))
    ]


def masked(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """``text`` with each stretch of personal data as the name of its first kind in brackets."""
    parts, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def with_personal_data(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``docs`` with ``personal``, the spans found; a column of this name is replaced.

    It is an array of (kind, start, end, base) in code points, the end exclusive, by kind as
    in ``KINDS``, then start; ``base`` tells the patterns' spans, which always stay, from the
    field's. A null or empty text has none. Texts are read whole, each row by itself;
    repeated rows have equal spans. No rows give no rows. Without a field only the patterns
    are used.
    """
    kind = "array<struct<kind:string,start:int,end:int,base:boolean>>"
    schema = with_fields(docs.schema, [("personal", kind)])
    arrow, at = arrow_schema(schema), docs.columns.index(text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = spans_of([t or "" for t in batch.column(at).to_pylist()], field)
            spans = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in s] for s in found]
            yield with_arrays(batch, arrow, {"personal": spans})

    return docs.mapInArrow(find, schema)


def without_personal_data(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``docs`` with the names of the kinds in brackets for personal data; a null text stays."""
    schema = docs.schema
    arrow, at = arrow_schema(schema), docs.columns.index(text)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = spans_of([t or "" for t in texts], field)
            clean = [masked(t, s) if s else t for t, s in zip(texts, found, strict=True)]
            columns = [pa.array(clean, arrow.field(i).type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(mask, schema)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
