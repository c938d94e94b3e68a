"""Suffix arrays by induced sorting, and permuted common prefixes.

Induction moves whole buckets at a time, so it wants few symbols. The string of names that
the recursion sorts mostly has many; then its suffixes are ranked by doubling instead.
"""

from __future__ import annotations

import numpy as np

#: Up to so many symbols a level is sorted by induction.
FEW_SYMBOLS = 1 << 9


def _types(symbols: np.ndarray) -> np.ndarray:
    """True for a suffix smaller than the next one (S), False for a larger one (L)."""
    n = len(symbols)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(symbols[1:].astype(np.int64) - symbols[:-1])
    step[-1] = -1
    place = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(place[::-1])[::-1]
    return step[following] > 0


class _Buckets:
    """First-in-first-out chunks of suffixes per symbol."""

    def __init__(self, count: int):
        self.chunks: list[list[np.ndarray]] = [[] for _ in range(count)]

    def deal(self, suffixes: np.ndarray, symbols: np.ndarray) -> None:
        """Append suffixes, in their order, to the buckets of their symbols."""
        if not len(suffixes):
            return
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        firsts = [0, *cuts.tolist()]
        for symbol, part in zip(
            symbols[firsts].tolist(), np.split(suffixes[order], cuts), strict=True
        ):
            self.chunks[symbol].append(part)


def _induce(symbols: np.ndarray, small: np.ndarray, lms: np.ndarray, count: int) -> np.ndarray:
    """Induce the order of all suffixes from ``lms``; whole buckets at a time."""
    seeds, larger, smaller = _Buckets(count), _Buckets(count), _Buckets(count)
    seeds.deal(lms, symbols[lms])

    def previous(suffixes: np.ndarray, wanted: bool) -> np.ndarray:
        before = suffixes[suffixes > 0] - 1
        return before[small[before] == wanted]

    last = np.array([len(symbols) - 1])
    larger.deal(last, symbols[last])
    for symbol in range(count):
        chunks = larger.chunks[symbol]
        at = 0
        while at < len(chunks):
            wave, at = np.concatenate(chunks[at:]), len(chunks)
            found = previous(wave, False)
            larger.deal(found, symbols[found])
        for chunk in seeds.chunks[symbol]:
            found = previous(chunk, False)
            larger.deal(found, symbols[found])
    for symbol in reversed(range(count)):
        chunks = smaller.chunks[symbol]
        at = 0
        while at < len(chunks):
            wave, at = np.concatenate(chunks[at:]), len(chunks)
            found = previous(wave, True)
            smaller.deal(found, symbols[found])
        if larger.chunks[symbol]:
            found = previous(np.concatenate(larger.chunks[symbol])[::-1], True)
            smaller.deal(found, symbols[found])
    parts = []
    for symbol in range(count):
        parts += larger.chunks[symbol]
        parts += [chunk[::-1] for chunk in reversed(smaller.chunks[symbol])]
    return np.concatenate(parts)


def _names(symbols: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings in text order, equal ones alike; their count."""
    n = len(symbols)
    place = np.empty(n, np.int64)
    place[lms] = np.arange(len(lms))
    ends = np.append(lms[1:] + 1, n)  # a substring reaches the next one's first symbol
    lengths = (ends - lms)[place[ordered]]
    differs = np.ones(len(ordered), bool)
    alike = np.flatnonzero(lengths[1:] == lengths[:-1]) + 1
    if len(alike):
        sizes = lengths[alike]
        offsets = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        one = symbols[np.repeat(ordered[alike], sizes) + offsets]
        other = symbols[np.repeat(ordered[alike - 1], sizes) + offsets]
        firsts = np.cumsum(sizes) - sizes
        differs[alike] = np.logical_or.reduceat(one != other, firsts)
        # The last substring ends with the text, which is smaller than any symbol.
        final = place[ordered] == len(lms) - 1
        differs |= final
        differs[1:] |= final[:-1]
    names = np.empty(len(lms), np.int64)
    names[place[ordered]] = np.cumsum(differs) - 1
    return names, int(differs.sum())


def _by_doubling(symbols: np.ndarray) -> np.ndarray:
    """The order of the suffixes by ranks of ever longer prefixes."""
    n, length = len(symbols), 1
    rank = symbols.astype(np.int64)
    while True:
        following = np.zeros(n, np.int64)
        following[:-length] = rank[length:] + 1
        key = rank * (rank.max() + 2) + following
        order = np.argsort(key)
        key = key[order]
        rank[order] = np.cumsum(np.concatenate(([0], key[1:] != key[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        length *= 2


def suffix_array(symbols: np.ndarray, count: int = 256) -> np.ndarray:
    """Starts of the suffixes of ``symbols`` (below ``count``) in order; a prefix comes first."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    if count > FEW_SYMBOLS:
        return _by_doubling(symbols)
    small = _types(symbols)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(lms) > 1:
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        induced = _induce(symbols, small, lms, count)
        names, different = _names(symbols, lms, induced[is_lms[induced]])
        if different < len(lms):
            lms = lms[suffix_array(names, different)]
        else:
            lms = lms[np.argsort(names)]
    return _induce(symbols, small, lms, count)


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """In text order: how many bytes, up to ``most``, a suffix shares with the one before it.

    The permuted array of common prefixes, by comparing eight bytes at a time for those
    suffixes that agree so far.
    """
    n = len(data)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    shared = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    padded = np.concatenate((data, np.zeros(most + 8, np.uint8)))
    words = np.ndarray(n + most, "<u8", padded, strides=(1,))
    room = n - np.maximum(np.arange(n), before)
    at = 0
    while len(active) and at < most:
        differing = words[active + at] ^ words[before[active] + at]
        same = np.full(len(active), 8)
        unequal = differing != 0
        low = differing[unequal] & (~differing[unequal] + np.uint64(1))
        same[unequal] = np.bitwise_count(low - np.uint64(1)) // 8
        shared[active] += same
        active = active[~unequal]
        at += 8
    return np.minimum(np.minimum(shared, most), room)
