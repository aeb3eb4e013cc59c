"""Hashes of word shingles of whole texts, for many texts in one flat array."""

from __future__ import annotations

import numpy as np

from streamlab.llm.arrow import mix

SHINGLE_WORDS = 5
#: What separates words.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 12, 13, 32]] = True
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, at least n of them."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 20), base, np.uint64)
        known[0] = 1
        _POWERS[base] = known = np.multiply.accumulate(known)
    return known


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and where each text's words begin in that list (one more entry than texts)."""
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(begin, offsets)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every five words in a row, and where each text's hashes begin.

    A text of one to four words has one shingle, of all its words; one without words has none. Repeated
    shingles are repeated.
    """
    begin, end, first = word_spans(data, offsets)
    n = len(data) + 1
    total = np.zeros(n, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(BASE, n)[: n - 1], out=total[1:])
    words = mix((total[end] - total[begin]) * powers(INVERSE, n)[begin] + (end - begin).astype(np.uint64))
    counts = np.diff(first)
    shingles = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(shingles)))
    at = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], shingles)
    stop = np.repeat(first[1:], shingles)
    padded = np.concatenate((words, np.zeros(SHINGLE_WORDS, np.uint64)))
    hashes = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE_WORDS):
        hashes = hashes * np.uint64(BASE) + np.where(at + k < stop, padded[at + k], np.uint64(0))
    return mix(hashes), starts


HASHES = 128
MULTIPLIERS = mix(np.arange(1000, 1000 + HASHES, dtype=np.uint64)) | np.uint64(1)


def minhashes(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16 bits of ``HASHES`` MinHash values per text (rows); a text without shingles has zeros."""
    sizes = np.diff(starts)
    out = np.zeros((len(sizes), HASHES), np.uint16)
    some = np.flatnonzero(sizes)
    if len(some):
        for k in range(HASHES):
            least = np.minimum.reduceat(hashes * MULTIPLIERS[k], starts[:-1][some])
            out[some, k] = (mix(least) >> np.uint64(48)).astype(np.uint16)
    return out
