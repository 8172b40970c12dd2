"""Hashes of words and of runs of words, straight from the bytes of a text column.

A word is a maximal run of bytes other than ASCII white space (space, \\t..\\r).  Its
hash is a polynomial over its bytes modulo 2^64, mixed; all words of a block are
hashed together from prefix sums, with no Python object per word.
"""

from __future__ import annotations

import numpy as np

from feedsync.llm.common import mix64

# Odd multipliers of the byte and word polynomials.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the byte base and of its inverse, grown when a block is longer."""

    def __init__(self):
        self.n = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * BLOCK)
            self.up = _powers(BYTE_BASE, self.n)
            self.down = _powers(pow(BYTE_BASE, -1, 1 << 64), self.n)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words of each text) of texts laid end to end in ``data``."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.cumsum(lengths)
    cut = np.zeros(len(raw) + 1, bool)  # a text begins here
    cut[ends] = True
    cut[0] = True
    word = ~_SPACE[raw]
    starts = np.flatnonzero(word & (cut[:-1] | np.r_[True, ~word[:-1]])) if len(raw) else np.zeros(0, np.int64)
    stops = np.flatnonzero(word & (cut[1:] | np.r_[~word[1:], True])) if len(raw) else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # whole words, about BLOCK bytes at a time
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + BLOCK)))
        base, end = int(starts[at]), int(stops[to - 1]) + 1
        up, down = _POWERS.upto(end - base)
        sums = np.cumsum((raw[base:end].astype(np.uint64) + np.uint64(1)) * down, dtype=np.uint64)
        s, e = starts[at:to] - base, stops[at:to] - base
        before = np.where(s > 0, sums[np.maximum(s - 1, 0)], np.uint64(0))
        hashes[at:to] = (sums[e] - before) * up[e]
        at = to
    return mix64(hashes), counts


def run_hashes(words: np.ndarray, counts: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the ``n`` words from each word on, whether they end in the same text)."""
    out = np.zeros(len(words), np.uint64)
    factor = 1
    for t in range(min(n, len(words))):
        out[: len(words) - t] += words[t:] * np.uint64(factor)
        factor = factor * WORD_BASE % (1 << 64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    return mix64(out ^ np.uint64(seed)), left >= n
