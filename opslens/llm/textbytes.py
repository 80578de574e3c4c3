"""Words and shingles of whole Arrow batches as 64-bit hashes, computed with numpy on the bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from opslens.llm.encode import text_buffers

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers of the polynomial hashes over bytes and over words.
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of a number modulo 2^64, kept and lengthened as needed."""

    def __init__(self, base: int):
        self.base, self.found = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.found) < n:
            steps = np.full(max(n, 1 << 16), self.base, np.uint64)
            steps[0] = 1
            self.found = np.cumprod(steps, dtype=np.uint64)
        return self.found[:n]


_UP, _DOWN = _Powers(_BYTE), _Powers(pow(_BYTE, -1, 1 << 64))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts, word ends and word offsets per text (n + 1).  A word is what ASCII white space leaves."""
    data, offsets = text_buffers(texts)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before, after = inside.copy(), inside.copy()
    before[1:] &= ~inside[:-1] | edge[1:-1]
    after[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(before), np.flatnonzero(after) + 1
    return data, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, the same wherever the word stands."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP.upto(len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _DOWN.upto(len(data))[starts] if len(starts) else sums[:0])


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words, text by text, and offsets per text (n + 1).

    A text of fewer words has one shingle of all its words, a text without words none.
    """
    data, starts, ends, offsets = words(texts)
    hashes = word_hashes(data, starts, ends)
    counts = np.diff(offsets)
    n_windows = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    out = np.concatenate([[0], np.cumsum(n_windows)])
    at = np.arange(out[-1]) + np.repeat(offsets[:-1] - out[:-1], n_windows)
    length = np.repeat(np.minimum(counts, size), n_windows)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    total = length.astype(np.uint64)
    for k in range(size):
        total = total * np.uint64(_WORD) + np.where(k < length, padded[at + k], np.uint64(0))
    return mix(total), out
