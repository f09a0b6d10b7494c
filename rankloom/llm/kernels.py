"""Numpy kernels over the bytes of many texts at once: words, lines and rolling hashes.

Hashes are polynomials modulo 2^64 over random byte values, finished by a 64-bit mixer. Two
different strings share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts worked on at once, in bytes; a longer text is worked on alone.
BLOCK = 1 << 19

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOW = 20
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept up to the size of a block."""
    table = _powers[base]
    if len(table) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        table = np.multiply.accumulate(steps)
        if n <= BLOCK + 1:
            _powers[base] = table
    return table[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any runs of a sequence from one pass of prefix sums."""

    def __init__(self, values: np.ndarray) -> None:
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _power(_BASE, len(values)), out=self.sums[1:])
        self.back = _power(_INVERSE, len(values) + 1)

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        """Hash of each run of n."""
        if len(self.sums) <= n:
            return np.zeros(0, np.uint64)
        return mix((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n])


@dataclass
class Words:
    """Words of a block of texts. Word w spans bytes start[w]:end[w]; text t has words first[t]:first[t+1]."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    rolling: Rolling

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return self.rolling.runs(self.start, self.end)


def block_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_string array and the offsets of its rows in them."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(texts.buffers()[2], np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def words(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = block_bytes(texts)
    if lower:
        data = lowered(data)
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = before[1:].copy()
    after[:-1] = inside[1:]
    if len(data):
        after[-1] = False
    before = before[:-1]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    before[edge] = False
    after[edge - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), Rolling(_BYTE[data]))


def repeats(keys: np.ndarray) -> np.ndarray:
    """Indices of keys that occur twice or more."""
    if len(keys) < 2:
        return np.zeros(0, np.int64)
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    # A table of low bits leaves few keys for the binary search.
    low = np.zeros(1 << _LOW, bool)
    low[(twice & np.uint64((1 << _LOW) - 1)).astype(np.int64)] = True
    maybe = np.flatnonzero(low[(keys & np.uint64((1 << _LOW) - 1)).astype(np.int64)])
    at = np.searchsorted(twice, keys[maybe])
    at[at == len(twice)] = 0
    return maybe[twice[at] == keys[maybe]]


def later(keys: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Those of the indices in found whose key occurs before them."""
    if not len(found):
        return found
    first = np.unique(keys[found], return_index=True)[1]
    keep = np.ones(len(found), bool)
    keep[first] = False
    return found[keep]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[t]:first[t+1]] for each t; runs may be empty."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[first])


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of size positions lie in a run of n that begins at one of at."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    return np.cumsum(edges[:-1]) > 0
