"""Words, hashes and n-grams of many texts at once, inside Arrow tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; in UTF-8 those bytes never occur inside a character,
so texts are read as bytes and never decoded. Words never cross texts. Hashes
have 64 bits and depend on nothing but the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes worked on at a time; a longer text is worked on alone, whole.
SLICE_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, _MASK, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and their inverses, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """Some texts of a batch: their bytes and where each begins and ends."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray

    def prefix_hashes(self) -> np.ndarray:
        """Running sums that ``span_hashes`` takes differences of."""
        up, _ = _power_table(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE_VALUES[self.data] * up[:-1], dtype=np.uint64, out=sums[1:])
        return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    _, down = _power_table(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """A string or binary column in slices of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, where, data = column.buffers()
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + n + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), n)
        yield Texts(low, high, held[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low])
        low = high


@dataclass
class Words:
    """Where each word begins and ends, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split_words(texts: Texts) -> Words:
    word = ~SPACE[texts.data]
    begins, last = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    filled = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[filled] = word[filled]
    closing = texts.offsets[1:][np.diff(texts.offsets) > 0] - 1
    last[closing] = word[closing]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, texts.offsets))


def lowered(texts: Texts) -> Texts:
    """A-Z in lower case."""
    return Texts(texts.low, texts.high, LOWER[texts.data], texts.offsets)


def word_hashes(texts: Texts, words: Words) -> np.ndarray:
    return span_hashes(texts.prefix_hashes(), words.starts, words.ends)


_FACTORS = np.random.default_rng(7).integers(1, _MASK, 64, dtype=np.uint64) | np.uint64(1)


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` in order; the caller drops runs that cross texts."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, n, dtype=np.uint64)
    for i in range(n):
        total += hashes[i : i + count] * _FACTORS[i]
    return mix(total)


def grams(hashes: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams within texts: their hashes, and the first of each text."""
    counts = np.maximum(words.counts - n + 1, 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    every = sequence_hashes(hashes, n)
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], counts)
    return every[at], first
