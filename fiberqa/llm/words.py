"""Words, word hashes and word-sequence hashes of Arrow batches of texts, in numpy.

Everything works on the bytes of many texts at once. Memory is bounded by ``CHUNK`` bytes of
text (or one longer text): a word hash is made in blocks that stay in the cache.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 21
_BLOCK = 1 << 16
_P = 0x9E3779B97F4A7C15 | 1
_Q = 0xD6E8FEB86659FD93 | 1

#: Bytes that part words: the space and the controls from tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: The same with all ASCII punctuation and controls, so that only letters and digits make words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: A-Z to a-z, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, made once and as far as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = _Powers(_P), _Powers(_Q)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, "right")))
        at, to = int(starts[i]), int(ends[j - 1])
        up, down = _BYTES.to(to - at + 1)
        sums = np.zeros(to - at + 1, np.uint64)
        np.cumsum((data[at:to].astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


@dataclass
class Words:
    """Words of some texts: byte range and hash of each; ``first[d]`` is the first word of text d."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def texts(self) -> np.ndarray:
        """For each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a missing text is an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    return raw, offsets - lo


def words_of(texts: pa.Array, separators: np.ndarray = SPACES, fold: np.ndarray | None = LOWER) -> Words:
    data, offsets = bytes_of(texts)
    if fold is not None:
        data = fold[data]
    inside = ~separators[data]
    if len(data):
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edge = offsets[:-1][offsets[:-1] < len(data)]
        begins[edge] = inside[edge]
        last = offsets[1:][offsets[1:] > 0] - 1
        stops[last] = inside[last]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hash_words(data, starts, ends))


def word_sums(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of words from ``starts`` to ``ends``."""
    up, down = _WORDS.to(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sequences(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that lie in one text, and their first words' numbers."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _WORDS.to(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    runs = mix((sums[k:] - sums[:-k]) * down[: n - k + 1])
    stop = np.repeat(first[1:], np.diff(first))[: n - k + 1]
    at = np.flatnonzero(np.arange(n - k + 1) + k <= stop)
    return runs[at], at


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of at most ``CHUNK`` bytes of text, or of one text that is longer."""
    for batch in batches:
        i, n = 0, batch.num_rows
        if not n:
            continue
        sizes = np.diff(bytes_of(batch.column(column))[1])
        total = np.concatenate([[0], np.cumsum(sizes)])
        while i < n:
            j = max(i + 1, int(np.searchsorted(total, total[i] + CHUNK, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j
