"""Byte-level BPE: texts to ids and back, from a file of ranks and a splitting pattern.

A pre-token that is a token itself is that token. Otherwise its bytes form a linked list, and the
pair of lowest rank, the leftmost of equal ones, is merged until no pair has a rank. Places wait
in one bucket for each rank; a bitmap with two levels of summary above it tells the lowest rank that
has places by three find-first-set steps. A place is not removed when its pair goes: it is stale
when it comes up and its pair no longer has that rank. A pre-token of n bytes costs O(n log n),
so texts without any space are no special case.

Pre-tokens do not touch each other, so all that a worker has not met lie in one list with gaps
between them and share one queue: taken by (rank, place), each is merged in its own order. A worker
keeps the ids of the pre-tokens met last, in two generations of at most ``KEPT`` and one block.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import shipped
from .words import chunks

#: Pre-tokens of at most ``SHORT`` characters are kept.
KEPT = 250_000
SHORT = 64
#: Pre-tokens that are in memory at once.
BLOCK = 1 << 17

#: Characters of a text whose pre-tokens are not all in memory at once.
LONG = 1 << 20

_WORD = 6
_MASK = (1 << _WORD) - 1


class RankQueue:
    """Places by rank; takes the lowest rank first and the leftmost place of it."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> _WORD) + 1)
        self.middle = [0] * ((len(self.low) >> _WORD) + 1)
        self.high = 0
        self.places: dict[int, list[int]] = {}

    def fill(self, rank: int, places: list[int]) -> None:
        """The first places of a rank."""
        self.places[rank] = places
        word, summary = rank >> _WORD, rank >> 2 * _WORD
        self.low[word] |= 1 << (rank & _MASK)
        self.middle[summary] |= 1 << (word & _MASK)
        self.high |= 1 << summary

    def push(self, rank: int, place: int) -> None:
        bucket = self.places.get(rank)
        if bucket is None:
            self.fill(rank, [place])
        else:
            bucket.append(place)

    def lowest(self) -> int | None:
        """The lowest rank that has places; None if none has."""
        if not self.high:
            return None
        summary = (self.high & -self.high).bit_length() - 1
        bits = self.middle[summary]
        word = summary << _WORD | (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return word << _WORD | (bits & -bits).bit_length() - 1

    def clear(self, rank: int) -> None:
        """Take out a rank whose places have all been taken."""
        del self.places[rank]
        word, summary = rank >> _WORD, rank >> 2 * _WORD
        self.low[word] &= ~(1 << (rank & _MASK))
        if not self.low[word]:
            self.middle[summary] &= ~(1 << (word & _MASK))
            if not self.middle[summary]:
                self.high &= ~(1 << summary)


class Codec:
    """Ids of texts, and bytes of ids. ``tokens`` maps the bytes of a token to its rank, which is its id."""

    def __init__(self, tokens: dict[bytes, int], pattern: str):
        self.tokens = tokens
        self.pattern = regex.compile(pattern)
        self.size = max(tokens.values(), default=0) + 1
        self.bytes: list[bytes | None] = [None] * self.size
        for token, rank in tokens.items():
            self.bytes[rank] = token
        self.single = [tokens.get(bytes([b])) for b in range(256)]
        if None in self.single:
            raise ValueError("the ranks lack a single byte")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @cached_property
    def pairs(self) -> dict[int, int]:
        """The rank of two ids next to each other: that of their bytes together, whichever way these were merged."""
        found = {}
        for token, rank in self.tokens.items():
            for k in range(1, len(token)):
                left, right = self.tokens.get(token[:k]), self.tokens.get(token[k:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        return found

    @cached_property
    def of_bytes(self) -> np.ndarray:
        """The rank of two bytes next to each other, -1 if they have none."""
        return np.array([[self.pairs.get(x * self.size + y, -1) for y in self.single] for x in self.single], np.int64)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens, each as little-endian unsigned 32-bit integers."""
        size, get = self.size, self.pairs.get
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        n = len(data)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        full = ends[np.diff(ends, prepend=0) > 0]
        after[full - 1] = -1
        before[full[:-1]] = -1
        rank = np.full(n, -1, np.int64)
        rank[:-1] = self.of_bytes[data[:-1], data[1:]]
        rank[full - 1] = -1
        places = np.flatnonzero(rank >= 0)
        places = places[np.argsort(rank[places], kind="stable")]
        kinds, first = np.unique(rank[places], return_index=True)
        queue = RankQueue(size)
        for r, at in zip(kinds.tolist(), np.split(places, first[1:])):
            queue.fill(r, at.tolist())
        ids, after, before, rank = np.array(self.single, np.int64)[data].tolist(), after.tolist(), before.tolist(), rank.tolist()
        buckets, push = queue.places, queue.push
        while (r := queue.lowest()) is not None:
            bucket, least = buckets[r], r
            # The leftmost last. Nothing is added to this bucket meanwhile: what a merge makes is longer.
            bucket.sort(reverse=True)
            while bucket and least >= r:
                i = bucket.pop()
                if rank[i] != r:  # stale: the place was merged into another, or its pair is a different one by now
                    continue
                j = after[i]
                ids[i] = r
                ids[j] = rank[j] = rank[i] = -1
                after[i] = k = after[j]
                if k >= 0:
                    before[k] = i
                    new = get(r * size + ids[k])
                    if new is not None:
                        rank[i] = new
                        push(new, i)
                        if new < least:
                            least = new
                h = before[i]
                if h >= 0:
                    new = get(ids[h] * size + r)
                    if new is None:
                        rank[h] = -1
                    else:
                        rank[h] = new
                        push(new, h)
                        if new < least:
                            least = new
            if not bucket:
                queue.clear(r)
        left = np.array(ids, np.int64)
        kept = left >= 0
        stops = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], ends])].tolist()
        flat = left[kept].astype("<u4").tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip(stops, stops[1:])]

    def _learn(self, pieces: list[str]) -> None:
        """Have the ids of all ``pieces`` in the young generation."""
        unmet = []
        for p in set(pieces).difference(self.young):
            ids = self.old.get(p)
            if ids is None and (token := self.tokens.get(p.encode())) is not None:
                ids = token.to_bytes(4, "little")
            if ids is None:
                unmet.append(p)
            else:
                self.young[p] = ids
        if unmet:
            self.young.update(zip(unmet, self.merge([p.encode() for p in unmet])))

    def _forget(self, pieces: list[str]) -> None:
        for p in pieces:
            if len(p) > SHORT:
                self.young.pop(p, None)
        if len(self.young) > KEPT:
            self.old, self.young = self.young, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, each as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        block: list[str] = []
        spans: list[tuple[int, int, int]] = []

        def finish() -> None:
            self._learn(block)
            for text, a, b in spans:
                out[text].append(b"".join(map(self.young.__getitem__, block[a:b])))
            self._forget(block)
            block.clear()
            spans.clear()

        for number, text in enumerate(texts):
            # A list is faster than matches one by one, but holds many times the text.
            found = self.pattern.findall(text) if len(text) <= LONG else (m.group() for m in self.pattern.finditer(text))
            pieces = iter(found)
            while True:
                a = len(block)
                block.extend(islice(pieces, BLOCK - a))
                spans.append((number, a, len(block)))
                if len(block) < BLOCK:
                    break
                finish()
        finish()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        of = self.bytes.__getitem__
        return b"".join(b"".join(map(of, numbers[k : k + BLOCK].tolist())) for k in range(0, len(numbers), BLOCK))


def read_ranks(path: str) -> dict[bytes, int]:
    """A file with one token a line: its bytes in base 64, a space and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


_MADE: dict[tuple[str, str], Codec] = {}


def _codec(name: str, pattern: str) -> Codec:
    key = (SparkFiles.get(name), pattern)
    if key not in _MADE:
        _MADE[key] = Codec(read_ranks(key[0]), pattern)
    return _MADE[key]


def _encoded(batches: Iterator[pa.RecordBatch], name: str, pattern: str) -> Iterator[pa.RecordBatch]:
    codec = _codec(name, pattern)
    for batch in chunks(batches):
        ids = codec.encode([t or "" for t in batch.column("text").to_pylist()])
        columns = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], name: str, pattern: str) -> Iterator[pa.RecordBatch]:
    codec = _codec(name, pattern)
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        out = [codec.decode(x or b"") for x in batch.column(at).to_pylist()]
        kept = [c for i, c in enumerate(batch.columns) if i != at]
        names = [n for i, n in enumerate(batch.schema.names) if i != at]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary())], names=[*names, "decoded"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids), one row for each row of ``docs(doc_id, text)``.

    ``path`` is a file of ranks on the driver, ``pattern`` splits texts into pre-tokens. ``ids`` are
    little-endian unsigned 32-bit integers. Special tokens are ordinary text. A null or empty text
    has no ids; repeated rows are encoded alike; an empty table gives none; other columns are not read.
    """
    name = shipped(docs.sparkSession, path)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(lambda it: _encoded(it, name, pattern), f"doc_id {kind}, n_tokens long, ids binary")


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows(ids, …)`` with ``decoded``, the bytes of the tokens, in the place of ``ids``.

    Null ids decode to nothing. A column ``decoded`` of ``rows`` is replaced.
    """
    name = shipped(rows.sparkSession, path)
    rows = rows.drop("decoded")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "ids"]
    return rows.mapInArrow(lambda it: _decoded(it, name, pattern), ", ".join([*kept, "decoded binary"]))

