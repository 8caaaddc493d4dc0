"""Removal of passages that stand elsewhere, too, with suffix automata of reference shards.

A window is ``size`` successive words of a text. Its anchor is the smallest hash of the short
word runs in it, so equal windows have equal anchors, and successive windows with one anchor at
one place make a run. A reference shard is all different runs of an anchor; as runs know how often they
occur, it is small even where thousands of texts share a passage. Its suffix automaton counts
every string of the shard, the runs are streamed through it for their matching statistics, and
a window that matches and occurs twice is repeated. Runs that occur twice as a whole need no
automaton, and only the others bring their words along.

Automata are sent to the texts that share their anchor, by a join, and not to all texts: with
all shards broadcast to all texts the work would grow with the square of the corpus. A shard
with more than ``SHARD`` different runs, such as those at the edge of a very common passage, is
not gathered; its windows are counted one by one, by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.frames import cut
from .words import SPACES, Words, chunks, sequences, word_sums, words_of

#: Words of the runs whose hashes are anchors' candidates.
ANCHOR = 8
#: Different runs of an anchor that are put into one automaton, at most.
SHARD = 64
#: Windows in a run, at most, so that a mask of them fits into 64 bits.
RUN = 56


def _runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows, anchor and content hash of all runs."""
    hashes, at = sequences(words.hashes, words.first, min(ANCHOR, size))
    span = size - min(ANCHOR, size) + 1
    n = len(words.hashes)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    least[at] = hashes
    here = least.copy()
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        least[:-step] = np.minimum(least[:-step], least[step:])
        reach += step
    text = words.texts
    window = np.flatnonzero(np.arange(n) + size <= words.first[1:][text]) if n else np.zeros(0, np.int64)
    anchor, owner = least[window], text[window]
    if not len(window):
        return window, window, anchor, anchor
    # A run ends behind the window that begins with its anchor: the next one has another place for it.
    passed = here[window[:-1]] == anchor[:-1]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | passed])
    begin = np.flatnonzero(new)
    place = np.arange(len(window)) - np.repeat(begin, np.diff(np.append(begin, len(window))))
    begin = np.flatnonzero(new | (place % RUN == 0))
    count = np.diff(np.append(begin, len(window)))
    start = window[begin]
    return start, count, anchor[begin], word_sums(words.hashes, start, start + count + size - 1)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchored(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        words = words_of(batch.column("text"), SPACES, None)
        start, count, anchor, content = _runs(words, size)
        text = words.texts[start]
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        columns = [_signed(anchor), _signed(content), pa.array(keys[text]), pa.array((start - words.first[text]).astype(np.int32)), pa.array(count.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "key", "start", "n_windows"])


def _worded(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The wanted runs of each text with the hashes of their words."""
    names = ["anchor", "content", "n", "large", "words"]
    for batch in chunks(batches):
        words = words_of(batch.column("text"), SPACES, None)
        rows = []
        for i, wanted in enumerate(batch.column("wanted").to_pylist()):
            first = words.first[i]
            for w in wanted:
                a = first + w["start"]
                rows.append((w["anchor"], w["content"], w["n"], w["large"], words.hashes[a : a + w["n_windows"] + size - 1].tobytes()))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(types)], names=names)


class Automaton:
    """Suffix automaton of several word sequences that counts the occurrences of every substring."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.next.append(step)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], times: int) -> None:
        last = 0
        for word in sequence:
            q = self.next[last].get(word)
            if q is not None:  # another sequence has been here
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
            else:
                p, last = last, self._state(self.length[last] + 1, 0, {})
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            self.count[last] += times

    def close(self) -> None:
        """Occurrences of each state's strings, from those of the longer ones that end with them."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence: list[int], size: int) -> int:
        """Mask of the windows of ``sequence`` that occur more than once, by its matching statistics."""
        state = matched = mask = 0
        for i, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while state and self.length[self.link[state]] >= size:
                state = self.link[state]
                matched = self.length[state]
            if matched >= size and self.count[state] > 1:
                mask |= 1 << (i - size + 1)
        return mask


def _automata(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(anchor, content, mask) of runs that come in order of anchor and content."""
    shard: dict[int, tuple[int, bytes]] = {}
    now: int | None = None

    def closed() -> list[tuple[int, int, int]]:
        automaton = Automaton()
        runs = {c: (n, np.frombuffer(w, np.uint64).tolist()) for c, (n, w) in shard.items()}
        for n, words in runs.values():
            automaton.add(words, n)
        automaton.close()
        return [(now, c, automaton.repeated(words, size)) for c, (n, words) in runs.items() if n == 1]

    def given(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        rows = [r for r in rows if r[2]]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["anchor", "content", "mask"])

    for batch in batches:
        rows = []
        for anchor, content, n, words in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "n", "words"))):
            if anchor != now:
                if now is not None:
                    rows += closed()
                shard, now = {}, anchor
            shard[content] = (n, words)
        yield given(rows)
    if now is not None:
        yield given(closed())


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(window, anchor, content, place, n) of runs of large shards."""
    for batch in batches:
        raw = [np.frombuffer(w, np.uint64) for w in batch.column("words").to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        hashes, at = sequences(np.concatenate([*raw, np.zeros(0, np.uint64)]), first, size)
        run = np.searchsorted(first, at, "right") - 1
        columns = [batch.column(c).take(pa.array(run)) for c in ("anchor", "content", "n")]
        yield pa.RecordBatch.from_arrays([_signed(hashes), *columns, pa.array((at - first[run]).astype(np.int32))], names=["window", "anchor", "content", "n", "place"])


def repeated_runs(docs: DataFrame, size: int) -> DataFrame:
    """(key, start, mask) of the runs of ``docs(key, text)`` with windows that occur more than once."""
    anchored = docs.mapInArrow(lambda it: _anchored(it, size), "anchor long, content long, key long, start int, n_windows int")
    anchored = cut(anchored)
    common = cut(anchored.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"))
    runs = cut(anchored.join(common, "anchor"))
    first = F.min(F.struct("key", "start")).alias("first")
    different = cut(runs.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("n"), F.max("n_windows").alias("n_windows"), first))
    shards = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs"), F.min("n").alias("least")).where("runs > 1 AND least = 1")
    shards = cut(shards.select("anchor", (F.col("runs") > SHARD).alias("large")))
    wanted = different.join(shards, "anchor").select("first.key", F.struct("anchor", "content", "n", "large", "first.start", "n_windows").alias("run"))
    wanted = wanted.groupBy("key").agg(F.collect_list("run").alias("wanted"))
    worded = docs.join(wanted, "key").mapInArrow(lambda it: _worded(it, size), "anchor long, content long, n long, large boolean, words binary")
    worded = cut(worded)

    small = worded.where("NOT large").select("anchor", "content", "n", "words").repartition("anchor").sortWithinPartitions("anchor", "content")
    by_automaton = small.mapInArrow(lambda it: _automata(it, size), "anchor long, content long, mask long")
    large = worded.where("large").mapInArrow(lambda it: _windows(it, size), "window long, anchor long, content long, n long, place int")
    # Repeated rows of a text bring a run twice; it counts once.
    large = cut(large.groupBy("window", "anchor", "content", "place").agg(F.max("n").alias("n")))
    twice = cut(large.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window"))
    bit = F.expr("shiftleft(1L, place)")
    by_hash = large.where("n = 1").join(twice, "window").groupBy("anchor", "content").agg(F.bit_or(bit).alias("mask"))
    whole = different.where("n > 1").select("anchor", "content", F.expr("shiftleft(1L, n_windows) - 1").alias("mask"))
    masks = cut(whole.union(by_automaton).union(by_hash))
    return runs.join(masks, ["anchor", "content"]).select("key", "start", "mask")


def _removed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        rows = []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
            words = (text or "").encode("utf-8", "surrogatepass").split()  # at the same bytes as everywhere here
            spans = []
            if found:
                edge = np.zeros(len(words) + 1, np.int64)
                for run in found:
                    mask, start = run["mask"], run["start"]
                    for i in range(mask.bit_length()):
                        if mask >> i & 1:
                            edge[start + i] += 1
                            edge[start + i + size] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                flips = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(flips[::2], flips[1::2])]
                kept = list(compress(words, ~gone))
            else:
                kept = words
            joined = b" ".join(kept)
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), spans, joined.decode("utf-8", "replace")))
        same = [batch.column("doc_id")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
        columns = [pa.array([r[j] for r in rows], t) for j, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(same + columns, names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"])


def remove_repeated(docs: DataFrame, size: int = 35, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans, kept), one row for each row of ``docs(doc_id, text)``.

    Words are what stands between white space. Every word that a window of ``size`` words covers
    whose words also stand at any other place, in the same text or another one, is removed;
    ``spans`` are the removed stretches of words, ``kept`` is the rest joined by single spaces.
    Windows are judged on the given texts. A null text has no words. Repeated rows are copies of
    each other, and so is every long enough text in them. A missing doc_id stays missing. An
    empty table gives no rows; other columns are not read. ``texts=False`` leaves spans and kept out.
    """
    doc_id = F.col("doc_id")
    read = docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = read.withColumn("key", F.xxhash64("doc_id", "text"))
    found = repeated_runs(keyed.select("key", "text"), size)
    # Repeated rows have the same key and find the same runs, each once for every row.
    found = found.groupBy("key").agg(F.collect_set(F.struct("start", "mask")).alias("found"))
    joined = keyed.join(found, "key", "left").drop("key")
    kind = read.schema["doc_id"].dataType.simpleString()
    out = joined.mapInArrow(
        lambda it: _removed(it, size),
        f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept string",
    )
    return out if texts else out.drop("spans", "kept")
