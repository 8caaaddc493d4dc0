"""Token counts of unigram tokenizers without their tokens.

An Aho-Corasick automaton finds all pieces that end at a character. Dynamic programming over
the characters carries only the best score and the number of pieces on the best way. Of equal
scores the one whose last piece begins first wins, which is the tokenizer's own rule. A
character that is no piece costs the lowest score less ten; with byte fallback it counts as
its bytes, else a run of such characters counts as one.

As no piece goes on with white space behind other characters, the best way through a text is
made of the best ways through its groups of spaces and a word. A worker counts each group once.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import MARK, NORMAL, USER_DEFINED, PieceModel, _groups, build, crosses, parse, shipped
from .words import bytes_of, chunks, hash_words

PENALTY = 10.0


class Counter:
    """Counts of batches of texts. Knows up to ``KEPT`` groups by a 64-bit hash, then forgets all."""

    KEPT = 1_000_000

    def __init__(self, model: PieceModel):
        usable = [(p, s, kind) for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED) and p]
        scores = [s for _, s, kind in usable if kind == NORMAL] or [0.0]
        self.unknown = min(scores) - PENALTY
        self.fallback = model.byte_fallback
        self.automaton = ahocorasick.Automaton()
        for p, s, kind in usable:
            # A user's piece must win over any other way through its bytes.
            self.automaton.add_word(p, (len(p), len(p.encode()) * max(scores) - 0.1 if kind == USER_DEFINED else s))
        self.automaton.make_automaton()
        plain = model.escape and model.dummy_prefix and not model.squeeze and not model.charsmap
        self.grouped = plain and not crosses(model) and MARK in self.automaton
        self.normalizer = build(model).normalizer
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.score, self.count = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64)

    def viterbi(self, text: str) -> tuple[float, int]:
        """Score and number of pieces of the best way through a normalised text."""
        n = len(text)
        ending: list[list] = [[] for _ in range(n)]
        for end, value in self.automaton.iter(text):
            ending[end].append(value)
        best, count, odd = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for e in range(n):
            top, pieces, strange, single = -np.inf, 0, False, False
            for length, score in ending[e]:  # the longest first
                way = best[e + 1 - length] + score
                if way > top:
                    top, pieces = way, count[e + 1 - length] + 1
                single |= length == 1
            if not single and best[e] + self.unknown > top:
                top, strange = best[e] + self.unknown, True
                pieces = count[e] + (len(text[e].encode("utf-8", "surrogatepass")) if self.fallback else int(not odd[e]))
            best[e + 1], count[e + 1], odd[e + 1] = top, pieces, strange
        return best[n], count[n]

    def _learn(self, hashes: np.ndarray, names: list[bytes]) -> None:
        found = [self.viterbi(x.decode().replace(" ", MARK)) for x in names]
        merged = np.concatenate([self.hashes, hashes])
        order = np.argsort(merged, kind="stable")
        self.hashes = merged[order]
        self.score = np.concatenate([self.score, [f[0] for f in found]])[order]
        self.count = np.concatenate([self.count, np.array([f[1] for f in found], np.int64)])[order]

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of pieces and best score of each text."""
        column = column.fill_null("")
        if not self.grouped:
            return self._whole(column.to_pylist())
        marked = pc.match_substring(column, MARK)
        number, score = self._split(pc.if_else(marked, "", column))
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        if len(at):  # beside spaces such a marker joins two groups
            number[at], score[at] = self._whole(column.take(pa.array(at)).to_pylist())
        return number, score

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.viterbi(self.normalizer.normalize_str(t)) if t else (0.0, 0) for t in texts]
        return np.array([f[1] for f in found], np.int64), np.array([f[0] for f in found], np.float64)

    def _split(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """By groups."""
        data, offsets = bytes_of(pc.binary_join_element_wise(pa.scalar(" "), column, ""))
        starts, ends, first = _groups(data, offsets)
        distinct, at, token = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        for again in (False, True):
            place = np.searchsorted(self.hashes, distinct)
            there = place < len(self.hashes)
            there[there] = self.hashes[place[there]] == distinct[there]
            new = np.flatnonzero(~there)
            if again or not len(new):
                break
            if len(self.hashes) + len(new) > self.KEPT:
                self._forget()
                new = np.arange(len(distinct))
            self._learn(distinct[new], [data[starts[j] : ends[j]].tobytes() for j in at[new]])
        number = np.concatenate([[0], np.cumsum(self.count[place][token])])
        score = np.concatenate([[0.0], np.cumsum(self.score[place][token])])
        return number[first[1:]] - number[first[:-1]], score[first[1:]] - score[first[:-1]]


_MADE: dict[str, Counter] = {}


def _counter(name: str) -> Counter:
    path = SparkFiles.get(name)
    if path not in _MADE:
        with open(path, "rb") as f:
            _MADE[path] = Counter(parse(f.read()))
    return _MADE[path]


def _counted(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    counter = _counter(name)
    for batch in chunks(batches):
        number, score = counter.counts(batch.column("text"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(number), pa.array(score)], names=["doc_id", "n_tokens", "score"])


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, score), one row for each row of ``docs(doc_id, text)``.

    ``path`` is a SentencePiece model on the driver, read as a unigram vocabulary: its pieces
    and their scores. A null or empty text has no tokens and score 0. Repeated rows are counted
    alike; an empty table gives none; other columns are not read.
    """
    name = shipped(docs.sparkSession, path)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(lambda it: _counted(it, name), f"doc_id {kind}, n_tokens long, score double")
