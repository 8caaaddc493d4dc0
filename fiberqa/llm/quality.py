"""Quality of texts by pairwise ranking.

A text is a row of shares and lengths. From pairs of a preferred and another labelled text a
Bradley-Terry model learns weights: the chance that the one is preferred is the logistic
function of the weighted difference of their features. A text's score is its weighted sum,
and the cut lies at the quantile of scores below which the share of bad texts would lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import group_stats
from ..sources.frames import cut
from .sampling import labelled_sample
from .words import SPACES, bytes_of, chunks, mix, words_of

#: At most so many labelled texts of each class, and so many pairs of them, are learned from.
PER_CLASS, PAIRS = 3000, 60_000
#: The score of a text at the cut.
CUT = 0.3
RIDGE = 1e-3

_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "space": [0x20, 0x09], "line": [0x0A, 0x0D],
    "sentence": [0x2E, 0x2C, 0x3B, 0x3A], "call": [0x21, 0x3F], "bar": [0x7C], "symbol": [0x23, 0x24, 0x25, 0x26, 0x2A, 0x5E, 0x7E],
    "markup": [0x3C, 0x3E, 0x7B, 0x7D, 0x5B, 0x5D, 0x5C, 0x3D], "at": [0x40, 0x2F, 0x5F], "high": range(0x80, 0x100),
}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _n, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _n
NEWLINE = np.zeros(256, bool)
NEWLINE[[0x0A, 0x0D]] = True
FEATURES = len(_CLASSES) + 1 + 9


def _repeated(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: how many distinct units, and how often its most frequent one stands there."""
    distinct, top = np.zeros(n), np.zeros(n)
    if len(hashes):
        key = np.sort(mix(hashes ^ mix(owner.astype(np.uint64))) & np.uint64((1 << 40) - 1) | (owner.astype(np.uint64) << np.uint64(40)))
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        runs = np.diff(np.append(begin, len(key)))
        of = (key[begin] >> np.uint64(40)).astype(np.int64)
        distinct = np.bincount(of, minlength=n).astype(float)
        np.maximum.at(top, of, runs)
    return distinct, top


def features(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` numbers for each text; zeros for an empty one."""
    n = len(texts)
    words = words_of(texts, SPACES, None)
    counts = words.counts.astype(float)
    lines = words_of(texts, NEWLINE, None)
    data, offsets = bytes_of(texts)
    sizes = np.diff(offsets).astype(float)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    share = np.bincount(owner * (len(_CLASSES) + 1) + _CLASS_OF[data], minlength=n * (len(_CLASSES) + 1)).reshape(n, -1)
    share = share / np.maximum(sizes, 1)[:, None]
    distinct, top = _repeated(words.hashes, words.texts, n)
    line_kinds, line_top = _repeated(lines.hashes, lines.texts, n)
    line_counts = lines.counts.astype(float)
    same = np.zeros(n)
    if len(words.hashes) > 1:
        twice = (words.hashes[1:] == words.hashes[:-1]) & (words.texts[1:] == words.texts[:-1])
        same = np.bincount(words.texts[1:][twice], minlength=n).astype(float)
    lengths = (words.ends - words.starts).astype(float)
    mean = np.bincount(words.texts, lengths, minlength=n) / np.maximum(counts, 1)
    long = np.bincount(words.texts, lengths > 25, minlength=n) / np.maximum(counts, 1)
    more = [
        np.log1p(counts) / 10, mean / 10, long, distinct / np.maximum(counts, 1), top / np.maximum(counts, 1), same / np.maximum(counts, 1),
        np.log1p(line_counts) / 10, 1 - line_kinds / np.maximum(line_counts, 1) * (line_counts > 0), line_top / np.maximum(line_counts, 1),
    ]
    # Roots, because the first few odd characters say most.
    out = np.sqrt(np.concatenate([share, np.stack(more, axis=1)], axis=1))
    out[sizes == 0] = 0
    return out


@dataclass
class Model:
    """Without weights every text has the score ``rest``."""

    weights: np.ndarray | None
    centre: np.ndarray
    cut: float = 0.0
    scale: float = 1.0
    rest: float = 0.0

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Weighted sums, of which only differences mean something."""
        return (features(texts) - self.centre) @ self.weights

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.rest)
        x = (self.raw(texts) - self.cut) * self.scale + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, seed: int = 1) -> Model:
    """Weights from features of preferred and of other texts; the cut is left at 0."""
    if not len(good) or not len(bad):
        return Model(None, np.zeros(FEATURES), rest=1.0 if len(good) else 0.0)
    rng = np.random.default_rng(seed)
    both = np.concatenate([good, bad])
    centre, spread = both.mean(axis=0), both.std(axis=0)
    spread[spread < 1e-9] = 1
    x = (good[rng.integers(len(good), size=pairs)] - bad[rng.integers(len(bad), size=pairs)]) / spread
    w = np.zeros(x.shape[1])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (1 - chance) / pairs - RIDGE * w
        hessian = (x * (chance * (1 - chance))[:, None]).T @ x / pairs + RIDGE * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    w = w / spread
    return Model(w, centre, scale=float(4 / max(((both - centre) @ w).std(), 1e-9)))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        x = features(batch.column("text"))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), lists], names=["doc_id", "label", "x"])


def _raw(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.raw(batch.column("text")))], names=["doc_id", "s"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, per_class: int = PER_CLASS) -> Model:
    """Train on a bounded sample of the labelled documents, texts of any length.

    The cut is an exact quantile of the scores of all labelled documents for which ``learn``
    holds: the one that has the share of bad ones among them below it.
    """
    learn = F.lit(True) if learn is None else learn
    sample = labelled_sample(docs, labels, label, learn, per_class)
    rows = sample.mapInArrow(_features_of, "doc_id long, label int, x array<double>").collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    model = train(*[np.array([r["x"] for r in rows if r["label"] == y]).reshape(-1, FEATURES) for y in (1, 0)])
    if model.weights is None:
        return model
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    known = known.where(learn).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & learn)
    scored = cut(texts.mapInArrow(lambda it: _raw(it, model), "doc_id long, s double").join(known, "doc_id").select("s", "label"))
    share = scored.agg(F.avg((F.col("label") == 0).cast("int"))).first()[0]
    model.cut = group_stats(scored, [], quantiles={"cut": ("s", share)}).first()["cut"]
    return model


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(batch.column("text")))], names=["doc_id", "score"])


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), one row for each row of ``docs(doc_id, text)``; good from ``CUT`` on.

    A null text is an empty one and has a score like any other. Repeated rows score alike; an
    empty table gives none; other columns are not read. Features are of the whole text.
    """
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(lambda it: _scored(it, model), f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, score double")
