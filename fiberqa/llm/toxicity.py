"""Toxicity by a bidirectional gated recurrent network over character and word inputs.

A word enters as the vector of the word itself, if it is a known one, and the mean vector of
its character trigrams. Two gated recurrent layers read a window in both directions, attention
pools their states, and a logistic unit scores the window. Windows overlap by half and cover
the whole text; the score of a text is that of its worst window.

Labels are known for texts only, so training looks for the windows that made a text toxic:
first by how much more often a word stands in toxic texts, then by the network itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.frames import cut
from .sampling import even_share, fold, labelled_sample, spread
from .words import NOT_ALNUM, Words, chunks, mix, words_of

WINDOW, STRIDE = 24, 12
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
KNOWN_WORDS, CHAR_BUCKETS = 4096, 4096
#: At most so many labelled texts of each class are learned from.
PER_CLASS = 2000
#: Characters of them in the driver. Of the longest texts, pieces from begin to end are learned.
SAMPLE_SIZE, PIECE = 8_000_000, 600
STEPS, BATCH, RATE = 500, 128, 0.01
_AT_ONCE = 2048


def _char_features(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of words ``at`` (with their ends marked), and where each word's begin."""
    sizes = words.ends[at] - words.starts[at]
    first = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(at)), sizes)
    place = np.arange(first[-1]) - first[owner]
    byte = words.data[words.starts[at][owner] + place].astype(np.uint64)
    before = np.where(place > 0, np.roll(byte, 1), 1)
    after = np.where(place < sizes[owner] - 1, np.roll(byte, -1), 2)
    return (mix(before + (byte << np.uint64(8)) + (after << np.uint64(16))) % np.uint64(CHAR_BUCKETS)).astype(np.int32), first


@dataclass
class Inputs:
    """Distinct words of some texts, and each text's words as numbers of these."""

    known: np.ndarray  # number of the known word, 0 if it is none
    chars: np.ndarray
    first_char: np.ndarray
    tokens: np.ndarray
    first: np.ndarray


def inputs(texts: pa.Array, vocabulary: np.ndarray) -> Inputs:
    words = words_of(texts, NOT_ALNUM)
    distinct, at, tokens = np.unique(words.hashes, return_index=True, return_inverse=True)
    chars, first_char = _char_features(words, at)
    known = np.zeros(len(distinct), np.int32)
    if len(vocabulary) and len(distinct):
        place = np.minimum(np.searchsorted(vocabulary, distinct), len(vocabulary) - 1)
        known = np.where(vocabulary[place] == distinct, place + 1, 0).astype(np.int32)
    return Inputs(known, chars, first_char, tokens.astype(np.int32), words.first)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the words of all windows, which of them are there, and each window's text."""
    n = np.diff(first)
    count = np.where(n == 0, 0, np.where(n <= WINDOW, 1, -(-(n - WINDOW) // STRIDE) + 1))
    text = np.repeat(np.arange(len(n)), count)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    place = (first[text] + turn * STRIDE)[:, None] + np.arange(WINDOW)
    there = place < first[text + 1][:, None]
    return np.where(there, place, 0), there, text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _embed(p: dict, known: np.ndarray, chars: np.ndarray, first_char: np.ndarray) -> np.ndarray:
    sums = np.add.reduceat(p["char"][chars], first_char[:-1]) if len(known) else np.zeros((0, CHAR_DIM), np.float32)
    return np.concatenate([p["word"][known], sums / np.diff(first_char)[:, None].astype(np.float32)], axis=1)


def _start(words: int, rng: np.random.Generator) -> dict:
    size = WORD_DIM + CHAR_DIM
    shapes = {
        "word": (words + 1, WORD_DIM), "char": (CHAR_BUCKETS, CHAR_DIM), "W": (2, size, 3 * HIDDEN), "b": (2, 1, 3 * HIDDEN),
        "U": (2, HIDDEN, 3 * HIDDEN), "A": (2 * HIDDEN, ATTENTION), "a": (ATTENTION,), "v": (ATTENTION,), "w": (2 * HIDDEN,), "c": (1,),
    }
    return {k: (rng.normal(size=s) * (0.1 if k in ("word", "char") else 0.3) * (k not in ("b", "a", "c"))).astype(np.float32) for k, s in shapes.items()}


def _forward(p: dict, before: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows. ``before``: the inputs' part of the gates (2, T, B, 3H); mask (T, B)."""
    _, steps, batch, _ = before.shape
    h = np.zeros((2, batch, HIDDEN), np.float32)
    states = np.empty((2, steps, batch, HIDDEN), np.float32)
    saved = []
    H = HIDDEN
    for t in range(steps):
        m = np.stack([mask[t], mask[steps - 1 - t]])[:, :, None]
        hu = h @ p["U"]
        gates = before[:, t, :, : 2 * H] + hu[:, :, : 2 * H]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:, :, :H], gates[:, :, H:]
        n = np.tanh(before[:, t, :, 2 * H :] + r * hu[:, :, 2 * H :])
        new = h + m * (1 - z) * (n - h)
        if keep:
            saved.append((h, hu, z, r, n, m))
        h = new
        states[:, t] = h
    both = np.concatenate([states[0], states[1, ::-1]], axis=2)
    e = np.tanh(both @ p["A"] + p["a"])
    s = np.where(mask, e @ p["v"], -1e9)
    s = np.exp(s - s.max(axis=0))
    s /= s.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", s, both)
    logit = pooled @ p["w"] + p["c"][0]
    return (logit, saved, both, e, s, pooled) if keep else logit


def _gradient(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Gradient of the mean logistic loss for inputs x (T, B, D): by parameter, by x, and the logits."""
    steps, batch, _ = x.shape
    H = HIDDEN
    turned = np.stack([x, x[::-1]])
    before = turned @ p["W"][:, None] + p["b"][:, None]
    logit, saved, both, e, s, pooled = _forward(p, before, mask, keep=True)
    d = (_sigmoid(logit) - y).astype(np.float32) / batch
    g = {"w": pooled.T @ d, "c": np.array([d.sum()], np.float32)}
    d_pool = d[:, None] * p["w"]
    d_s = np.einsum("tbh,bh->tb", both, d_pool)
    d_score = s * (d_s - (s * d_s).sum(axis=0))
    d_e = d_score[:, :, None] * p["v"] * (1 - e * e)
    g["v"] = np.einsum("tb,tba->a", d_score, e)
    g["A"] = np.einsum("tbh,tba->ha", both, d_e)
    g["a"] = d_e.sum(axis=(0, 1))
    d_both = s[:, :, None] * d_pool + d_e @ p["A"].T
    d_states = np.stack([d_both[:, :, :H], d_both[::-1, :, H:]])
    d_before = np.empty_like(before)
    d_h = np.zeros((2, batch, H), np.float32)
    g["U"] = np.zeros_like(p["U"])
    for t in range(steps - 1, -1, -1):
        h, hu, z, r, n, m = saved[t]
        d_h = d_h + d_states[:, t]
        open_ = m * (1 - z)
        d_n = d_h * open_ * (1 - n * n)
        d_z = -d_h * m * (n - h) * z * (1 - z)
        d_r = d_n * hu[:, :, 2 * H :] * r * (1 - r)
        d_before[:, t] = np.concatenate([d_z, d_r, d_n], axis=2)
        d_hu = np.concatenate([d_z, d_r, d_n * r], axis=2)
        g["U"] += np.swapaxes(h, 1, 2) @ d_hu
        d_h = d_h * (1 - open_) + d_hu @ np.swapaxes(p["U"], 1, 2)
    g["b"] = d_before.sum(axis=(1, 2))[:, None]
    flat = turned.reshape(2, steps * batch, -1)
    flat_d = d_before.reshape(2, steps * batch, -1)
    g["W"] = np.swapaxes(flat, 1, 2) @ flat_d
    d_turned = (flat_d @ np.swapaxes(p["W"], 1, 2)).reshape(turned.shape)
    return g, d_turned[0] + d_turned[1, ::-1], logit


def _logits(p: dict, x: Inputs, place: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Logit of each window."""
    if not len(place):
        return np.zeros(0, np.float32)
    embedded = _embed(p, x.known, x.chars, x.first_char)
    table = embedded @ p["W"] + p["b"]  # of distinct words, not of every place
    out = np.empty(len(place), np.float32)
    for i in range(0, len(place), _AT_ONCE):
        token = x.tokens[place[i : i + _AT_ONCE]].T
        before = np.stack([table[0][token], table[1][token[::-1]]])
        out[i : i + _AT_ONCE] = _forward(p, before, there[i : i + _AT_ONCE].T)
    return out


@dataclass
class Model:
    """What scoring needs. Without parameters every text has the score ``rest``."""

    vocabulary: np.ndarray
    parameters: dict | None
    threshold: float = 0.0
    scale: float = 1.0
    rest: float = 0.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Of each text: the score of its worst window; 0 for a text without words."""
        if self.parameters is None:
            return np.full(len(texts), self.rest)
        x = inputs(texts, self.vocabulary)
        place, there, text = windows(x.first)
        out = np.zeros(len(texts))
        logit = _logits(self.parameters, x, place, there)
        if len(text):
            begins = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            worst = np.maximum.reduceat(logit, begins)
            out[text[begins]] = _sigmoid((worst.astype(np.float64) - self.threshold) * self.scale)
        return out


def _vocabulary(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the known words, and how much more often (as log odds) each stands in toxic texts."""
    words = words_of(pa.array(texts), NOT_ALNUM)
    _, once = np.unique(mix(words.hashes + mix(words.texts.astype(np.uint64))), return_index=True)
    vocabulary, of = np.unique(words.hashes[once], return_inverse=True)
    seen, toxic = np.bincount(of), np.bincount(of, labels[words.texts[once]])
    odds = np.log((toxic + 0.5) / (labels.sum() + 1)) - np.log((seen - toxic + 0.5) / (len(labels) - labels.sum() + 1))
    enough = seen >= 3
    best = np.argsort(-np.where(enough, np.abs(odds), -1), kind="stable")[:KNOWN_WORDS]
    best = np.sort(best[enough[best]])
    return vocabulary[best], odds[best]


def train(texts: list[str], labels: np.ndarray, steps: int = STEPS, seed: int = 1) -> Model:
    """Fit on texts with labels 0 and 1. With one class alone, every score is its label."""
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(0, np.uint64), None, rest=float(labels[0]) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    vocabulary, odds = _vocabulary(texts, labels)
    x = inputs(pa.array(texts), vocabulary)
    place, there, text = windows(x.first)
    p = _start(len(vocabulary), rng)
    p["word"][1:, 0] = np.clip(odds / 3, -2, 2)

    sign = np.concatenate([[0], odds])[x.known]
    hint = np.where(there, sign[x.tokens[place]], -9).max(axis=1)
    clean = np.flatnonzero(labels[text] == 0)
    if not len(clean) or not (labels[text] == 1).any():
        return Model(vocabulary, None, rest=float(labels.mean()))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, steps + 1):
        if step in (1, steps // 2):
            value = hint if step == 1 else _logits(p, x, place, there)
            order = np.lexsort((-value, text))
            worst = order[np.concatenate([[True], text[order][1:] != text[order][:-1]])]
            guilty = worst[labels[text[worst]] == 1]
            hard = worst[labels[text[worst]] == 0]
        chosen = np.concatenate([rng.choice(guilty, BATCH // 2), rng.choice(hard, BATCH // 4), rng.choice(clean, BATCH // 4)])
        token, mask = x.tokens[place[chosen]].T, there[chosen].T
        rows, local = np.unique(token, return_inverse=True)
        known = np.where(rng.random(len(rows)) < 0.15, 0, x.known[rows])  # the characters must do without the word at times
        first = np.concatenate([[0], np.cumsum(np.diff(x.first_char)[rows])])
        chars = x.chars[np.repeat(x.first_char[rows] - first[:-1], np.diff(first)) + np.arange(first[-1])]
        embedded = _embed(p, known, chars, first)
        g, d_x, _ = _gradient(p, embedded[local.reshape(token.shape)], mask, labels[text[chosen]])
        d_rows = np.zeros_like(embedded)
        np.add.at(d_rows, local.ravel(), d_x.reshape(-1, embedded.shape[1]))
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], known, d_rows[:, :WORD_DIM])
        share = d_rows[:, WORD_DIM:] / np.diff(first)[:, None].astype(np.float32)
        np.add.at(g["char"], chars, np.repeat(share, np.diff(first), axis=0))
        g["word"][0] = 0
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, (m, v) in moments.items():
            m += 0.1 * (g[k] - m)
            v += 0.01 * (g[k] * g[k] - v)
            p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)

    logit = _logits(p, x, place, there)
    begins = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    worst, y = np.maximum.reduceat(logit, begins).astype(np.float64), labels[text[begins]]
    order = np.argsort(worst)
    right = np.concatenate([[0], np.cumsum(y[order] == 0)]) / max(1, (y == 0).sum()) + np.concatenate([np.cumsum((y[order] == 1)[::-1])[::-1], [0]]) / max(1, (y == 1).sum())
    top = np.flatnonzero(right == right.max())
    ends = np.concatenate([[worst[order[0]] - 1], worst[order], [worst[order[-1]] + 1]])
    # In the middle of the gap between the classes, or of the best cuts if they overlap.
    threshold = float(np.median((ends[top] + ends[top + 1]) / 2))
    return Model(vocabulary, p, threshold)


def excerpt(text: str, most: int) -> str:
    """``text``, or evenly spaced pieces of it of ``most`` characters, without words cut in two."""
    if len(text) <= most:
        return text
    return " ".join(p.partition(" ")[2].rpartition(" ")[0] or p for p in spread(text, most, PIECE))


def _excerpts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        cut_down = pa.array([excerpt(t, most) for t in batch.column("text").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), cut_down, batch.column("label")], names=["doc_id", "text", "label"])


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, per_class: int = PER_CLASS, size: int = SAMPLE_SIZE
) -> Model:
    """Train on a bounded sample of the labelled documents for which ``learn`` holds.

    The sample has at most ``per_class`` texts of each class and ``size`` characters: where
    whole texts are more, the longest ones give pieces from begin to end. No text is left out
    for its length.
    """
    sample = cut(labelled_sample(docs, labels, label, F.lit(True) if learn is None else learn, per_class))
    most = even_share([r[0] for r in sample.select(F.length("text")).collect()], size)
    rows = sample.mapInArrow(lambda it: _excerpts(it, most), "doc_id long, text string, label int").collect()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], np.array([r["label"] for r in rows]))


def _scored(batches: Iterator[pa.RecordBatch], model: Model, name: str) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield batch.append_column(name, pa.array(model.scores(batch.column("text"))))


def score_toxicity(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """``columns`` of every row of ``docs`` and its score as ``name``, from 0 to 1; toxic from 0.5 on.

    All windows of the whole text count. A text that is null or has no words scores 0. Repeated
    rows score alike; an empty table gives none; other columns are not read.
    """
    chosen = docs.select(*columns, *[F.col("text").cast("string").alias("text")] * ("text" not in columns))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields)
    scored = chosen.mapInArrow(lambda it: _scored(it, model, name), f"{kinds}, `{name}` double")
    return scored if "text" in columns else scored.drop("text")


def training_fold() -> Column:
    """Documents whose labels may be learned."""
    return fold(5) != 0
