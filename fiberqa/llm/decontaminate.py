"""Benchmark passages in documents, found by greedy string tiling.

Texts and items are words of letters and digits in lower case. A run of ``minimum`` words that a
document shares with an item is a seed. Where there are seeds, the longest common runs of words
that no tile has yet are marked as tiles, again and again, so that a passage is found whole,
in pieces and in any order. A document is contaminated by an item if tiles cover enough of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import NOT_ALNUM, chunks, sequences, words_of

MINIMUM = 5
COVERAGE = 0.6
#: Bytes of items that are sent to the tasks at once. More items take more passes.
BLOCK = 8 << 20


def _windows(tokens: np.ndarray, marked: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the runs of ``size`` unmarked words, and where they begin."""
    hashes, at = sequences(tokens, np.array([0, len(tokens)]), size)
    if len(at):
        used = np.concatenate([[0], np.cumsum(marked)])
        free = used[at + size] == used[at]
        hashes, at = hashes[free], at[free]
    return hashes, at


def tiles(item: np.ndarray, text: np.ndarray, closed: np.ndarray, minimum: int) -> list[tuple[int, int, int]]:
    """(length, start in item, start in text) of greedy tiles; words ``closed`` of the text take no part."""
    marked_item, marked_text = np.zeros(len(item), bool), closed.copy()
    found: list[tuple[int, int, int]] = []
    size = max(minimum, min(20, len(item)))
    while True:
        hashes, at = _windows(text, marked_text, size)
        own, own_at = _windows(item, marked_item, size)
        order = np.argsort(own, kind="stable")
        own, own_at = own[order], own_at[order]
        low, high = np.searchsorted(own, hashes, "left"), np.searchsorted(own, hashes, "right")
        matches, longest = [], 0
        for k in np.flatnonzero(high > low):
            j = int(at[k])
            for i in own_at[low[k] : high[k]]:
                i, n = int(i), 0
                while i + n < len(item) and j + n < len(text) and not marked_item[i + n] and not marked_text[j + n] and item[i + n] == text[j + n]:
                    n += 1
                if n >= size:
                    matches.append((-n, i, j))
                    longest = max(longest, n)
        if longest > 2 * size:  # look for the long ones alone first
            size = longest
            continue
        for n, i, j in sorted(matches):
            n = -n
            if not marked_item[i : i + n].any() and not marked_text[j : j + n].any():
                marked_item[i : i + n] = marked_text[j : j + n] = True
                found.append((n, i, j))
        if size == minimum:
            # Parts of matches that a longer tile has cut are found in a further turn.
            if not matches:
                return found
        else:
            size = max(minimum, size // 2)


@dataclass
class Items:
    """Words of some items and all their seeds in order of hash."""

    ids: list[int]
    tokens: list[np.ndarray]
    seeds: np.ndarray
    owner: np.ndarray


def prepared(ids: list[int], texts: list[str], minimum: int) -> Items:
    words = words_of(pa.array(texts, pa.string()), NOT_ALNUM)
    seeds, at = sequences(words.hashes, words.first, minimum)
    order = np.argsort(seeds, kind="stable")
    tokens = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    return Items(list(ids), tokens, seeds[order], words.texts[at][order])


def _tiled(batches: Iterator[pa.RecordBatch], items: Broadcast, minimum: int, coverage: float) -> Iterator[pa.RecordBatch]:
    known: Items = items.value
    for batch in chunks(batches):
        words = words_of(batch.column("text"), NOT_ALNUM)
        hashes, at = sequences(words.hashes, words.first, minimum)
        low, high = np.searchsorted(known.seeds, hashes, "left"), np.searchsorted(known.seeds, hashes, "right")
        hit = np.flatnonzero(high > low)
        reps = high[hit] - low[hit]
        place = np.repeat(at[hit], reps)
        item = known.owner[np.repeat(low[hit] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())]
        text = words.texts[place] if len(place) else place
        order = np.lexsort((place, item, text))
        place, item, text = place[order], item[order], text[order]
        cut = np.flatnonzero(np.concatenate([[True], (item[1:] != item[:-1]) | (text[1:] != text[:-1])])) if len(place) else np.zeros(0, np.int64)
        rows = []
        for a, b in zip(cut, np.append(cut[1:], len(place))):
            tokens = known.tokens[item[a]]
            # Only words in seeds can be in tiles; between them one closed word stands for the rest.
            near = np.unique(place[a:b, None] + np.arange(minimum))
            if np.isin(tokens, words.hashes[near]).sum() < coverage * len(tokens):
                continue  # covered places of the item hold words that stand in seeds
            gap = np.flatnonzero(np.diff(near) > 1) + 1
            run, closed = np.insert(words.hashes[near], gap, 0), np.insert(np.zeros(len(near), bool), gap, True)
            covered = sum(n for n, _, _ in tiles(tokens, run, closed, minimum))
            if covered >= coverage * len(tokens):
                rows.append((int(text[a]), known.ids[item[a]], covered, len(tokens)))
        texts, *rest = ([r[c] for r in rows] for c in range(4))
        kept = batch.select([c for c in batch.schema.names if c != "text"]).take(pa.array(texts, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(c, pa.int64()) for c in rest]], names=[*kept.schema.names, "item_id", "covered", "n_words"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, minimum: int = MINIMUM, coverage: float = COVERAGE, key: str = "doc_id", block: int = BLOCK
) -> DataFrame:
    """(key, item_id, covered, n_words): the documents with benchmark items in them.

    ``docs(key, text)`` are held against ``benchmark(item_id, text)``. A row says that tiles of
    at least ``minimum`` words cover ``covered`` of the ``n_words`` of the item, which is at
    least the share ``coverage``. A null text has no words. An item with fewer words than
    ``minimum`` has no seed and is never found, and items without id are left out. Repeated rows
    are found alike, an empty table on either side gives none, other columns are not read.

    The items are the query set: they are sent to the tasks in blocks of a bounded size, each
    of which makes one pass over the documents, without a shuffle.
    """
    chosen = docs.select(key, F.col("text").cast("string").alias("text"))
    kinds = f"`{key}` {chosen.schema[key].dataType.simpleString()}, item_id long, covered long, n_words long"
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).na.drop()
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block + 1
    context = docs.sparkSession.sparkContext
    parts = []
    for i in range(n):
        rows = texts.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i).collect() if n > 1 else texts.collect()
        rows = sorted((r["item_id"], r["text"]) for r in rows)
        items = context.broadcast(prepared([r[0] for r in rows], [r[1] for r in rows], minimum))
        parts.append(chosen.mapInArrow(lambda it, items=items: _tiled(it, items, minimum, coverage), kinds))
    return reduce(DataFrame.union, parts)
