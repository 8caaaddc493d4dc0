"""Importance resampling of documents towards the words of a target table.

Features are runs of one to three words, hashed into buckets by CRC-32. A bucket's gain is the
logarithm of the ratio of its frequencies in the target and in all documents; a document weighs
the sum over its features, and Gumbel noise from a hash of its doc_id makes the largest scores
a draw without replacement.

Each task makes the features of a batch distinct by word numbers, groups them by their length in
bytes into two-dimensional arrays and updates the CRCs of a whole array column by column. What
leaves a task is one count per bucket, or one number per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.placement import placed
from ..sources.frames import cut
from .words import LOWER, NOT_ALNUM, Words, chunks, words_of

BUCKETS = 10_000
LONGEST_RUN = 3
#: Bytes of one array of features; more of the same length make further arrays.
ARRAY = 1 << 22

#: A document with fewer words is not drawn.
MIN_WORDS = 20
PERCENT = 5
SEED = 42

_SPACE = 0x20
#: The reversed polynomial of CRC-32, a fixed value.
_POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def crc_matrix(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each column of ``rows``, which holds one feature a column and one byte a row."""
    crc = np.full(rows.shape[1], 0xFFFFFFFF, np.uint32)
    for byte in rows:
        crc = _TABLE[(crc ^ byte) & 0xFF] ^ (crc >> 8)
    return ~crc


def crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[starts[i]:ends[i]]``, features of equal length together.

    A column costs about as much as six single features, so a length that has fewer features than
    six times its bytes, such as that of one endless word, is done one feature at a time.
    """
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    sizes, first = np.unique(lengths[order], return_index=True)
    out = np.empty(len(starts), np.uint32)
    for size, lo, hi in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]):
        if hi - lo < 6 * size:
            for i in order[lo:hi].tolist():
                out[i] = crc32(data[starts[i] : ends[i]])
            continue
        step = max(1, ARRAY // max(size, 1))
        for k in range(lo, hi, step):
            at = order[k : min(k + step, hi)]
            out[at] = crc_matrix(data[starts[at] + np.arange(size)[:, None]])
    return out


def _spaced(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words again, one space after each, and where they begin and end."""
    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    data = np.full(int(ends[-1]) + 1 if len(ends) else 0, _SPACE, np.uint8)
    shift = np.repeat(words.starts - starts, lengths)
    inside = np.arange(len(shift)) + np.repeat(np.arange(len(lengths)), lengths)
    data[inside] = words.data[inside + shift]
    return data, starts, ends


def _numbers(words: Words, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each different word. Equal hashes are held against the bytes."""
    _, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    like, lengths = first[number], ends - starts
    same = bool(np.all(lengths == lengths[like]))
    if same and len(starts):
        offset = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        same = np.array_equal(data[np.repeat(starts, lengths) + offset], data[np.repeat(starts[like], lengths) + offset])
    if same:
        return number
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(data[s:e].tobytes(), len(known)) for s, e in zip(starts, ends)], np.int64)


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, number of its text) of all features, one pair of arrays for each run length, words first."""
    words = words_of(texts, NOT_ALNUM, LOWER)
    data, starts, ends = _spaced(words)
    number, text = _numbers(words, data, starts, ends), words.texts
    runs, n = number, int(number.max(initial=0)) + 1
    for k in range(min(LONGEST_RUN, len(starts))):
        if k:
            # A run is known by the number of the run without its last word, and by that word.
            runs = runs[:-1] * n + number[k:]
        _, example, runs = np.unique(runs, return_index=True, return_inverse=True)
        bucket = (crcs(data, starts[example], ends[example + k]) % BUCKETS).astype(np.int64)
        inside = text[: len(text) - k] == text[k:]
        yield bucket[runs[inside]], text[: len(text) - k][inside]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in chunks(batches):
        for bucket, _ in features(batch.column("text")):
            total += np.bincount(bucket, minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "features"])


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, features) over ``texts(text)``; a bucket without features has no row. Null texts have none."""
    each = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted, "bucket long, features long")
    return each.groupBy("bucket").agg(F.sum("features").alias("features"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain), ``BUCKETS`` rows: floor(1000 ln) of the ratio of smoothed frequencies."""
    s, t = (bucket_counts(x).withColumnRenamed("features", c) for x, c in ((docs, "s"), (target, "t")))
    buckets = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket")
    # As many rows as there are buckets, whatever the tables hold.
    table = cut(buckets.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"]))
    totals = table.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    s, t, all_s, all_t = (F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t"))
    ratio = ((t + 1) * (all_s + BUCKETS)) / ((s + 1) * (all_t + BUCKETS))
    return table.crossJoin(F.broadcast(totals)).select("bucket", F.floor(F.log(ratio) * 1000).cast("long").alias("gain"))


def _weighed(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        n = batch.num_rows
        weight, counted, words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for k, (bucket, text) in enumerate(features(batch.column("text"))):
            np.add.at(weight, text, gains[bucket])
            count = np.bincount(text, minlength=n)
            counted += count
            words = count if k == 0 else words
        columns = [batch.column("doc_id"), pa.array(counted), pa.array(words), pa.array(weight)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_features", "n_words", "weight"])


def weigh(docs: DataFrame, gains: DataFrame) -> DataFrame:
    """(doc_id, n_features, n_words, weight), one row for each row of ``docs(doc_id, text)``."""
    table = np.zeros(BUCKETS, np.int64)
    for bucket, gain in gains.select("bucket", "gain").collect():  # BUCKETS rows
        table[bucket] = gain
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(lambda it: _weighed(it, table), "doc_id long, n_features long, n_words long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from the SHA-256 of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    uniform = (h + 0.5) / 4294967296.0
    return F.floor(F.log(-F.log(uniform)) * -1000).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank), one row for each row of ``docs(doc_id, text)``.

    ``rank`` is 1, 2, … for the ``percent`` of documents of at least ``min_words`` words that have
    the highest scores, ties going to the smaller doc_id and then to fewer features; null for all
    others. A null or empty text has no features and weight 0. Repeated rows are drawn one by one.
    Rows without doc_id have noise of their own, the same for all of them, and come after others of
    the same score. Empty tables give no rows, or gains from no counts. Other columns are not read.
    """
    weighed = cut(weigh(docs, bucket_gains(docs, target)).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    columns = ["doc_id", "n_features", "n_words", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    ranked = placed(weighed.where(F.col("n_words") >= min_words), [], order, "place", "n")
    drawn = F.expr(f"n * {int(percent)} div 100")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    short = weighed.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(short)
