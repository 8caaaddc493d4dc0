"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(whole: str | bytes, most: int, piece: int) -> list:
    """Parts of ``whole`` of ``piece`` each, evenly spaced from its begin to its end, ``most`` together.

    All of it where it is no longer than ``most``.
    """
    if len(whole) <= most:
        return [whole]
    piece = max(1, min(piece, most))
    starts = np.linspace(0, len(whole) - piece, most // piece).astype(int) if most else []
    return [whole[a : a + piece] for a in starts]


def even_share(lengths: list[int], total: int) -> int:
    """The greatest length such that texts cut to it have at most ``total`` together.

    What short texts leave of an equal share goes to the longer ones.
    """
    left = total
    for n, length in enumerate(sorted(lengths)):
        fair = left // (len(lengths) - n)
        if length > fair:
            return fair
        left -= length
    return max(lengths, default=0)


def fold(modulus: int) -> Column:
    """The fold of a document; -1 without doc_id. Such a row is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(-1))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` documents of label 1 and as many of label 0.

    Documents are taken in order of a hash of their doc_id, each task sending no more than the
    bound. A document with several labels has the largest; null labels are none. Of several
    texts of one doc_id the smallest counts. Whole texts of any length; null is empty.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
    )
    known = known.where(learn).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The chosen ids are at most 2 * per_class rows, whatever the size of the table.
    few = F.broadcast(chosen[0].union(chosen[1]))
    return texts.join(few, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
