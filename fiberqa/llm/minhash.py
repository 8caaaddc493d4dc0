"""Near-duplicate documents by min-max hashing and exact confirmation.

Of each permutation of a document's shingles both ends are kept, the smallest and the largest
value, so that a signature of ``2 * permutations`` entries costs half the hash evaluations. A
band holds minima only or maxima only, of different permutations, so that its entries are
independent also for small sets.

Texts with equal shingle sets are one class and are compared as one. Classes that agree in a
band share a bucket. No bucket is gathered or paired out. Every member is first compared with a
few central hubs of its bucket. What is left is compared across components, but for pairs that cannot
be similar enough: in buckets of more than ``PAIRED`` classes, two texts either share a shingle that few
texts have, or their intersection is no larger than the number of common shingles of either.
In a large family of copies that rules out nearly all that no hub has linked. So every two
texts that share a bucket are linked, or connected already, or known to differ. Links are
confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.frames import cut
from .components import components
from .words import Words, chunks, mix, sequences, words_of

PERMUTATIONS = 56
#: Entries in a band: two texts at 0.8 share none of 28 bands with a chance of 4 in 10 million.
ROWS = 4
#: Hubs of a bucket that all its members are compared with, before the rest is across components.
HUBS = 4
#: Up to so many classes of a bucket, or texts with a shingle, are paired out in the last round.
PAIRED = 24


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, in order of text and hash, and where each text's begin.

    A text with fewer than ``k`` words has its whole sequence as its only shingle.
    """
    n = len(words.first) - 1
    hashes, at = sequences(words.hashes, words.first, k)
    text = words.texts[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < k))
    if len(short):
        parts, owners = [hashes], [text]
        for size in range(1, k):
            some = short[words.counts[short] == size]
            if len(some):
                whole = np.zeros(len(some), np.uint64)
                for j in range(size):
                    whole = mix(whole * np.uint64(3) + words.hashes[words.first[some] + j] + np.uint64(size))
                parts.append(whole)
                owners.append(some)
        hashes, text = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(n + 1))


def _multipliers(permutations: int) -> np.ndarray:
    return mix(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def bands(hashes: np.ndarray, first: np.ndarray, permutations: int, rows: int) -> np.ndarray:
    """One hash for each text (with shingles) and band, of min-max signatures."""
    a = _multipliers(permutations)
    n = len(first) - 1
    n_bands = permutations // rows
    out = np.zeros((n, 2 * n_bands), np.uint64)
    if not len(hashes):
        return out
    for band in range(n_bands):
        low = np.full(n, band + 1, np.uint64)
        high = np.full(n, band + 1 + n_bands, np.uint64)
        for p in range(band * rows, (band + 1) * rows):
            value = hashes * a[2 * p]
            value ^= value >> np.uint64(32)
            value *= a[2 * p + 1]
            low = mix(low + np.minimum.reduceat(value, first[:-1]))
            high = mix(high + np.maximum.reduceat(value, first[:-1]))
        out[:, band], out[:, band + n_bands] = low, high
    return out


def _signed(*columns: np.ndarray) -> list[pa.Array]:
    return [pa.array(c.view(np.int64)) for c in columns]


def _signatures(batches: Iterator[pa.RecordBatch], k: int, permutations: int, rows: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "n_shingles", "h1", "h2", "bands"]
    for batch in chunks(batches):
        words = words_of(batch.column("text"))
        hashes, first = shingles(words, k)
        sizes = np.diff(first)
        full = np.flatnonzero(sizes)
        h1, h2 = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
        per = np.zeros((len(sizes), permutations // rows * 2), np.uint64)
        if len(full):
            begins = first[full]
            h1[full] = np.add.reduceat(mix(hashes + np.uint64(1)), begins)
            h2[full] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begins)
            per[full] = bands(hashes, np.append(begins, len(hashes)), permutations, rows)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * per.shape[1]), pa.array(per.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes.astype(np.int64)), *_signed(h1, h2), lists], names=names)


def _confirmed(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b) of the pairs whose full sets are similar enough."""
    for batch in chunks(batches, "text_a"):
        n = batch.num_rows
        left = shingles(words_of(batch.column("text_a")), k)
        right = shingles(words_of(batch.column("text_b")), k)
        good = np.zeros(n, bool)
        for i in range(n):
            x, y = left[0][left[1][i] : left[1][i + 1]], right[0][right[1][i] : right[1][i + 1]]
            if not len(x) or not len(y):
                continue
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            good[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _listed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(rep, shingle) of texts."""
    for batch in chunks(batches):
        hashes, first = shingles(words_of(batch.column("text")), k)
        reps = batch.column("rep").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(reps, np.diff(first))), *_signed(hashes)], names=["rep", "shingle"])


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    with_texts = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return with_texts.mapInArrow(lambda it: _confirmed(it, k, percent), "a long, b long")


def _labelled(members: DataFrame, links: DataFrame, hops: int = 2) -> DataFrame:
    """Members whose ``component`` is the smallest text a few links away; equal ones are connected."""
    near = links.where("a != b").select("a", "b").union(links.where("a != b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    for _ in range(hops - 1):
        far = near.join(least.select(F.col("a").alias("b"), F.col("m").alias("m2")), "b")
        least = least.union(far.select("a", "m2")).groupBy("a").agg(F.min("m").alias("m"))
    component = F.coalesce("m", "rep").alias("component")
    return members.join(cut(least), F.col("rep") == F.col("a"), "left").select("bucket", "rep", "n_shingles", component)


def _open(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with the size of the bucket."""
    ends = members.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("size"))
    return cut(members.join(ends.where("least != most").select("bucket", "size"), "bucket"))


def _second(members: DataFrame) -> DataFrame:
    return members.select("bucket", *[F.col(c).alias(f"{c}2") for c in members.columns if c != "bucket"])


def _hub_pairs(members: DataFrame, hubs: int) -> DataFrame:
    """Each member beside each hub of its bucket. Every task first cuts a bucket to its own few hubs.

    A text near the middle of a family shares large buckets in most bands, so the hubs are those
    with the largest sum of bucket sizes.
    """
    reach = members.groupBy("rep").agg(F.sum("size").alias("reach"))
    order = Window.partitionBy("bucket").orderBy(F.desc("reach"), "rep")
    hub = members.join(reach, "rep").withColumn("place", F.row_number().over(order)).where(F.col("place") <= hubs)
    hub = hub.select("bucket", "rep", "n_shingles")
    return members.join(_second(hub), "bucket").where("rep != rep2")


def _rest_pairs(members: DataFrame, classes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (rep, rep2) of a bucket and different components that may still be similar enough."""
    columns = ["rep", "component", "n_shingles", "rep2", "component2", "n_shingles2"]
    small = members.where(F.col("size") <= PAIRED).drop("size")
    small = small.join(_second(small), "bucket").where("rep < rep2").select(*columns)
    large = members.where(F.col("size") > PAIRED).drop("size")

    reps = large.select("rep").distinct()
    one = ["rep", "component", "n_shingles"]
    listed = cut(texts.join(reps, "rep").mapInArrow(lambda it: _listed(it, k), "rep long, shingle long").distinct())
    spread = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    listed = cut(listed.join(spread, "shingle"))
    common = listed.where(F.col("n") > PAIRED).groupBy("rep").agg(F.count(F.lit(1)).alias("common"))
    able = large.join(common, "rep").where(F.col("common") * 100 >= F.col("n_shingles") * percent)
    # The bands before this one, so that a pair is made only in the first band that it shares.
    before = F.expr("slice(bands, 1, cast(array_position(bands, bucket) - 1 as int))").alias("before")
    with_bands = able.join(classes.select("rep", "bands"), "rep").where("array_position(bands, bucket) > 0")
    able = cut(with_bands.select("bucket", *one, "common", before))
    needed = (F.col("n_shingles") + F.col("n_shingles2")) * percent
    first_shared = ~F.arrays_overlap("before", "before2")
    enough = F.least("common", "common2") * (100 + percent) >= needed
    apart = (F.col("rep") < F.col("rep2")) & (F.col("component") != F.col("component2"))
    by_common = able.join(_second(able), "bucket").where(apart & enough & first_shared)

    rare = listed.where(F.col("n") <= PAIRED).select("rep", "shingle")
    rare = rare.join(rare.withColumnRenamed("rep", "rep2"), "shingle").where("rep < rep2").select("rep", "rep2").distinct()
    known = large.select(*one).distinct()
    by_rare = rare.join(known, "rep").join(known.select(*[F.col(c).alias(f"{c}2") for c in one]), "rep2")
    return small.union(by_common.select(*columns)).union(by_rare.select(*columns))


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    percent: int = 80,
    permutations: int = PERMUTATIONS,
    rows: int = ROWS,
    hubs: int = HUBS,
    marks: bool = False,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs(doc_id, text)``.

    Words are what stands between white space, with A-Z in lower case; shingles are ``k`` words.
    Two documents are linked if ``100 * intersection >= percent * union``. ``component_id`` is
    the smallest doc_id of a component, ``kept`` says whether the document is that one.

    A text that is null or has no words has an empty set: its own component, kept. A row without
    doc_id is linked with nothing: component_id null, kept. Rows that share a
    doc_id but not the text have a component each. Other columns of ``docs`` are not read.
    With ``marks``, three more columns tell rows of one doc_id apart: ``text_hash`` of the text
    (a null one is empty), ``h1`` and ``h2`` of the set.
    """
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = rows_in.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    signed = cut(
        hashed.mapInArrow(
            lambda it: _signatures(it, k, permutations, rows),
            "doc_id long, text_hash long, n_shingles long, h1 long, h2 long, bands array<long>",
        )
    )
    same = ["n_shingles", "h1", "h2"]
    able = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = cut(able.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    buckets = classes.select("rep", "n_shingles", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = cut(buckets.join(shared, "bucket"))  # of buckets with more than one class

    node = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = cut(rows_in.join(node, "doc_id").select(F.col("doc_id").alias("rep"), "text"))
    members = members.withColumn("component", F.col("rep"))

    def confirmed(both: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        fits = F.least("n_shingles", "n_shingles2") * 100 >= F.greatest("n_shingles", "n_shingles2") * percent
        pairs = both.where(fits).select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()
        pairs = cut(pairs if known is None else pairs.join(known, ["a", "b"], "left_anti"))
        return pairs, cut(_links(pairs, texts, k, percent))

    tested, linked = confirmed(_hub_pairs(members, hubs))
    rest = _open(_labelled(members, linked))
    _, more = confirmed(_rest_pairs(rest, classes, texts, k, percent).where("component != component2"), tested)
    links = linked.union(more)

    named = components(links)
    component = cut(classes.select(*same, "rep").join(named, F.col("rep") == F.col("node"), "left").select(*same, F.coalesce("component", "rep").alias("component_id")))
    out = signed.select("doc_id", "text_hash", *same).join(component, same, "left")
    empty = F.col("n_shingles") == 0
    component_id = F.when(F.col("doc_id").isNotNull(), F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")))
    shown = ["text_hash", "h1", "h2"] if marks else []
    return out.select("doc_id", *shown, "n_shingles", component_id.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
