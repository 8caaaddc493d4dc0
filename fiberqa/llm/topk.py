"""Exact top-k inner products with a pivot-distance index.

Vectors are keyed by their nearest pivot and the distance to it. In that order they are packed
into blocks, each an annulus around one pivot with a bounded number of vectors. For a query q
and an annulus, the triangle inequality bounds the distance from below by the gap between the
annulus and the query's own distance to the pivot, and so the inner product from above, since
2 q.x = |q|^2 + |x|^2 - |q - x|^2. Annuli that cannot reach a query's k-th best score so far
are passed over.

Queries come in packs. A first bound for the k-th best score comes from the sample that the
pivots are taken from; it decides which packs and annuli meet at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.frames import cut

#: Pivots, and the bounded sample they are chosen from. Every vector is indexed.
PIVOTS, SAMPLE = 32, 2048
#: Vectors in an annulus and queries in a pack, at most.
BLOCK, PACK = 1024, 256
_EXACT = float(1 << 53)
INDEX_SCHEMA = "pivot int, low double, high double, norm double, n int, ids binary, vectors binary"
PACK_SCHEMA = "pack_norm double, near array<double>, far array<double>, floor double, n_queries int, query_ids binary, queries binary, floors binary"


def scaled(column: str, factor: int = 256) -> Column:
    """floor(factor * x) of each component x; null if the vector or a component is missing or not finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(F.col(column).isNotNull() & ~bad, F.transform(column, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, as doubles; a shorter vector goes on with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors of the sample, each far from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < count and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def _keyed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        distance = _distances(_matrix(batch.column("v"), width), pivots)
        pivot = distance.argmin(axis=1)
        columns = [pa.array(pivot.astype(np.int32)), pa.array(distance[np.arange(len(pivot)), pivot]), batch.column("vec_id"), batch.column("v")]
        yield pa.RecordBatch.from_arrays(columns, names=["pivot", "distance", "vec_id", "v"])


def _annuli(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Blocks of successive rows with one pivot, of a partition in order of pivot and distance."""
    for batch in batches:
        pivot, distance = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "distance"))
        ids, x = batch.column("vec_id").to_numpy(zero_copy_only=False), _matrix(batch.column("v"), width)
        edges = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), len(pivot)]
        rows = []
        for a, b in zip(edges, edges[1:]):
            for i in range(a, b, BLOCK):
                j = min(b, i + BLOCK)
                norm = float((x[i:j] ** 2).sum(axis=1).max())
                rows.append((int(pivot[i]), float(distance[i:j].min()), float(distance[i:j].max()), norm, j - i, ids[i:j].tobytes(), x[i:j].tobytes()))
        yield _batch(rows, [pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.binary(), pa.binary()], INDEX_SCHEMA)


def _batch(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integers; exact as doubles while they are small, else as Python integers."""
    if len(q) and len(x) and q.shape[1] * np.abs(q).max(initial=0) * np.abs(x).max(initial=0) >= _EXACT:
        exact = np.array([[int(v) for v in r] for r in q], object).reshape(q.shape) @ np.array([[int(v) for v in r] for r in x], object).reshape(x.shape).T
        return exact.astype(np.int64)
    return (q @ x.T).astype(np.int64)


#: Stands for no score; its negative is a number, too.
_NONE = np.iinfo(np.int64).min + 1


def _packs(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, sample: np.ndarray, sample_ids: np.ndarray, width: int, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every, q_all = batch.column("vec_id").to_numpy(zero_copy_only=False), _matrix(batch.column("v"), width)
        rows = []
        for i in range(0, len(every), PACK):
            ids, q = every[i : i + PACK], q_all[i : i + PACK]
            s = _scores(q, sample)
            s[ids[:, None] == sample_ids[None, :]] = _NONE
            floors = np.partition(s, s.shape[1] - k, axis=1)[:, -k].astype(float) if s.shape[1] >= k else np.full(len(q), float(_NONE))
            d = _distances(q, pivots)
            rows.append((float((q * q).sum(axis=1).max()), d.min(axis=0).tolist(), d.max(axis=0).tolist(), float(floors.min()), len(q), ids.tobytes(), q.tobytes(), floors.tobytes()))
        doubles = pa.list_(pa.float64())
        yield _batch(rows, [pa.float64(), doubles, doubles, pa.float64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()], PACK_SCHEMA)


def _bound(norm_q, norm_x, gap):
    """Greatest inner product across a gap of distances; a little room for rounding."""
    return (norm_q + norm_x - gap * gap) / 2 * (1 + 1e-12) + 1


def _searched(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, width: int, k: int) -> Iterator[pa.RecordBatch]:
    names = ["query_id", "vec_id", "score"]

    def given(pack: tuple) -> pa.RecordBatch:
        ids, score, place = pack[2:5]
        rows, columns = np.nonzero(score > _NONE)
        return pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(place[rows, columns]), pa.array(score[rows, columns])], names=names)

    now: tuple | None = None
    for batch in batches:
        table = batch.to_pydict()
        by_pack: dict[tuple[bytes, bytes], list[int]] = {}
        for i in range(batch.num_rows):
            by_pack.setdefault((table["query_ids"][i], table["queries"][i]), []).append(i)
        for name, rows in by_pack.items():
            if now is None or now[0] != name:
                if now is not None:
                    yield given(now)
                ids = np.frombuffer(name[0], np.int64)
                q = np.frombuffer(name[1], np.float64).reshape(len(ids), width)
                floors = np.frombuffer(table["floors"][rows[0]], np.float64)
                now = (name, q, ids, np.full((len(ids), k), _NONE), np.zeros((len(ids), k), np.int64), floors, _distances(q, pivots), (q * q).sum(axis=1))
            _, q, ids, score, place, floors, d, norms = now
            bounds = []
            for i in rows:
                own = d[:, table["pivot"][i]]
                gap = np.maximum(0, np.maximum(own - table["high"][i], table["low"][i] - own))
                bounds.append(_bound(norms, table["norm"][i], gap))
            for i, bound in sorted(zip(rows, bounds), key=lambda r: -r[1].max()):
                able = np.flatnonzero(bound >= np.maximum(floors, score[:, -1].astype(float)))
                if not len(able):
                    continue
                some = np.frombuffer(table["ids"][i], np.int64)
                x = np.frombuffer(table["vectors"][i], np.float64).reshape(len(some), width)
                s = _scores(q[able], x)
                s[ids[able][:, None] == some[None, :]] = _NONE
                both = np.concatenate([score[able], s], axis=1)
                owner = np.concatenate([place[able], np.broadcast_to(some, s.shape)], axis=1)
                order = _top(both, owner, k)
                score[able], place[able] = np.take_along_axis(both, order, 1), np.take_along_axis(owner, order, 1)
    if now is not None:
        yield given(now)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each row in order, ties to the smaller id."""
    least = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
    rows, places = np.nonzero(scores >= least)  # all that tie with the k-th, so that the smaller id wins
    order = np.lexsort((ids[rows, places], -scores[rows, places], rows))
    rows, places = rows[order], places[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return places[rank < k].reshape(len(scores), k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest inner products of each query, ties to the smaller vec_id.

    Both tables are (vec_id, v) with ``v`` an array of integers. A query is not compared with
    rows of its own vec_id; it has fewer than ``k`` rows if there are no more candidates. Rows
    with a null vec_id or v take no part. Where queries share a vec_id, the smallest vector is
    the query; candidates that share one are candidates each. A shorter vector goes on with
    zeros. Empty tables give no rows; other columns are not read.

    The result is exact: the sample only says where the pivots lie. Packs of queries meet
    blocks of vectors, not rows. Ties of distance do not bind vectors to one partition.
    """
    data = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v").na.drop()
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"), "v").na.drop().groupBy("vec_id").agg(F.min("v").alias("v"))
    few = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    width = max(1, *(side.agg(F.max(F.size("v"))).first()[0] or 0 for side in (data, asked)))
    sample_ids = np.array([r["vec_id"] for r in few], np.int64)
    known = _matrix(pa.array([r["v"] for r in few], pa.list_(pa.int64())), width) if few else np.zeros((0, width))
    pivot = choose_pivots(known, pivots) if few else np.zeros((1, width))

    keyed = data.mapInArrow(lambda it: _keyed(it, pivot, width), "pivot int, distance double, vec_id long, v array<long>")
    ordered = keyed.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
    index = cut(ordered.mapInArrow(lambda it: _annuli(it, width), INDEX_SCHEMA))
    asked = asked.mapInArrow(lambda it: _keyed(it, pivot, width), "pivot int, distance double, vec_id long, v array<long>")
    asked = asked.repartitionByRange("pivot", "distance", "vec_id").sortWithinPartitions("pivot", "distance", "vec_id")
    packs = cut(asked.mapInArrow(lambda it: _packs(it, pivot, known, sample_ids, width, k), PACK_SCHEMA))

    place = F.col("pivot") + 1
    gap = F.greatest(F.element_at("near", place) - F.col("high"), F.col("low") - F.element_at("far", place), F.lit(0.0))
    met = packs.join(index, _bound(F.col("pack_norm"), F.col("norm"), gap) >= F.col("floor"))
    found = met.mapInArrow(lambda it: _searched(it, pivot, width, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
