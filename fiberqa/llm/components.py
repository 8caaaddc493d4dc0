"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.frames import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's greater neighbours (large) or smaller ones and itself (small) on the
    smallest node next to it. Minima are pre-aggregated; no neighbourhood is gathered.
    """
    if large:
        near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("__node"), F.least("a", "m").alias("m"))
    hung = near.join(least, F.col("a") == F.col("__node"))
    if large:
        out = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("__node").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links(a, b)``; the component is its smallest node.

    Links may repeat, come in either direction or join a node with itself; links with a null
    end are no links. A node without a link to another one has no row. Every round is a few
    aggregations and joins over the links, whose skewed keys adaptive execution splits, and is
    written to the shared folder; the driver sees only a count and a checksum.
    """
    edges = links.select("a", "b").where(F.col("a") != F.col("b")).distinct()
    edges = cut(edges)
    before = _state(edges)
    while before[0]:
        edges = cut(_star(_star(edges, True), False))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("a"), "b").distinct()
    return edges.union(roots).select(F.col("a").alias("node"), F.col("b").alias("component"))
