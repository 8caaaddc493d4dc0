"""Bins and histograms."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import _col, ratio


def _joined(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Without keys the table is an aggregate of one row.
    return df.join(table, list(keys)) if keys else df.crossJoin(F.broadcast(table))


def equal_width_bin(df: DataFrame, keys: Sequence[str], x: str, n: int, out: str) -> DataFrame:
    """Number 1…n of the equal-width, right-closed bin between the group's extremes."""
    ends = df.groupBy(*keys).agg(F.min(x).alias("__min"), F.max(x).alias("__max"))
    place = F.ceil(ratio(F.col(x) - F.col("__min"), F.col("__max") - F.col("__min")) * n)
    number = F.when(F.col(x).isNotNull(), F.least(F.lit(n), F.greatest(F.lit(1), F.coalesce(place, F.lit(1)))))
    return _joined(df, ends, keys).withColumn(out, number.cast("int")).drop("__min", "__max")


def bin_label(number: Column | str, n: int) -> Column:
    """Label of an equal-width bin on the scale 0…100."""
    return (_col(number) - 1) * ((100 + n) // n)


def step_bin(df: DataFrame, keys: Sequence[str], x: str, step: float, out: str) -> DataFrame:
    """0-based number of the right-closed bin of fixed width. Edges run from minimum - 1 and
    stay below maximum + 1; a value beyond the last edge has no bin.
    """
    ends = df.groupBy(*keys).agg((F.min(x) - 1).alias("__start"), (F.max(x) + 1).alias("__stop"))
    edges = F.ceil((F.col("__stop") - F.col("__start")) / step)
    number = F.ceil((F.col(x) - F.col("__start")) / step) - 1
    number = F.when(number <= edges - 2, number)
    return _joined(df, ends, keys).withColumn(out, number.cast("int")).drop("__start", "__stop")


def histogram(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    n: int = 30,
    lo: float | str = -5.0,
    hi: float | str = 5.0,
    density: bool = False,
) -> DataFrame:
    """Counts in ``n`` equal bins of [lo, hi], the last one closed, empty bins included.

    ``lo`` and ``hi`` are numbers, or columns that are constant within the keys.
    """
    keys = list(keys)
    low = F.col(lo) if isinstance(lo, str) else F.lit(float(lo))
    high = F.col(hi) if isinstance(hi, str) else F.lit(float(hi))
    values = df.select(*keys, F.col(x).alias("__x"), low.alias("__lo"), high.alias("__hi"))
    place = F.floor((F.col("__x") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * n)
    counts = (
        values.where((F.col("__x") >= F.col("__lo")) & (F.col("__x") <= F.col("__hi")) & (F.col("__hi") > F.col("__lo")))
        .groupBy(*keys, F.least(place, F.lit(n - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    every = (
        values.groupBy(*keys)
        .agg(F.max("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
        .withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    )
    width = (F.col("__hi") - F.col("__lo")) / n
    out = every.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("__lo") + F.col("bin") * width).alias("left"),
        (F.col("__lo") + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )
    if not density:
        return out
    totals = out.groupBy(*keys).agg(F.sum("count").alias("__all"))
    value = ratio(F.col("count").cast("double"), F.col("__all") * (F.col("right") - F.col("left")))
    return _joined(out, totals, keys).withColumn("density", value).drop("__all")


def with_normal(hist: DataFrame, keys: Sequence[str] = (), peak_scaled: bool = False) -> DataFrame:
    """Add ``normal``: the unit normal at each bin center, as a density or scaled to the
    highest count of the group.
    """
    center = (F.col("left") + F.col("right")) / 2.0
    shape = F.exp(center * center * F.lit(-0.5))
    if not peak_scaled:
        return hist.withColumn("normal", shape / math.sqrt(2.0 * math.pi))
    peak = hist.groupBy(*keys).agg(F.max("count").alias("__peak"))
    return _joined(hist, peak, keys).withColumn("normal", shape * F.col("__peak")).drop("__peak")
