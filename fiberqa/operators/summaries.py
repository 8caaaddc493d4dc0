"""Aggregates that a caller hands in."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import group_stats

#: A probability, meaning the exact interpolated quantile, or a function from a column to an
#: aggregate of it. NULL values are missing; what a function makes of them is its own choice,
#: and all of Spark's aggregates skip them.
Aggregate = float | Callable[[Column], Column]


def summarise(
    df: DataFrame, keys: Sequence[str], column: str, aggregates: Mapping[str, Aggregate], bounded: bool | None = None
) -> DataFrame:
    """One row per group with the given aggregates of ``column``.

    Functions are evaluated in one partial aggregation. Quantiles go to the rank search of
    :mod:`fiberqa.operators.ordering`, so that a group of any size is fine for both. A row
    with a missing key belongs to no group.
    """
    wrong = [n for n, a in aggregates.items() if not callable(a) and not 0.0 <= a <= 1.0]
    if wrong:
        raise ValueError(f"a quantile needs a probability from 0 to 1: {', '.join(wrong)}")
    functions = [a(F.col(column)).alias(n) for n, a in aggregates.items() if callable(a)]
    quantiles = {n: (column, float(a)) for n, a in aggregates.items() if not callable(a)}
    if not functions and not quantiles:
        raise ValueError("no aggregate given")
    return group_stats(df, keys, functions, quantiles, bounded).select(*keys, *aggregates)
