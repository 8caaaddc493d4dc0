"""Spectra stored as arrays: one row per spectrum, parallel arrays over its pixels.

Everything that looks at one spectrum at a time is a projection of such rows, without a
shuffle; only work across fibers needs one row per pixel
(:func:`fiberqa.operators.reshape.rows_of_arrays`). A missing pixel value is NULL, or NaN,
within its array. A NULL array gives NULL. An array has no more elements than the detector
has rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def each_pixel(arrays: Sequence[str], value: Callable[..., Column]) -> Column:
    """Array of ``value(element of the first array, of the second, …)``. Arrays of different
    length are filled up with NULL.
    """
    zipped = F.arrays_zip(*arrays)
    return F.transform(zipped, lambda e: value(*[e[a] for a in arrays]))


def present(values: Column | str) -> Column:
    """The elements that are not missing, in order of size. Infinities are missing, too."""
    array = F.col(values) if isinstance(values, str) else values
    finite = F.filter(array, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.sort_array(finite)


def sorted_quantile(ordered: str, p: float) -> Column:
    """Interpolated quantile of an array column that :func:`present` made; NULL when empty."""
    position = (F.size(ordered) - 1) * F.lit(float(p))
    low, high = F.get(ordered, F.floor(position).cast("int")), F.get(ordered, F.ceil(position).cast("int"))
    return F.when(F.size(ordered) > 0, low + (high - low) * (position - F.floor(position)))


def spectrum_stats(
    df: DataFrame, column: str, quantiles: Mapping[str, float], mean: str | None = None, deviation: str | None = None
) -> DataFrame:
    """Quantiles, mean and sample deviation of one array per row. The array is put in order
    once. The deviation needs two values.
    """
    out = df.withColumn("__v", present(column))
    out = out.withColumns({n: sorted_quantile("__v", p) for n, p in quantiles.items()})
    size = F.size("__v")
    if mean or deviation:
        total = F.aggregate("__v", F.lit(0.0), lambda a, x: a + x)
        out = out.withColumn("__mean", F.when(size > 0, total / size))
    if deviation:
        squares = F.aggregate("__v", F.lit(0.0), lambda a, x: a + (x - F.col("__mean")) * (x - F.col("__mean")))
        out = out.withColumn(deviation, F.when(size > 1, F.sqrt(squares / (size - 1))))
    if mean:
        out = out.withColumn(mean, F.col("__mean"))
    return out.drop("__v", "__mean")


def _median_along(position: np.ndarray, value: np.ndarray, kernel: int) -> np.ndarray:
    """Running median of one spectrum; positions are matched by search, so gaps cost nothing."""
    if len(position) == 0:
        return np.empty(0)
    order = np.argsort(position, kind="stable")
    p, v = position[order], np.nan_to_num(value[order], nan=0.0, posinf=np.inf, neginf=-np.inf)
    half = kernel // 2
    wanted = p[:, None] + np.arange(-half, half + 1)
    at = np.minimum(np.searchsorted(p, wanted), len(p) - 1)
    near = np.where(p[at] == wanted, v[at], 0.0)
    out = np.empty(len(p))
    out[order] = np.partition(near, half, axis=1)[:, half]
    return out


def running_median(position: str, value: str, kernel: int = 15) -> Column:
    """Array of running medians over ``kernel`` positions, with the rules of
    :func:`fiberqa.operators.windows.median_filter`: a position without a value counts as zero.
    ``position`` holds integers, unique in a spectrum, in any order.
    """
    if kernel % 2 == 0:
        raise ValueError("the kernel has a middle")

    @F.pandas_udf("array<double>")
    def medians(positions: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if p is None or v is None else _median_along(np.asarray(p, dtype=np.int64), np.asarray(v, dtype=float), kernel)
                for p, v in zip(positions, values)
            ],
            dtype=object,
        )

    return medians(F.col(position), F.col(value))
