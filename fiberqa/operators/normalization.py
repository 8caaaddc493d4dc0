"""Two-way median normalization and division by a group's median."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import ratio
from ..sources.frames import cut, join_per_group
from .ordering import group_stats, grouped_quantiles


def normalize_2d(df: DataFrame, group: Sequence[str], row: str, column: str, value: str, out: str) -> DataFrame:
    """value · M / (row median · column median), M the median of the whole group."""
    group = list(group)
    df = cut(df)
    rows, columns, whole = grouped_quantiles(
        df, [[*group, row], [*group, column], group], value, {"__row": 0.5}, {"__column": 0.5}, {"__whole": 0.5}
    )
    scale = F.col("__column") * ratio("__row", "__whole")
    return (
        join_per_group(join_per_group(df, rows.join(whole, group), [*group, row]), columns, [*group, column])
        .withColumn(out, ratio(value, scale))
        .drop("__row", "__column", "__whole")
    )


def against_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str, divide: bool = False
) -> DataFrame:
    """``value`` minus, or over, the median of its group."""
    df = cut(df)
    middle = group_stats(df, keys, quantiles={"__mid": (value, 0.5)})
    joined = join_per_group(df, middle, list(keys)) if keys else df.crossJoin(F.broadcast(middle))
    result = ratio(value, "__mid") if divide else F.col(value) - F.col("__mid")
    return joined.withColumn(out, result).drop("__mid")
