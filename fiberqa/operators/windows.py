"""Operators along an ordered axis or over all others of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import order_statistics


def median_filter(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    out: str,
    kernel: int = 15,
    chunk: int = 512,
) -> DataFrame:
    """Running median over ``kernel`` positions; a position without a value counts as zero,
    at the ends as well as inside. ``position`` is an integer, unique within the keys.

    The axis is cut into chunks, and the few rows next to a cut go to both sides, so that a
    long axis is not one task.
    """
    half = kernel // 2
    p = F.col(position)
    chunks = F.array_distinct(F.array(F.floor((p - half) / chunk), F.floor((p + half) / chunk)))
    frame = Window.partitionBy(*keys, "__chunk").orderBy(position).rangeBetween(-half, half)
    padded = F.concat(F.col("__near"), F.array_repeat(F.lit(0.0), F.lit(kernel) - F.size("__near")))
    return (
        df.withColumn("__chunk", F.explode(chunks))
        .withColumn("__near", F.collect_list(F.col(value).cast("double")).over(frame))
        .where(F.col("__chunk") == F.floor(p / chunk))
        .withColumn(out, F.get(F.sort_array(padded), F.lit(half)))
        .drop("__chunk", "__near")
    )


def mean_of_others(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """For each row, the mean of ``value`` over the other rows of its group."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__sum"), F.count(value).alias("__n"))
    own = F.coalesce(F.col(value), F.lit(0.0))
    others = F.col("__n") - F.when(F.col(value).isNotNull(), 1).otherwise(0)
    return (
        df.join(totals, list(keys))
        .withColumn(out, F.try_divide(F.col("__sum") - own, others.cast("double")))
        .drop("__sum", "__n")
    )


def median_of_others(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """For each row, the median of ``value`` over the other rows of its group.

    Leaving one value out moves the middle by at most one place, so three order statistics
    per group are enough for all its rows.
    """
    half = lambda n: F.floor((n - 1) / 2)
    stats = order_statistics(
        df.select(*keys, value),
        list(keys),
        value,
        {
            "__v1": lambda n: F.greatest(half(n) - 1, F.lit(0)),
            "__v2": lambda n: half(n),
            "__v3": lambda n: F.least(half(n) + 1, n - 1),
        },
    ).withColumnRenamed("n", "__n")
    x, v1, v2, v3 = F.col(value), F.col("__v1"), F.col("__v2"), F.col("__v3")
    # Even size: the rest has one middle value. Odd size: it has two.
    even = F.when(x <= v2, v3).otherwise(v2)
    odd = (F.when(x <= v1, v2).otherwise(v1) + F.when(x <= v2, v3).otherwise(v2)) / 2.0
    full = F.when(F.col("__n") % 2 == 0, (v2 + v3) / 2.0).otherwise(v2)
    rest = (
        F.when(x.isNull(), full)
        .when(F.col("__n") < 2, F.lit(None))
        .when(F.col("__n") % 2 == 0, even)
        .otherwise(odd)
    )
    return df.join(stats, list(keys), "left").withColumn(out, rest).drop("__v1", "__v2", "__v3", "__n")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of each group; Spark keeps at most k per group and task
    before it shuffles.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__pos", position).where(F.col("__pos") <= k).drop("__pos")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, last: bool = False) -> DataFrame:
    """One whole row per key: the first in ``order``, or the last one.

    An aggregation, so each task sends one row per key.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(row).select(*keys, "__row.*").select(*df.columns)
