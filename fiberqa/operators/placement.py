"""Places of rows in the order of their group, by a sort that is cut into ranges.

A window over a group gathers it in one task. Here all rows are sorted by (group, order) in
ranges of about equal size. A range knows its first row and its number of rows of each group,
and the running sum over these few numbers gives every row its place. Equal rows are told
apart by their number in the input, so that one hot value spreads over ranges as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.frames import cut

#: ``monotonically_increasing_id`` has the number of the partition above this many bits.
PARTITION_BITS = 33


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Equality of ``keys`` with the columns of the same names behind ``prefix``, nulls being equal."""
    same = F.lit(True)
    for k in keys:
        same &= left[k].eqNullSafe(right[f"{prefix}{k}"])
    return same


def sorted_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` with ``__at``, a number that grows in the given order, in ranges of one partition each.

    The input is written first: the sort reads it twice, and what tells equal rows apart must be
    the same each time, also after the loss of an executor.
    """
    numbered = cut(df).withColumn("__tie", F.monotonically_increasing_id())
    by = [*order, F.col("__tie").asc()]
    ordered = numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
    return cut(ordered.withColumn("__at", F.monotonically_increasing_id()))


def placed(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], place: str = "place", size: str = "n", at: str | None = None
) -> DataFrame:
    """Add ``place``, the 0-based place of a row in its group, and ``size``, the group's number of rows.

    Null keys are a group like others and come first. ``at`` names a column for the number of the
    row in the order of all rows: ranges have gaps between them, rows of a range have none.
    """
    keys = list(keys)
    rows = sorted_ranges(df, [*[F.col(k).asc_nulls_first() for k in keys], *order])
    rows = rows.withColumn("__range", F.shiftright("__at", PARTITION_BITS))
    counted = rows.groupBy(*keys, "__range").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__c"))
    # As many rows as there are ranges and groups.
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    running = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = cut(
        counted.select(
            *[F.col(k).alias(f"__k_{k}") for k in keys],
            F.col("__range").alias("__k___range"),
            (F.sum("__c").over(running) - F.col("__c") - F.col("__first")).alias("__shift"),
            F.sum("__c").over(group).alias("__size"),
        )
    )
    joined = rows.join(starts, null_safe(rows, starts, [*keys, "__range"], "__k_"))
    kept = [F.col(c) for c in df.columns if c not in (place, size, at)]
    number = [F.col("__at").alias(at)] if at else []
    return joined.select(*kept, (F.col("__at") + F.col("__shift")).alias(place), F.col("__size").alias(size), *number)
