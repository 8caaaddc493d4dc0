"""Linear interpolation onto a grid, as a union and two fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.frames import one_exposure
from .ordering import value_bin


def lerp(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.when(x1 == x0, y0).otherwise((y1 - y0) / (x1 - x0) * (x - x0) + y0)


def interpolate(
    grid: DataFrame, knots: DataFrame, keys: Sequence[str], x: str, y: str, out: str | None = None
) -> DataFrame:
    """Add ``out``: ``y`` of the knots with the same keys, interpolated at each grid row.

    Beyond the ends the end values hold. Knots are unique per (keys, x). Keys without
    knots give NULL.
    """
    keys, out = list(keys), out or y
    knot = F.when(F.col("__knot"), F.struct(F.col(x).alias("x"), F.col("__y").alias("y")))
    rows = (
        grid.withColumn("__knot", F.lit(False))
        .unionByName(
            knots.where(F.col(y).isNotNull()).select(*keys, x, F.col(y).alias("__y"), F.lit(True).alias("__knot")),
            allowMissingColumns=True,
        )
        .withColumn("__at", knot)
    )
    if one_exposure(keys):
        place, carried = keys, (F.lit(None), F.lit(None))
    else:
        # Pieces of the axis are filled on their own; a piece takes the nearest knots
        # outside it from a small table with one row per piece.
        rows = rows.withColumn("__piece", F.shiftright(value_bin(F.col(x)), 10))
        place = [*keys, "__piece"]
        along, back = (Window.partitionBy(*keys).orderBy(o) for o in (F.col("__piece").asc(), F.col("__piece").desc()))
        ends = (
            rows.groupBy(*place)
            .agg(F.max("__at").alias("__last"), F.min("__at").alias("__first"))
            .withColumn(
                "__from",
                F.last("__last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)),
            )
            .withColumn(
                "__to",
                F.last("__first", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)),
            )
            .select(*place, "__from", "__to")
        )
        rows = rows.join(ends, place)
        carried = (F.col("__from"), F.col("__to"))
    # Both fills run on from row to row, the second one from the far end: a frame that ends with
    # the group would be gone through again for each of its rows.
    before, after = (
        F.last("__at", ignorenulls=True).over(Window.partitionBy(*place).orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow))
        for o in (F.col(x).asc(), F.col(x).desc())
    )
    rows = rows.withColumn("__lo", F.coalesce(before, carried[0])).withColumn("__hi", F.coalesce(after, carried[1]))
    value = lerp(F.col(x), F.col("__lo.x"), F.col("__lo.y"), F.col("__hi.x"), F.col("__hi.y"))
    value = F.when(F.col("__lo").isNull(), F.col("__hi.y")).when(F.col("__hi").isNull(), F.col("__lo.y")).otherwise(value)
    return rows.where(~F.col("__knot")).select(*[c for c in grid.columns if c != out], value.alias(out))
