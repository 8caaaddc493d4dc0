"""Detector images as one array per row, and windows that are cut out of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def image_tiles(pixels: DataFrame, keys: Sequence[str], planes: Sequence[str] | None = None, x: str = "x", y: str = "y") -> DataFrame:
    """(keys, y, first, tile): the pixels of a detector row as an array of structs of ``planes``.

    ``tile[i]`` is the pixel in column ``first + i``, NULL where the table has none. Of a pixel
    that is given twice the smaller struct stays; pixels without place are left out. A row is
    as long as the detector is wide, however many images there are.
    """
    planes = [c for c in pixels.columns if c not in (*keys, x, y)] if planes is None else list(planes)
    pixel = F.struct(F.col(x).cast("int").alias("x"), F.struct(*planes).alias("pixel"))
    sorted_row = pixels.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, y).agg(F.sort_array(F.collect_list(pixel)).alias("__row"))
    row = F.col("__row")
    once = F.filter(row, lambda p, i: (i == 0) | (p["x"] > F.get(row, i - 1)["x"]))
    unique = sorted_row.withColumn("__row", once)
    # Gaps between neighbours are filled, so that a place in the array is a column.
    gap = lambda p, i: F.when(i > 0, p["x"] - F.get(row, i - 1)["x"] - 1).otherwise(0)
    nothing = F.lit(None).cast(unique.schema["__row"].dataType.elementType["pixel"].dataType)
    filled = F.flatten(F.transform(row, lambda p, i: F.concat(F.array_repeat(nothing, gap(p, i)), F.array(p["pixel"]))))
    return unique.select(*keys, y, F.get(row, F.lit(0))["x"].alias("first"), filled.alias("tile"))


def center_column(center: str = "xCenter") -> Column:
    """Detector column of a trace's center, rounded half to even."""
    return F.rint(center).cast("int")


def trace_windows(trace: DataFrame, tiles: DataFrame, keys: Sequence[str], half: int, y: str = "y") -> DataFrame:
    """(keys, fiberId, y, xCenter, window): for each trace row its pixels from ``-half`` to ``half``.

    A window is a slice of the row's tile. The traces of a row come together first, so every
    tile meets them once and is not copied for each fiber; there are as many as fibers. An
    element is NULL for a place without a pixel, and all are where the row has no tile.
    """
    place = [*keys, y]
    fibers = trace.groupBy(*place).agg(F.collect_list(F.struct("fiberId", "xCenter", center_column().alias("__x"))).alias("__fibers"))
    tile, first = F.col("tile"), F.col("first")
    cut_out = lambda f: F.array(*[F.get(tile, f["__x"] + d - first) for d in range(-half, half + 1)])
    met = fibers.join(tiles, place, "left")
    windows = F.transform("__fibers", lambda f: F.struct(f["fiberId"].alias("fiberId"), f["xCenter"].alias("xCenter"), cut_out(f).alias("window")))
    return met.select(*place, F.inline(windows)).select(*keys, "fiberId", y, "xCenter", "window")
