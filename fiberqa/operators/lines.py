"""Selection of good emission lines, in stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import has_any, is_trace
from ..functions.stats import ratio
from ..sources.frames import cut as written
from ..sources.frames import join_per_group, small
from .interpolation import interpolate

DATASET = ("visit", "arm", "spectrograph")
STAGES = ("flags", "traces", "status", "finite", "sn", "centroid", "zone")


def exclusion_zone(lines: DataFrame, keys: Sequence[str], radius: float | Column) -> DataFrame:
    """Distinct line wavelengths, the OR of their statuses, and whether another one is
    closer than ``radius``.

    ``radius`` may be a column that is constant within ``keys``, so that each dataset has cells
    of its own width; of several values the largest counts. A dataset without a positive radius
    excludes nothing. A neighbour that close is in the same cell of width ``radius`` or the next
    one, so the extremes of each cell decide; no pair of lines is ever formed.
    """
    keys = list(keys)
    waves = lines.where(~is_trace())
    if isinstance(radius, Column):
        widest = Window.partitionBy(*keys)
        waves = (
            waves.groupBy(*keys, "wavelength")
            .agg(F.bit_or("status").alias("status"), F.max(radius).alias("__radius"))
            .withColumn("__radius", F.max("__radius").over(widest))
        )
    else:
        waves = waves.groupBy(*keys, "wavelength").agg(F.bit_or("status").alias("status")).withColumn("__radius", F.lit(float(radius)))
    has_radius = F.coalesce(F.col("__radius") > 0, F.lit(False))
    waves = waves.withColumn("__cell", F.when(has_radius, F.floor(F.col("wavelength") / F.col("__radius"))).otherwise(0))
    cells = waves.groupBy(*keys, "__cell").agg(
        F.min("wavelength").alias("__min"), F.max("wavelength").alias("__max"), F.count(F.lit(1)).alias("__n")
    )
    before = cells.select(*keys, (F.col("__cell") + 1).alias("__cell"), F.col("__max").alias("__before"))
    after = cells.select(*keys, (F.col("__cell") - 1).alias("__cell"), F.col("__min").alias("__after"))
    near = (
        (F.col("__n") > 1)
        | F.coalesce(F.col("wavelength") - F.col("__before") < F.col("__radius"), F.lit(False))
        | F.coalesce(F.col("__after") - F.col("wavelength") < F.col("__radius"), F.lit(False))
    )
    cell = [*keys, "__cell"]
    return (
        waves.join(cells.select(*cell, "__n"), cell)
        .join(before, cell, "left")
        .join(after, cell, "left")
        .select(*keys, "wavelength", "status", (has_radius & near).alias("excluded"))
    )


def dispersion_at_center(calibration: DataFrame, keys: Sequence[str] = ("arm", "spectrograph")) -> DataFrame:
    """(keys, dispersion): wavelength per pixel of the middle fiber across the middle row.

    The middle fiber is the upper one of two. Its knots on both sides of the middle of all
    rows decide; without one on each side the dispersion is NULL. Fibers of a detector are few.
    """
    keys = list(keys)
    known = calibration.where(F.col("row").isNotNull() & F.col("wavelength").isNotNull())
    fibers = F.sort_array(F.collect_set("fiberId"))
    middle = known.groupBy(*keys).agg(fibers.alias("__f"), ((F.min("row") + F.max("row")) / 2).alias("__row"))
    middle = middle.select(*keys, F.get("__f", F.floor(F.size("__f") / 2).cast("int")).alias("fiberId"), "__row")
    knot, below = F.struct("row", "wavelength"), F.col("row") <= F.col("__row")
    sides = join_per_group(known, middle, [*keys, "fiberId"]).groupBy(*keys).agg(F.max(F.when(below, knot)).alias("a"), F.min(F.when(~below, knot)).alias("b"))
    return sides.select(*keys, F.abs((F.col("b.wavelength") - F.col("a.wavelength")) / (F.col("b.row") - F.col("a.row"))).alias("dispersion"))


def line_stages(
    lines: DataFrame,
    keys: Sequence[str] = DATASET,
    is_science: bool | Column = False,
    line_flags: int = 0,
    min_sn: float = 0.0,
    max_centroid_error: float = 0.0,
    exclusion_radius: float | Column = 0.0,
) -> DataFrame:
    """Add one boolean ``ok_<stage>`` per stage, true while the line is still good.

    Zero turns a cut off. ``exclusion_radius`` is in wavelength units (dispersion times
    pixels). Traces are ignored in a dataset that also has lines, unless it is a science one.
    ``is_science`` and ``exclusion_radius`` may be columns, which differ by dataset; a NULL
    ``is_science`` is false.
    """
    keys = list(keys)
    trace = is_trace()
    out = lines.withColumn("ok_flags", ~F.col("flag"))
    by_dataset = isinstance(is_science, Column)
    if not by_dataset and is_science:
        out = out.withColumn("ok_traces", F.col("ok_flags"))
    else:
        science = F.coalesce(is_science, F.lit(False)) if by_dataset else F.lit(False)
        has_lines = lines.groupBy(*keys).agg(F.bool_or(~trace).alias("__has_lines"))
        out = (
            join_per_group(out, has_lines, keys)
            .withColumn("ok_traces", F.col("ok_flags") & (science | ~trace | ~F.col("__has_lines")))
            .drop("__has_lines")
        )
    out = out.withColumn(
        "ok_status", F.col("ok_traces") & ~has_any("status", line_flags) if line_flags else F.col("ok_traces")
    )
    measured = F.lit(True)
    for c in ("x", "y", "xErr", "yErr"):
        measured = measured & F.col(c).isNotNull()
    if "slope" in lines.columns:
        measured = measured & (F.col("slope").isNotNull() | ~trace)
    out = out.withColumn("ok_finite", F.col("ok_status") & measured)

    if min_sn > 0:
        intense = F.col("ok_finite") & F.col("flux").isNotNull() & F.col("fluxErr").isNotNull()
        sn = ratio("flux", "fluxErr")
        cut = (
            out.where(intense)
            .groupBy(*keys)
            .agg(F.least(F.avg(sn) - F.stddev_pop(sn), F.lit(float(min_sn))).alias("__cut"))
        )
        out = (
            out.join(cut, keys, "left")
            .withColumn("ok_sn", intense & F.coalesce(sn >= F.col("__cut"), F.lit(False)))
            .drop("__cut")
        )
    else:
        out = out.withColumn("ok_sn", F.col("ok_finite"))

    if max_centroid_error > 0:
        small_x = (F.col("xErr") > 0) & (F.col("xErr") < max_centroid_error)
        small_y = (F.col("yErr") > 0) & (F.col("yErr") < max_centroid_error)
        out = out.withColumn("ok_centroid", F.col("ok_sn") & small_x & (small_y | trace))
    else:
        out = out.withColumn("ok_centroid", F.col("ok_sn"))

    if isinstance(exclusion_radius, Column) or exclusion_radius > 0:
        crowded = written(
            exclusion_zone(lines, keys, exclusion_radius)
            .where("excluded")
            .select(*keys, "wavelength", F.lit(True).alias("__crowded"))
        )
        # Distinct wavelengths, which are few beside the lines.
        out = (
            out.join(F.broadcast(crowded) if small(crowded) else crowded, [*keys, "wavelength"], "left")
            .withColumn("ok_zone", F.col("ok_centroid") & (F.col("__crowded").isNull() | trace))
            .drop("__crowded")
        )
    else:
        out = out.withColumn("ok_zone", F.col("ok_centroid"))
    return out


def good_lines(lines: DataFrame, keys: Sequence[str] = DATASET, **cuts) -> DataFrame:
    """Lines that pass every stage of :func:`line_stages`."""
    staged = line_stages(lines, keys, **cuts)
    return staged.where(f"ok_{STAGES[-1]}").drop(*[f"ok_{s}" for s in STAGES])


def stage_counts(staged: DataFrame, by: Sequence[str] = ("description",)) -> DataFrame:
    """Lines left after each stage, one row per (description, stage)."""
    sums = [F.count(F.when(F.col(f"ok_{s}"), F.lit(1))).alias(s) for s in STAGES]
    return staged.groupBy(*by).agg(*sums).unpivot(list(by), list(STAGES), "stage", "lines")


def with_dispersion(
    lines: DataFrame,
    calibration: DataFrame,
    keys: Sequence[str] = ("arm", "spectrograph", "fiberId"),
    row: str = "y",
    half: float = 0.5,
    places: DataFrame | None = None,
) -> DataFrame:
    """Add ``dispersion``: wavelength per pixel at the line's detector row, from a calibration
    sampled as (keys, row, wavelength) and interpolated on both sides of the row.

    The calibration is met by the distinct places of the lines, both sides in one pass; whole
    lines are only joined with the result. ``places`` may be a table that is cheaper to read and
    has all places of the lines, and others.
    """
    keys, out = list(keys), lines.where(F.col(row).isNotNull())
    at = (lines if places is None else places).select(*keys, F.col(row).alias("__at_row")).where(F.col("__at_row").isNotNull()).distinct()
    sides = at.withColumn("__upper", F.explode(F.array(F.lit(False), F.lit(True))))
    sides = sides.withColumn("__row", F.col("__at_row") + F.when(F.col("__upper"), half).otherwise(-half))
    knots = calibration.select(*keys, F.col("row").alias("__row"), F.col("wavelength").alias("__w"))
    found = interpolate(sides, knots, keys, "__row", "__w").groupBy(*keys, "__at_row")
    ends = found.agg(F.max(F.when(~F.col("__upper"), F.col("__w"))).alias("__w0"), F.max(F.when(F.col("__upper"), F.col("__w"))).alias("__w1"))
    width = F.abs(F.col("__w1") - F.col("__w0")) / (2.0 * half)
    widths = ends.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__at_row", width.alias("dispersion"))
    same = F.col(row) == F.col("__at_row")
    for k in keys:
        same &= F.col(k) == F.col(f"__k_{k}")
    return out.drop("dispersion").join(widths, same).drop("__at_row", *[f"__k_{k}" for k in keys])


def measured_lines(lines: DataFrame) -> DataFrame:
    """Lines with all six measured columns."""
    return lines.na.drop(subset=["flux", "x", "y", "xErr", "yErr", "fluxErr"])
