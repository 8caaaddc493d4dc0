"""Extraction quality: pixels of a detector image against the reconstructed image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import stats as T
from ..operators.binning import histogram, with_normal
from ..operators.lines import DATASET
from ..operators.ordering import group_stats
from ..operators.tiles import center_column, image_tiles, trace_windows
from ..sources.frames import cut, fiber_keys

# Window half width, cut-out centers and half width, histogram scale, target types left out.
HALF_WIDTH = 3
CUTOUT_X = (500, 2000, 3500)
CUTOUT_Y = (3500, 2000, 500)
CUTOUT_HALF = 75
HIST_SCALE = 1.5
OTHER_TYPES = ("ENGINEERING",)
PLANES = ("image", "model", "residual", "variance", "chi", "frac_model", "frac_image")


def image_residuals(pixels: DataFrame) -> DataFrame:
    """Residual, chi, and the residual as a fraction of model and image."""
    residual = F.col("image") - F.col("model")
    return pixels.withColumns(
        {
            "residual": residual,
            "chi": T.ratio(residual, F.sqrt(F.col("variance"))),
            "frac_model": T.ratio(residual, "model"),
            "frac_image": T.ratio(residual, "image"),
        }
    )


def trace_window(trace: DataFrame, image: DataFrame, keys: Sequence[str] = DATASET, half: int = HALF_WIDTH) -> DataFrame:
    """Pixels within ``half`` of each trace: (fiberId, y, xCenter) against (x, y, …).

    ``image`` has one row per pixel, or is the result of :func:`image_tiles`, as images that
    are read more than once should be stored. The center is rounded half to even.
    ``inImage`` is false for offsets off the image.
    """
    keys = list(keys)
    tiles = image if "tile" in image.columns else image_tiles(image, keys)
    windows = trace_windows(trace, tiles, keys, half)
    pixels = windows.select(*keys, "fiberId", "y", "xCenter", F.posexplode("window").alias("__i", "__pixel"))
    planes = [F.col(f"__pixel.{c}").alias(c) for c in tiles.schema["tile"].dataType.elementType.names]
    dx = F.col("__i") - half
    return pixels.select(
        *keys, "fiberId", "y", "xCenter", dx.alias("dx"), (center_column() + dx).alias("x"), *planes, F.col("__pixel").isNotNull().alias("inImage")
    )


def extraction_stats(
    pixels: DataFrame, keys: Sequence[str] = DATASET, include_edge_zeros: bool = False
) -> DataFrame:
    """Chi, flux and residual statistics per fiber over its window pixels with mask 0.

    Pixels off the image are left out; ``include_edge_zeros`` counts them as zeros in the
    median, the robust sigma and the residual fraction.
    """
    group = [*keys, "fiberId"]
    good = F.col("mask") == 0
    inside = F.lit(True)
    if "inImage" in pixels.columns:
        inside = F.col("inImage")
        if include_edge_zeros:
            good = good | ~inside
        else:
            good = good & inside

    def valid(c: str):
        return F.when(good, F.when(inside, F.col(c)).otherwise(F.lit(0.0)))

    strictly = F.coalesce(F.col("mask") == 0, F.lit(False)) & inside
    rows = cut(
        image_residuals(pixels).withColumns(
            {
                "__chi": valid("chi"),
                "__res": valid("residual"),
                "__img": valid("image"),
                "__ok": strictly,
            }
        )
    )
    stats = group_stats(
        rows,
        group,
        [
            F.avg("x").alias("xa"),
            F.avg(F.when(F.col("__ok"), F.col("chi") * F.col("chi"))).alias("chiSquare"),
            F.avg(F.when(F.col("__ok"), F.col("image"))).alias("imAve"),
            F.avg("__chi").alias("chiAve"),
            F.avg(F.when(F.col("dx") == 0, F.col("__chi"))).alias("chiAtPeak"),
        ],
        {"q25": ("__chi", 0.25), "chiMed": ("__chi", 0.5), "q75": ("__chi", 0.75)},
    ).withColumn("chiStd", (F.col("q75") - F.col("q25")) / T.IQR_PER_SIGMA)
    return stats.drop("q25", "q75").join(_residual_fraction(rows, group), group)


def fiber_window_stats(
    trace: DataFrame,
    image: DataFrame,
    spectra: DataFrame,
    fibers: DataFrame,
    keys: Sequence[str] = DATASET,
    without: Sequence[str] = OTHER_TYPES,
    half: int = HALF_WIDTH,
) -> DataFrame:
    """Statistics of the good fibers of all target types but ``without``, from detector images.

    ``xa`` is the mean of the trace centers over all rows, ``pfsArmAve`` the mean extracted
    flux of the fiber (NULL without a spectrum), ``targetType`` comes from the configuration.
    Windows are those of :func:`trace_window`; places off the image count as zeros. A
    configuration with a ``visit`` column is joined by visit, which must then be among ``keys``.
    """
    group = [*keys, "fiberId"]
    config = [c for c in fiber_keys(fibers, "spectrograph", "fiberId") if c in group]
    good = (F.col("fiberStatus") == "GOOD") & ~F.col("targetType").isin(*without)
    chosen = fibers.where(good).select(*config, "targetType").distinct()
    trace = trace.join(chosen.select(*config), config, "left_semi")
    stats = extraction_stats(trace_window(trace, image, keys, half), keys, include_edge_zeros=True).drop("xa")
    centers = trace.groupBy(*group).agg(F.avg("xCenter").alias("xa"))
    flux = spectra.groupBy(*group).agg(F.avg("flux").alias("pfsArmAve"))
    return stats.join(centers, group).join(flux, group, "left").join(chosen, config)


def _residual_fraction(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    by_row = rows.groupBy(*group, "y").agg(F.sum("__res").alias("__r"), F.sum("__img").alias("__i"))
    by_row = by_row.withColumn("__ratio", T.ratio("__r", "__i"))
    middle = group_stats(by_row, group, quantiles={"__mid": ("__ratio", 0.5)})
    return middle.select(*group, (F.col("__mid") * 100.0).alias("resFrac"))


def residual_fraction(pixels: DataFrame, keys: Sequence[str] = DATASET) -> DataFrame:
    """Median over rows of summed residual over summed image, in percent, per fiber."""
    good = F.col("mask") == 0
    rows = image_residuals(pixels).withColumns(
        {"__res": F.when(good, F.col("residual")), "__img": F.when(good, F.col("image"))}
    )
    return _residual_fraction(rows, [*keys, "fiberId"])


def chi_by_row(pixels: DataFrame, keys: Sequence[str] = DATASET) -> DataFrame:
    """Mean chi per fiber and detector row."""
    good = F.col("mask") == 0
    chi = F.when(good, F.col("chi"))
    return image_residuals(pixels).groupBy(*keys, "fiberId", "y").agg(F.avg(chi).alias("chiAve"))


def image_summary(pixels: DataFrame, keys: Sequence[str] = DATASET, planes: Sequence[str] = PLANES) -> DataFrame:
    """Mean, median, percentiles and robust sigma of every image plane.

    All pixels of a detector have about as many distinct values: no task gathers them.
    """
    rows = image_residuals(pixels).select(*keys, *planes)
    percents = (1, 5, 25, 50, 75, 95, 99)
    marks = {f"{p}_q{q:02d}": (p, q / 100.0) for p in planes for q in percents}
    wide = group_stats(rows, keys, [F.avg(p).alias(f"{p}_mean") for p in planes], marks, bounded=False)
    per_plane = F.array(
        *[
            F.struct(
                F.lit(p).alias("plane"),
                F.col(f"{p}_mean").alias("mean"),
                *[F.col(f"{p}_q{q:02d}").alias("median" if q == 50 else f"q{q:02d}") for q in percents],
            )
            for p in planes
        ]
    )
    out = wide.select(*keys, F.explode(per_plane).alias("__p")).select(*keys, "__p.*")
    return out.withColumn("sigma", (F.col("q75") - F.col("q25")) * T.IQR_ROBUST)


def color_range(table: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Color scale limits: first and last percentile."""
    return group_stats(table, keys, quantiles={"vmin": (column, 0.01), "vmax": (column, 0.99)})


def cutouts(pixels: DataFrame) -> DataFrame:
    """Pixels inside the nine cut-outs, with the cut-out's center. They do not overlap."""

    def nearest(column: str, centers: Sequence[int]):
        out = F.lit(None).cast("int")
        for c in centers:
            inside = (F.col(column) >= c - CUTOUT_HALF) & (F.col(column) < c + CUTOUT_HALF)
            out = F.when(inside, F.lit(c)).otherwise(out)
        return out

    return pixels.withColumns({"xCut": nearest("x", CUTOUT_X), "yCut": nearest("y", CUTOUT_Y)}).where(
        F.col("xCut").isNotNull() & F.col("yCut").isNotNull()
    )


def hist_limits(
    table: DataFrame, keys: Sequence[str], column: str, low: float, high: float, scale: float = HIST_SCALE
) -> DataFrame:
    """Histogram range: ``scale`` times two percentiles of the column."""
    out = group_stats(table, keys, quantiles={"__a": (column, low), "__b": (column, high)})
    return out.select(*keys, (F.col("__a") * scale).alias("lo"), (F.col("__b") * scale).alias("hi"))


def image_histogram(
    pixels: DataFrame, column: str, low: float, high: float, n: int = 50, keys: Sequence[str] = DATASET,
    normal: bool = False,
) -> DataFrame:
    """Histogram of one plane over its scaled percentile range; ``normal`` adds a unit normal
    scaled to the highest bin.
    """
    rows = cut(image_residuals(pixels).select(*keys, column))
    limits = hist_limits(rows, keys, column, low, high)
    hist = histogram(rows.join(limits, list(keys)), keys, column, n, "lo", "hi")
    return with_normal(hist, keys, peak_scaled=True) if normal else hist


def peak_bin(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bin with the highest count, the first one on ties."""
    best = F.max_by(F.struct("bin", "left", "right", "count"), F.struct(F.col("count"), -F.col("bin")))
    return hist.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*")


def target_counts(fibers: DataFrame, keys: Sequence[str] = ("spectrograph",)) -> DataFrame:
    return fibers.groupBy(*keys, "targetType").agg(F.count(F.lit(1)).alias("fibers"))


def on_focal_plane(stats: DataFrame, fibers: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Statistics of fibers at their places on the focal plane, with a color value.

    ``rangeClass`` says whether ``column`` lies under, over or inside the range, ``shown`` is the
    value held inside it. A configuration with a ``visit`` column is joined by visit and fiber.
    """
    keys = fiber_keys(fibers, "fiberId")
    placed = stats.join(fibers.select(*keys, "xFocal", "yFocal"), keys)
    x = F.col(column)
    range_class = F.when(x < low, "under").when(x > high, "over").when(x.isNotNull(), "inside")
    return placed.withColumns({"rangeClass": range_class, "shown": S.clamp(column, low, high)})
