"""Sky subtraction: leave-one-out residuals and the statistics of their chi."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import stats as T
from ..operators.binning import bin_label, equal_width_bin, histogram, with_normal
from ..operators.interpolation import interpolate
from ..operators.lines import DATASET
from ..operators.ordering import average_rank, group_stats, percent_rank_of, ranked
from ..operators.reshape import dense_rows
from ..operators.sampling import split_fibers
from ..operators.spectra import each_pixel, spectrum_stats
from ..operators.summaries import Aggregate, summarise
from ..operators.windows import mean_of_others, median_of_others
from ..sources.frames import cut, fiber_keys, one_exposure

SALTS = 32


def sky_columns(spectra: DataFrame) -> DataFrame:
    """Standard deviations, chi and Poisson chi; NULL where a pixel is not usable."""
    ok = S.usable_sky()
    return spectra.withColumns(
        {
            "usable": F.coalesce(ok, F.lit(False)),
            "std": F.when(ok, F.sqrt("variance")),
            "chi": S.chi(where=ok),
            "std_poisson": F.when(ok, F.sqrt(F.abs(F.col("flux") + F.col("sky")))),
            "chi_poisson": S.chi_poisson(where=ok),
        }
    )


def subtract_others(
    spectra: DataFrame, fibers: DataFrame, keys: Sequence[str] = DATASET, how: str = "median"
) -> DataFrame:
    """Residual of every sky fiber against the sky of all other sky fibers at its pixel.

    Masked pixels do not enter the model. They still get a residual, against the good pixels of
    the other fibers. Spectra without a ``mask`` have no masked pixels.
    """
    keys_in = fiber_keys(fibers, "fiberId")
    sky = fibers.where(F.col("targetType") == "SKY").select(*keys_in)
    rows = spectra.join(sky, keys_in, "left_semi")
    others = {"median": median_of_others, "mean": mean_of_others}[how]
    good = F.when(F.col("mask") == 0, F.col("flux")) if "mask" in rows.columns else F.col("flux")
    modelled = others(cut(rows.withColumn("__good", good)), [*keys, "pix"], "__good", "skyModel")
    return modelled.withColumn("residual", F.col("flux") - F.col("skyModel")).drop("__good")


def chi_stats(rows: DataFrame, keys: Sequence[str] = DATASET) -> DataFrame:
    """Mean, median, deviation and robust RMS of chi per fiber."""
    out = group_stats(
        rows,
        [*keys, "fiberId"],
        [F.avg("chi").alias("fiberChiMean"), F.stddev_samp("chi").alias("fiberChiStd")],
        {"q25": ("chi", 0.25), "fiberChiMedian": ("chi", 0.5), "q75": ("chi", 0.75)},
    )
    return out.withColumn("fiberChiIQR", (F.col("q75") - F.col("q25")) * T.IQR_ROBUST).drop("q25", "q75")


def sky_arrays(spectra: DataFrame) -> DataFrame:
    """Arrays ``chi`` and ``chi_poisson`` beside the stored ones, NULL at unusable pixels."""
    names = ["flux", "sky", "variance", "mask"]

    def chi(flux, sky, variance, mask):
        return S.chi(flux, variance, S.usable_sky(flux, sky, variance, mask))

    def poisson(flux, sky, variance, mask):
        return S.chi_poisson(flux, sky, S.usable_sky(flux, sky, variance, mask))

    return spectra.withColumns({"chi": each_pixel(names, chi), "chi_poisson": each_pixel(names, poisson)})


def chi_stats_of_arrays(spectra: DataFrame, column: str = "chi") -> DataFrame:
    """:func:`chi_stats` of spectra stored as arrays, without a shuffle."""
    out = spectrum_stats(
        sky_arrays(spectra), column, {"q25": 0.25, "fiberChiMedian": 0.5, "q75": 0.75}, "fiberChiMean", "fiberChiStd"
    )
    return out.withColumn("fiberChiIQR", (F.col("q75") - F.col("q25")) * T.IQR_ROBUST).drop("q25", "q75")


def heat_map(
    rows: DataFrame, keys: Sequence[str] = DATASET, value: str = "chi", how: Column | Aggregate | None = None
) -> DataFrame:
    """Mean (or ``how``) of chi per fiber and whole wavelength, gaps included. ``how`` may be a
    finished aggregate or an :data:`fiberqa.operators.summaries.Aggregate`.
    """
    binned = rows.where(F.col(value).isNotNull()).withColumn("wave_row", S.wave_row("wavelength"))
    if how is not None and not isinstance(how, Column):
        cells = summarise(binned, [*keys, "fiberId", "wave_row"], value, {value: how})
        return dense_rows(cells, keys, "fiberId", "wave_row", value, F.first(value), value)
    return dense_rows(binned, keys, "fiberId", "wave_row", value, how if how is not None else F.avg(value), value)


def outliers(rows: DataFrame, lo: int = 3, hi: int = 10) -> DataFrame:
    """Pixels with a large chi and their class."""
    return rows.withColumn("chi_value", S.threshold_class("chi", lo, hi)).where(F.abs("chi") >= lo)


MODELS = ("none", "sky", "chi", "chi_poisson", "residuals", "variance", "sky_chi")


def model_value(model: str) -> Column:
    """What a reference spectrum is made of: total flux, sky, chi, Poisson chi, residual flux,
    variance, or total flux over its deviation.
    """
    if model not in MODELS:
        raise ValueError(f"model must be one of {MODELS}")
    return {
        "none": F.col("sky") + F.col("flux"),
        "sky": F.col("sky"),
        "chi": F.col("chi"),
        "chi_poisson": F.col("chi_poisson"),
        "residuals": F.col("flux"),
        "variance": F.col("std") * F.col("std"),
        "sky_chi": T.ratio(F.col("sky") + F.col("flux"), "std"),
    }[model]


def reference_grid(rows: DataFrame, keys: Sequence[str] = DATASET) -> DataFrame:
    """Wavelengths of the fiber with most usable pixels, the first one on ties."""
    lengths = rows.groupBy(*keys, "fiberId").agg(F.count(F.lit(1)).alias("__n"))
    longest = lengths.groupBy(*keys).agg(
        F.max_by("fiberId", F.struct(F.col("__n"), -F.col("fiberId"))).alias("fiberId")
    )
    return rows.join(longest, [*keys, "fiberId"]).select(*keys, "wavelength")


def build_reference(
    rows: DataFrame, model: str = "residuals", func: str | Aggregate = "mean", keys: Sequence[str] = DATASET
) -> DataFrame:
    """Reference spectrum per dataset: each fiber interpolated to the longest fiber's grid, then
    mean, median, quadrature sum or a given aggregate over the fibers.

    A grid has no more points than the detector has rows, so the interpolated table is about
    as large as the spectra.
    """
    usable = cut(rows.where("usable").withColumn("__m", model_value(model)))
    # Salted by fiber, or one task would make all grid rows of a large dataset.
    fibers = usable.select(*keys, "fiberId").distinct()
    fibers = fibers.withColumn("__salt", F.pmod(F.hash("fiberId"), F.lit(SALTS)))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    grid = reference_grid(usable, keys).withColumn("__salt", salts).join(fibers, [*keys, "__salt"]).drop("__salt")
    knots = usable.select(*keys, "fiberId", "wavelength", "__m")
    on_grid = interpolate(cut(grid), knots, [*keys, "fiberId"], "wavelength", "__m", "value")
    group = [*keys, "wavelength"]
    if not isinstance(func, str):
        return summarise(on_grid, group, "value", {"fibers": F.count, "value": func})
    if func == "median":
        return group_stats(on_grid, group, [F.count("value").alias("fibers")], {"value": ("value", 0.5)})
    how = {"mean": F.avg("value"), "quadrature": T.quadrature_sum("value")}[func]
    return on_grid.groupBy(*group).agg(F.count("value").alias("fibers"), how.alias("value"))


def residual_against_sky(
    rows: DataFrame, keys: Sequence[str] = DATASET, fraction: float = 0.1, seed: int = 0, column: str = "residuals",
    func: str | Aggregate = "median",
) -> DataFrame:
    """Median (or ``func``) of ``column`` over test fibers, with the reference fibers' sky on the
    same grid, combined alike.
    """
    # The split reads them twice.
    rows = cut(rows.where("usable"))
    split = cut(split_fibers(rows, keys, fraction=fraction, seed=seed))
    sky = build_reference(split.where("isReference"), "none", func, keys)
    test = build_reference(split.where(~F.col("isReference")), column, func, keys)
    return interpolate(
        test.select(*keys, "wavelength", "value"), sky.select(*keys, "wavelength", F.col("value").alias("sky")),
        keys, "wavelength", "sky",
    )


def brightness_bins(rows: DataFrame, n: int = 10) -> DataFrame:
    """Percent rank of total flux within the visit's fiber, its bin and label, and the rank of
    the wavelength within visit, arm and fiber. Bins lie between the extremes of a visit's
    spectrograph.
    """
    total = rows.where("usable").withColumn("totalFlux", F.col("flux") + F.col("sky"))
    part = ["visit", "spectrograph"]
    out = percent_rank_of(total, [*part, "fiberId"], "totalFlux", "ranked")
    out = ranked(cut(out), [*part, "arm", "fiberId"], "wavelength")
    out = out.withColumn("wave_rank", average_rank()).drop("below", "ties", "n")
    out = equal_width_bin(cut(out), part, "ranked", n, "bin")
    return out.withColumn("ranked_bin", bin_label("bin", n))


def chi_by_brightness(binned: DataFrame, by: Sequence[str] = (*DATASET, "ranked_bin"), column: str = "chi") -> DataFrame:
    """Median and robust RMS of chi per brightness bin."""
    out = group_stats(
        binned,
        by,
        [F.count(column).alias("count")],
        {"q25": (column, 0.25), "median": (column, 0.5), "q75": (column, 0.75)},
    )
    return out.withColumn("robustRms", (F.col("q75") - F.col("q25")) * T.IQR_ROBUST).drop("q25", "q75")


def aggregates_by_brightness(
    binned: DataFrame, aggregates: Mapping[str, Aggregate], by: Sequence[str] = (*DATASET, "ranked_bin"), column: str = "chi"
) -> DataFrame:
    """Given aggregates of chi per brightness bin."""
    return summarise(binned, by, column, aggregates)


def reference_brightness(
    rows: DataFrame, column: str = "chi", keys: Sequence[str] = DATASET, n: int = 10, seed: int = 0, fraction: float = 0.1
) -> DataFrame:
    """Reference chi spectrum of the test fibers binned by the sky brightness rank."""
    both = residual_against_sky(rows, keys, fraction, seed, column).withColumnRenamed("value", column)
    # One spectrum for each dataset.
    out = percent_rank_of(cut(both), keys, "sky", "ranked", one_exposure(keys))
    out = equal_width_bin(cut(out), keys, "ranked", n, "bin")
    return out.withColumn("ranked_bin", bin_label("bin", n))


def chi_histogram(
    rows: DataFrame, keys: Sequence[str] = (*DATASET, "fiberId"), column: str = "chi", n: int = 30,
    lo: float = -5.0, hi: float = 5.0,
) -> DataFrame:
    """Density histogram of chi with the unit normal beside it."""
    return with_normal(histogram(rows, keys, column, n, lo, hi, density=True))
