"""Flux calibration: magnitudes measured from calibrated spectra against the design, and the
record of one visit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import stats as T
from ..operators.normalization import against_median
from ..operators.ordering import group_stats
from ..operators.photometry import design_flux, magnitude_differences, synth_flux
from ..operators.reshape import spread
from ..operators.spectra import each_pixel, spectrum_stats
from ..operators.windows import first_per_key
from ..sources.frames import cut, fiber_keys

# Bands, positioning limit, S/N window and cut, color wavelengths, plot wavelengths.
BANDS = ("g", "r", "i", "z", "y")
MAX_OFFSET = 0.05
SN_WINDOW = (840.0, 875.0)
LOW_SN = 10.0
EXAMPLE_WAVES = (479.65, 616.09, 750.62, 865.83, 961.15, 1150.0)
# Mask planes that make a pixel of a merged spectrum unusable.
BAD_PLANES = ("BAD", "CR", "SAT", "NO_DATA")


def standards(fibers: DataFrame, max_offset: float | None = MAX_OFFSET, good: bool = True) -> DataFrame:
    """Flux standards on good fibers that reached their position."""
    out = fibers.where(F.col("targetType") == "FLUXSTD")
    if good:
        out = out.where(F.col("fiberStatus") == "GOOD")
    if max_offset is not None:
        out = out.where(S.offset("xNominal", "yNominal", "xFocal", "yFocal") <= max_offset)
    return out


def calibrated_of(spectra: DataFrame, fibers: DataFrame, on: Sequence[str] = ("objId",)) -> DataFrame:
    """Calibrated spectra of the given fibers. When several share the key, the last one wins."""
    ids = [*on, "visit"]
    rest = [c for c in ("catId", "spectrumId") if c in spectra.columns and c not in on]
    chosen = first_per_key(spectra.select(*ids, *rest).distinct(), ids, rest or ids, last=True)
    keys = fiber_keys(fibers, *on)
    return spectra.join(chosen, chosen.columns).join(fibers.select(*keys, "fiberId"), keys)


def merged_pixels(
    spectra: DataFrame, fibers: DataFrame, exposures: DataFrame, planes: Mapping[str, int], bad: Sequence[str] = BAD_PLANES
) -> DataFrame:
    """Usable pixels of the accepted standards in merged spectra.

    ``planes`` maps a mask plane to its bit, and a pixel with one of the ``bad`` planes set is
    left out; other planes do no harm. ``flux`` becomes counts over norm and exposure time,
    NULL where either is zero; the counts, which the S/N is made of, stay as ``counts``. A
    visit without an exposure time has no pixels.
    """
    bits = sum(1 << planes[name] for name in bad)
    stars = standards(fibers)
    keys = fiber_keys(stars, "fiberId")
    good = spectra.where(F.col("mask").bitwiseAND(F.lit(bits)) == 0).join(stars.select(*keys), keys, "left_semi")
    timed = good.join(exposures.select("visit", "exptime"), "visit")
    return timed.withColumns(
        {"counts": F.col("flux"), "flux": T.ratio(T.ratio("flux", "norm"), "exptime"), "mask": F.lit(0)}
    ).drop("exptime")


def measured_magnitudes(
    spectra: DataFrame, filters: DataFrame, keys: Sequence[str] = ("visit", "fiberId"), zero: float = S.ZERO_POINT
) -> DataFrame:
    """Synthetic magnitudes per spectrum, one column per band; masked pixels are left out."""
    flux = synth_flux(spectra.where(F.col("mask") == 0), filters, keys)
    mags = flux.withColumn("mag", S.ab_mag("synthFlux", zero))
    return spread(mags, keys, "filter_name", "mag", BANDS, prefix="single_mag_")


def flux_table(
    fibers: DataFrame, spectra: DataFrame, filters: DataFrame, diff_filter: str | None = "g", zero: float = S.ZERO_POINT
) -> DataFrame:
    """Design and measured magnitudes of the standards with their differences and colors. With a
    configuration per visit, each visit's spectra meet its own stars.
    """
    stars = fibers.where(F.col("targetType") == "FLUXSTD")
    ids = ["fiberId", "spectrograph", "objId", "catId", "ra", "dec", "xFocal", "yFocal"]
    keys = fiber_keys(fibers, "fiberId")
    design = design_flux(stars, BANDS, list(dict.fromkeys([*keys, *ids])), zero)
    chosen = spectra.join(stars.select(*keys), keys, "left_semi")
    return magnitude_differences(
        design.join(measured_magnitudes(chosen, filters, zero=zero), keys), BANDS, diff_filter
    )


def filter_summary(table: DataFrame, filters: DataFrame, prefix: str = "diff_") -> DataFrame:
    """Median and robust RMS of the difference per visit and filter, with the filter's limits."""
    columns = [f"{prefix}{b}" for b in BANDS]
    long = table.select("visit", *[F.col(c).alias(b) for c, b in zip(columns, BANDS)]).unpivot(
        ["visit"], list(BANDS), "filter_name", "value"
    )
    stats = group_stats(
        long,
        ["visit", "filter_name"],
        [F.count("value").alias("count")],
        {"q25": ("value", 0.25), "median": ("value", 0.5), "q75": ("value", 0.75)},
    )
    limits = filters.groupBy("filter_name").agg(
        F.min("wavelength").cast("int").alias("wlMin"), F.max("wavelength").cast("int").alias("wlMax")
    )
    rms = (F.col("q75") - F.col("q25")) * T.IQR_ROBUST
    return stats.withColumn("robustRms", rms).drop("q25", "q75").join(limits, "filter_name")


# the record of a visit


def scatter(table: DataFrame, keys: Sequence[str], column: str, name: str, scale: float = T.IQR_PER_SIGMA_SHORT) -> DataFrame:
    """``<name>Median`` and ``<name>Sigma`` (interquartile range over ``scale``)."""
    out = group_stats(table, keys, quantiles={"__a": (column, 0.25), "__b": (column, 0.5), "__c": (column, 0.75)})
    sigma = (F.col("__c") - F.col("__a")) / scale
    return out.select(*keys, F.col("__b").alias(f"{name}Median"), sigma.alias(f"{name}Sigma"))


def fiber_sn(
    spectra: DataFrame, keys: Sequence[str] = ("visit", "fiberId"), window: tuple[float, float] = SN_WINDOW,
    noise: str = "covar0",
) -> DataFrame:
    """Median flux over noise within an open wavelength window; pixels need a positive covariance."""
    w = F.col("wavelength")
    inside = (w > window[0]) & (w < window[1]) & (F.col("mask") == 0) & (F.col(noise) > 0)
    sn = F.when(inside, T.ratio("flux", F.sqrt(F.when(F.col(noise) > 0, F.col(noise)))))
    rows = spectra.withColumn("__sn", sn)
    return group_stats(rows, keys, quantiles={"SN": ("__sn", 0.5)})


def fiber_sn_of_arrays(spectra: DataFrame, window: tuple[float, float] = SN_WINDOW, noise: str = "covar0") -> DataFrame:
    """:func:`fiber_sn` of spectra stored as arrays, without a shuffle."""

    def sn(w, flux, mask, variance):
        inside = (w > window[0]) & (w < window[1]) & (mask == 0) & (variance > 0)
        return F.when(inside, T.ratio(flux, F.sqrt(F.when(variance > 0, variance))))

    rows = spectra.withColumn("__sn", each_pixel(["wavelength", "flux", "mask", noise], sn))
    return spectrum_stats(rows, "__sn", {"SN": 0.5}).drop("__sn")


def merged_sn(pixels: DataFrame, keys: Sequence[str] = ("visit", "fiberId"), window: tuple[float, float] = SN_WINDOW) -> DataFrame:
    """S/N of the counts of :func:`merged_pixels`, so of accepted standards only."""
    return fiber_sn(pixels.withColumn("flux", F.col("counts")), keys, window)


def low_sn(sn: DataFrame, limit: float = LOW_SN) -> DataFrame:
    return sn.where(F.col("SN") < limit)


def best_star(sn: DataFrame, keys: Sequence[str] = ("visit",)) -> DataFrame:
    """Fiber with the highest S/N, the first one on ties."""
    best = F.max_by(F.struct("fiberId", "SN"), F.when(F.col("SN").isNotNull(), F.struct(F.col("SN"), -F.col("fiberId"))))
    return sn.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*")


def color_residual(first: str = "g", second: str = "i") -> Column:
    """Difference between two bands of measured minus design magnitude."""
    return F.col(f"diff_{first}") - F.col(f"diff_{second}")


def with_fake_j(table: DataFrame) -> DataFrame:
    """One more reference magnitude, the y magnitude plus a fixed offset."""
    return table.withColumn("design_mag_nJ", F.col("design_mag_y") + S.FAKE_J_MAG_OFFSET)


def locus_scatter(table: DataFrame, keys: Sequence[str] = ("visit",)) -> DataFrame:
    """Scatter about the stellar sequence in three color planes, design and measured."""
    planes = {"gri": ("g", "r", "i"), "riz": ("r", "i", "z"), "izy": ("i", "z", "y")}
    columns = {}
    for name, bands in planes.items():
        columns[f"ref_{name}"] = S.locus_residual(*[F.col(f"design_mag_{b}") for b in bands], name)
        columns[f"obs_{name}"] = S.locus_residual(
            *[F.col(f"diff_{b}") + F.col(f"design_mag_{b}") for b in bands], name
        )
    rows = cut(table.select(*keys, *[c.alias(n) for n, c in columns.items()]))
    marks = {}
    for n in columns:
        marks |= {f"{n}_25": (n, 0.25), f"{n}_75": (n, 0.75)}
    out = group_stats(rows, keys, quantiles=marks)
    return out.select(
        *keys, *[((F.col(f"{n}_75") - F.col(f"{n}_25")) / T.IQR_PER_SIGMA_SHORT).alias(f"sigma_{n}") for n in columns]
    )


def vector_percentiles(vector: DataFrame, keys: Sequence[str] = ("visit", "wavelength"), value: str = "value") -> DataFrame:
    """Logarithm of percentiles 16, 50 and 84 of the calibration vector over fibers."""
    names = {"log16": 0.16, "log50": 0.5, "log84": 0.84}
    out = group_stats(vector, keys, quantiles={n: (value, p) for n, p in names.items()})
    return out.select(*keys, *[S.log10_positive(n).alias(n) for n in names])


def vector_color(
    vector: DataFrame, waves: tuple[float, float], keys: Sequence[str] = ("visit",), value: str = "value"
) -> DataFrame:
    """Vector at one wavelength over that at another per fiber, divided by the median."""
    at = [F.max(F.when(F.col("wavelength") == w, F.col(value))).alias(f"__{i}") for i, w in enumerate(waves)]
    ratios = vector.where(F.col("wavelength").isin(*waves)).groupBy(*keys, "fiberId").agg(*at)
    ratios = ratios.select(*keys, "fiberId", T.ratio("__0", "__1").alias("ratio"))
    return against_median(ratios, keys, "ratio", "normalized", divide=True)


def plane_norm(table: DataFrame, keys: Sequence[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Values over their median, and the scatter of that in percent."""
    rows = cut(against_median(table, keys, value, "normalized", divide=True))
    out = scatter(rows, keys, "normalized", "norm")
    return rows, out.withColumn("scatterPercent", F.col("normSigma") * 100.0)


def scaled_spectrum(
    spectra: DataFrame, keys: Sequence[str] = ("visit", "fiberId"), fluxes: DataFrame | None = None,
    bands: Sequence[str] = BANDS,
) -> DataFrame:
    """Good pixels over the spectrum's own median; ``fluxes`` adds the design fluxes and a
    narrow-J flux on the same scale.
    """
    good = cut(spectra.where(F.col("mask") == 0))
    middle = group_stats(good, keys, quantiles={"fluxMedian": ("flux", 0.5)})
    if fluxes is not None:
        mags = {f"__m_{b}": S.ab_mag(f"flux_{b}") for b in bands}
        extra = fluxes.withColumns(mags).withColumn(
            "flux_nJ", S.flux_of_mag(S.narrow_j("__m_g", "__m_r", "__m_y"))
        )
        middle = middle.join(extra.select("fiberId", *[f"flux_{b}" for b in (*bands, "nJ")]), "fiberId")
        middle = middle.withColumns({f"scaled_{b}": T.ratio(f"flux_{b}", "fluxMedian") for b in (*bands, "nJ")})
        middle = middle.drop(*[f"flux_{b}" for b in (*bands, "nJ")])
    return good.join(middle, list(keys)).withColumn("scaled", T.ratio("flux", "fluxMedian"))


def visit_fibers(table: DataFrame, sn: DataFrame, flux_filter: str = "i", color: tuple[str, str] = ("g", "i")) -> DataFrame:
    """Per standard: magnitude and color difference (also less their visit medians), catalogue
    magnitude and S/N.
    """
    rows = table.select(
        "visit",
        "fiberId",
        F.col(f"diff_{flux_filter}").alias("mag"),
        color_residual(*color).alias("color"),
        F.col(f"design_mag_{flux_filter}").alias("mag_cat"),
    )
    rows = against_median(rows, ["visit"], "mag", "magCentered")
    rows = against_median(rows, ["visit"], "color", "colorCentered")
    return rows.join(sn.withColumnRenamed("SN", "SNR"), ["visit", "fiberId"], "left")


def guide_summary(series: DataFrame) -> DataFrame:
    """Median and sigma of transparency and seeing per visit."""
    series = cut(series)
    a = scatter(series, ["visit"], "transparency_median", "transparency", T.IQR_PER_SIGMA)
    return a.join(scatter(series, ["visit"], "seeing_median", "seeing", T.IQR_PER_SIGMA), "visit")


def visit_results(
    merged: DataFrame,
    single: DataFrame,
    sn: DataFrame,
    guide: DataFrame,
    version: str,
    collection: str,
    flux_filter: str = "i",
    color: tuple[str, str] = ("g", "i"),
) -> DataFrame:
    """The 24 scalars of each visit.

    ``merged`` and ``single`` are flux tables from merged and from calibrated spectra, ``sn``
    has ``SN`` per fiber and ``guide`` is a guide-camera series. A visit that any of them has
    is in the result.
    """
    merged, single = cut(merged), cut(single)
    key = ["visit"]
    colored_m = merged.withColumn("__c", color_residual(*color))
    colored_s = single.withColumn("__c", color_residual(*color))
    parts = [
        scatter(merged, key, f"diff_{flux_filter}", "merged"),
        scatter(sn, key, "SN", "mergedSN"),
        scatter(merged, key, f"design_mag_{flux_filter}", "imag"),
        scatter(colored_m, key, "__c", "mergedColor"),
        scatter(single, key, f"diff_{flux_filter}", "single"),
        scatter(colored_s, key, "__c", "singleColor"),
        locus_scatter(single).select(
            "visit",
            F.col("sigma_obs_gri").alias("stellarSequenceSigmaGRI"),
            F.col("sigma_obs_riz").alias("stellarSequenceSigmaRIZ"),
            F.col("sigma_obs_izy").alias("stellarSequenceSigmaIZY"),
        ),
    ]
    out = guide_summary(guide)
    for part in parts:
        out = out.join(part, "visit", "full")
    return out.withColumns(
        {
            "version": F.lit(version),
            "collection": F.lit(collection),
            "mergedFilter": F.lit(flux_filter),
            "mergedColorFilters": F.lit(f"{color[0]}-{color[1]}"),
        }
    )


def visit_record(
    merged: DataFrame,
    single: DataFrame,
    exposures: DataFrame,
    fibers: DataFrame,
    filters: DataFrame,
    guide: DataFrame,
    planes: Mapping[str, int],
    version: str,
    collection: str,
) -> DataFrame:
    """The scalars of each visit from its spectra: ``merged`` in counts and ``single`` calibrated.

    Both flux tables hold the accepted standards; a pixel counts by the listed planes of
    ``merged`` and by any plane of ``single``.
    """
    stars = standards(fibers)
    pixels = cut(merged_pixels(merged, fibers, exposures, planes))
    return visit_results(
        flux_table(stars, pixels, filters), flux_table(stars, single, filters), merged_sn(pixels), guide, version, collection
    )
