"""Stability of the fiber throughput: lamp spectra of each visit over those of a reference
visit, normalized in both directions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats as T
from ..functions.scalars import bundle_group, finite_or_null, range_class
from ..operators.lines import DATASET
from ..operators.normalization import normalize_2d
from ..operators.ordering import group_stats
from ..operators.windows import median_filter, top_per_group
from ..sources.catalog import metadata, stability_inputs
from ..sources.frames import cut, fiber_keys

# Wavelength bands, flag thresholds, plot limits and counts.
BANDS = {"b": (450.0, 650.0), "r": (650.0, 950.0), "m": (650.0, 950.0), "n": (950.0, 1250.0)}
FLAG_SIGMA = {"b": 0.009, "r": 0.0055, "m": 0.0055, "n": 0.012}
KERNEL = 15
ODD_FIBERS = 15
CLIP = 4
PIXELS = (1500, 3500)
# Inputs of a stability job with their dimensions, header values in its record.
INPUT_TYPES = {
    "config": ("instrument", "visit"),
    "spectra": ("instrument", "visit", "arm", "spectrograph"),
    "norms": ("instrument", "visit", "arm"),
}
HEADER_CARDS = ("HST", "INSROT", "AZIMUTH")
# Into how many blocks the fibers of the instrument are dealt.
BLOCKS = 64


def _by_arm(values: dict[str, float], arm: str = "arm") -> Column:
    out = F.lit(None).cast("double")
    for name, v in values.items():
        out = F.when(F.col(arm) == name, F.lit(float(v))).otherwise(out)
    return out


def flag_threshold(arm: str = "arm") -> Column:
    return _by_arm(FLAG_SIGMA, arm)


def in_band(value: Column | str, wavelength: str = "wavelength", arm: str = "arm") -> Column:
    """``value``, missing outside the arm's wavelength band (limits included)."""
    low = _by_arm({a: b[0] for a, b in BANDS.items()}, arm)
    high = _by_arm({a: b[1] for a, b in BANDS.items()}, arm)
    w = F.col(wavelength)
    return F.when((w >= low) & (w <= high), F.col(value) if isinstance(value, str) else value)


def usable_fibers(fibers: DataFrame) -> DataFrame:
    return fibers.where((F.col("targetType") != "ENGINEERING") & (F.col("fiberStatus") == "GOOD"))


def ratio_pairs(spectra: DataFrame, fibers: DataFrame, ref_visit: int) -> DataFrame:
    """Spectra of usable fibers against the same pixels of the reference visit, with the plain
    ratio and the ratio of norm-divided fluxes, both limited to the arm's band.
    """
    keys = fiber_keys(fibers, "fiberId", "spectrograph")
    spectra = spectra.join(usable_fibers(fibers).select(*keys), keys, "left_semi")
    place = ["arm", "spectrograph", "fiberId", "pix"]
    target = spectra.where(F.col("visit") != ref_visit)
    reference = spectra.where(F.col("visit") == ref_visit).select(
        *place, F.col("flux").alias("refFlux"), F.col("norm").alias("refNorm")
    )
    return _with_ratios(target.join(reference, place))


def ratio_pairs_of(spectra: DataFrame, fibers: DataFrame, datasets: DataFrame) -> DataFrame:
    """:func:`ratio_pairs` of the ``datasets`` (visit, arm, spectrograph, refVisit) that a
    catalogue names, each against its own reference visit.
    """
    keys = fiber_keys(fibers, "fiberId", "spectrograph")
    spectra = spectra.join(usable_fibers(fibers).select(*keys), keys, "left_semi")
    asked = datasets.select("visit", "arm", "spectrograph", "refVisit")
    target = spectra.join(asked, ["visit", "arm", "spectrograph"])
    place = ["refVisit", "arm", "spectrograph", "fiberId", "pix"]
    reference = spectra.withColumnRenamed("visit", "refVisit").select(
        *place, F.col("flux").alias("refFlux"), F.col("norm").alias("refNorm")
    )
    wanted = asked.select(*place[:3]).distinct()
    return _with_ratios(target.join(reference.join(wanted, place[:3], "left_semi"), place))


def _with_ratios(pairs: DataFrame) -> DataFrame:
    flattened = T.ratio(T.ratio("flux", "norm"), T.ratio("refFlux", "refNorm"))
    return pairs.withColumns(
        {
            "naive": in_band(finite_or_null(T.ratio("flux", "refFlux"))),
            "flattened": in_band(finite_or_null(flattened)),
        }
    )


def normalized_ratio(pairs: DataFrame, value: str = "naive", keys: Sequence[str] = DATASET) -> DataFrame:
    """Ratio normalized over fibers and pixels, as ``ratio``."""
    return normalize_2d(pairs, keys, "fiberId", "pix", value, "ratio")


def filtered_ratio(pairs: DataFrame, keys: Sequence[str] = DATASET, kernel: int = KERNEL) -> DataFrame:
    """Normalized ratio of norm-divided fluxes after a running median along the pixels."""
    filtered = median_filter(pairs, [*keys, "fiberId"], "pix", "flattened", "filtered", kernel)
    return normalized_ratio(filtered, "filtered", keys)


def fiber_sigma(ratios: DataFrame, keys: Sequence[str] = DATASET, subtract_error: bool = True) -> DataFrame:
    """Spread of each fiber's ratio over wavelength: standard deviation, and robust sigma with
    the photon noise 2 / median(variance) taken out in quadrature.
    """
    stats = group_stats(
        ratios,
        [*keys, "fiberId"],
        [F.stddev_pop("ratio").alias("sigma_std")],
        {
            "q25": ("ratio", 0.25),
            "ratioMedian": ("ratio", 0.5),
            "q75": ("ratio", 0.75),
            "varMedian": ("variance", 0.5),
        },
    )
    robust = (F.col("q75") - F.col("q25")) * T.IQR_ROBUST
    if subtract_error:
        rest = robust * robust - T.ratio(F.lit(2.0), "varMedian")
        robust = F.when(rest.isNotNull(), F.sqrt(F.greatest(rest, F.lit(0.0))))
    return stats.withColumn("sigma", robust).drop("q25", "q75", "varMedian")


def fiber_table(sigma: DataFrame, fibers: DataFrame, keys: Sequence[str] = ("visit", "arm")) -> DataFrame:
    """Sigma of every fiber of the bundle table in every job, with bundle group and spectrograph.

    A fiber that a job did not observe has spectrograph 0 there. Every job meets every fiber, by
    an equal join on blocks of fibers, so no side has to be small.
    """
    keys = list(keys)
    one = F.struct("fiberId", "mtp_A", bundle_group("mtp_A").alias("mtpGroup"))
    named = fibers.select("fiberId", "mtp_A").distinct().withColumn("__block", F.pmod(F.hash("fiberId"), F.lit(BLOCKS)))
    blocks = named.groupBy("__block").agg(F.collect_list(one).alias("__all"))
    jobs = sigma.select(*keys).distinct().withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    jobs = jobs.join(blocks, "__block").select(*keys, F.inline("__all"))
    observed = sigma.select(*keys, "fiberId", F.col("spectrograph").alias("SM"), "sigma", "sigma_std")
    return jobs.join(observed, [*keys, "fiberId"], "left").withColumn("SM", F.coalesce("SM", F.lit(0)))


def norms_record(sigma: DataFrame, keys: Sequence[str] = ("visit", "arm")) -> DataFrame:
    """Median and 95th percentile of the fibers' sigma per job, also doubled."""
    out = group_stats(
        sigma,
        keys,
        [],
        {
            "__median": ("sigma_std", 0.5),
            "sigma_std_95": ("sigma_std", 0.95),
            "sigma_iqr": ("sigma", 0.5),
        },
    )
    # The plain median is missing as soon as one fiber is, the others skip.
    missing = sigma.groupBy(*keys).agg(F.count("sigma_std").alias("__n"), F.count(F.lit(1)).alias("__all"))
    joined = out.join(missing, list(keys)).withColumn(
        "sigma_std_median", F.when(F.col("__n") == F.col("__all"), F.col("__median"))
    )
    return joined.select(
        *keys,
        "sigma_std_median",
        "sigma_std_95",
        (F.col("sigma_std_median") * 2).alias("twosigma_std"),
        (F.col("sigma_std_95") * 2).alias("twosigma_std_95"),
        "sigma_iqr",
    )


def norms_flag(sigma: DataFrame, keys: Sequence[str] = ("visit", "arm")) -> DataFrame:
    """Job flagged when its median sigma reaches the arm's threshold; also median + 4 sigma."""
    out = group_stats(sigma, keys, [F.stddev_pop("sigma").alias("__sd")], {"sigmaMedian": ("sigma", 0.5)})
    return out.select(
        *keys,
        "sigmaMedian",
        (F.col("sigmaMedian") + F.col("__sd") * CLIP).alias("sigmaLimit"),
        F.when(F.col("sigmaMedian") >= flag_threshold(), "Yes").otherwise("No").alias("flag"),
    )


def plotted_fibers(table: DataFrame) -> DataFrame:
    """Observed fibers whose bundle group is an upper or lower one."""
    return table.where(F.col("mtpGroup").rlike("[UD]") & (F.col("SM") != 0))


def odd_fibers(table: DataFrame, keys: Sequence[str] = ("visit", "arm"), k: int = ODD_FIBERS) -> DataFrame:
    """The ``k`` fibers with the largest sigma above the arm's threshold, per job."""
    above = table.where(F.col("sigma") > flag_threshold())
    return top_per_group(above, keys, [F.col("sigma").desc(), F.col("fiberId")], k)


def used_groups(table: DataFrame) -> DataFrame:
    return table.where(F.col("SM") != 0).select("SM", "mtpGroup").distinct()


def ratio_at_pixel(ratios: DataFrame, pixels: Sequence[int] = PIXELS) -> DataFrame:
    """Ratio of each fiber at fixed pixels."""
    return ratios.where(F.col("pix").isin(*pixels))


def clean_norms(norms: DataFrame, fibers: DataFrame, value: str = "values") -> DataFrame:
    """Norms of good fibers, missing outside the arm's band."""
    keys = fiber_keys(fibers, "fiberId")
    good = fibers.where(F.col("fiberStatus") == "GOOD").select(*keys)
    return norms.join(good, keys, "left_semi").withColumn(value, finite_or_null(in_band(value)))


def norms_limits(norms: DataFrame, keys: Sequence[str] = ("visit", "arm"), value: str = "values") -> DataFrame:
    """Plot limits of the norms: median ± 2.5 deviations of the fibers' medians. The deviation
    is missing as soon as one fiber has no median.
    """
    per_fiber = cut(group_stats(norms, [*keys, "fiberId"], quantiles={"v": (value, 0.5)}))
    sd = T.strict(F.stddev_pop("v"), "v")
    out = group_stats(per_fiber, keys, [sd.alias("__sd")], {"median": ("v", 0.5)})
    return out.select(
        *keys,
        "median",
        (F.col("median") - F.col("__sd") * 2.5).alias("lower"),
        (F.col("median") + F.col("__sd") * 2.5).alias("upper"),
    )


def with_range_class(table: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    return table.withColumn("rangeClass", range_class(column, lo, hi))


def stability(spectra: DataFrame, fibers: DataFrame, ref_visit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole job: per-fiber table, scalar record and flag of every (visit, arm)."""
    pairs = cut(ratio_pairs(spectra, fibers, ref_visit))
    sigma = cut(fiber_sigma(normalized_ratio(pairs)))
    return fiber_table(sigma, fibers), norms_record(sigma), norms_flag(sigma)


def stability_job(
    catalog: DataFrame,
    spectra: DataFrame,
    fibers: DataFrame,
    headers: DataFrame,
    types: dict[str, Sequence[str]] = INPUT_TYPES,
    ref_visit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Everything from the catalogue on: per-fiber table, and the record of every (visit, arm)
    with its reference visit, header values and flag.

    ``headers`` has a map ``metadata`` per dataset. Broken groups and an empty selection fail the
    job (:func:`fiberqa.sources.catalog.stability_inputs`).
    """
    keys = ["visit", "arm"]
    datasets = cut(stability_inputs(catalog, types, ref_visit=ref_visit))  # a few rows, read three times
    sigma = cut(fiber_sigma(normalized_ratio(cut(ratio_pairs_of(spectra, fibers, datasets)))))
    own = headers.join(datasets.select(*DATASET), list(DATASET), "left_semi")
    cards = metadata(own, keys, HEADER_CARDS).withColumnsRenamed({c: c.lower() for c in HEADER_CARDS})
    reference = datasets.groupBy(*keys).agg(F.min("refVisit").alias("refVisit"))
    record = norms_record(sigma).join(norms_flag(sigma), keys).join(reference, keys).join(cards, keys, "left")
    return fiber_table(sigma, fibers), record
