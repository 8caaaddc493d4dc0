"""Detector-map residuals: clipped residual rows, fit statistics, and the tables behind the
per-visit and the combined report. All visits, arms and spectrographs in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import stats as T
from ..operators.binning import step_bin
from ..operators.clipping import sigma_clip, soften_fit
from ..operators.lines import DATASET, dispersion_at_center, good_lines, with_dispersion
from ..operators.ordering import first_come_rank, group_stats
from ..operators.reshape import melt_status
from ..sources.frames import cut, join_per_group

# Order of the detectors in reports, the report metrics, and the reason of a science visit.
DETECTOR_ORDER = [f"{arm}{spec}" for arm in ("b", "r", "m", "n") for spec in (1, 2, 3, 4)]
METRICS = ("median", "weightedRms", "softenFit")
SIGMA_RANGE = 2.5
SCIENCE = "science"


def residual_columns(lines: DataFrame) -> DataFrame:
    """Line or trace, residuals against the detector map, and the status columns.

    A trace has no model row, hence no y residual.
    """
    trace = S.is_trace()
    return lines.withColumns(
        {
            "isTrace": trace,
            "isLine": ~trace,
            "xResid": F.col("x") - F.col("xModel"),
            "yResid": F.when(~trace, F.col("y") - F.col("yModel")),
            "isUsed": S.has_any("status", S.USED),
            "isReserved": S.has_any("status", S.RESERVED),
            "status_type": S.status_type("status"),
        }
    )


def scrub(lines: DataFrame, remove_flagged: bool = True, used_or_reserved: bool = True) -> DataFrame:
    """Residual rows worth keeping: unflagged, used or reserved, with a position."""
    # Filters come first, on plain columns: filters on derived ones make the optimizer infer
    # a great many constraints.
    kept = F.col("x").isNotNull() & F.col("y").isNotNull()
    if remove_flagged:
        kept = kept & ~F.col("flag")
    if used_or_reserved:
        kept = kept & S.has_any("status", S.USED | S.RESERVED)
    return residual_columns(lines.where(kept))


def with_observation(
    lines: DataFrame,
    observations: DataFrame | None = None,
    calibration: DataFrame | None = None,
    exclusion_pixels: float = 0.0,
) -> DataFrame:
    """Lines with what differs by dataset: ``observationReason`` and ``isScience`` of the visit,
    and ``exclusionRadius``, which is ``exclusion_pixels`` times the dispersion at the detector's
    center.

    ``observations`` has one row per visit. A visit without a reason is not a science one, a
    detector without calibration has no radius.
    """
    if observations is not None:
        reasons = observations.select("visit", "observationReason")
        lines = join_per_group(lines.drop("observationReason"), reasons, ["visit"], "left")
        lines = lines.withColumn("isScience", F.coalesce(F.col("observationReason") == SCIENCE, F.lit(False)))
    if calibration is not None and exclusion_pixels > 0:
        at_center = cut(dispersion_at_center(calibration)).withColumn("exclusionRadius", F.col("dispersion") * exclusion_pixels)
        lines = join_per_group(lines.drop("exclusionRadius"), at_center.drop("dispersion"), ["arm", "spectrograph"], "left")
    return lines


def residual_data(
    lines: DataFrame,
    bundles: DataFrame | None = None,
    keys: Sequence[str] = DATASET,
    is_science: bool | Column = False,
    observations: DataFrame | None = None,
    calibration: DataFrame | None = None,
    exclusion_pixels: float = 0.0,
    status_names: dict[str, int] | None = None,
    **cuts,
) -> DataFrame:
    """Good lines with their residuals and outlier flags, outliers removed: lines by their y
    residual, traces by x. ``bundles`` adds the fiber's bundle columns.

    ``observations`` gives every visit its own science flag instead of ``is_science``, and
    ``exclusion_pixels`` every detector its own radius (:func:`with_observation`).
    ``calibration`` adds ``dispersion``, the wavelength per pixel at the line, and
    ``status_names`` adds ``status_name``, the names of all bits that are set.
    """
    lines = with_observation(lines, observations, calibration, exclusion_pixels)
    if observations is not None:
        is_science = F.col("isScience")
    if "exclusionRadius" in lines.columns:
        cuts["exclusion_radius"] = F.col("exclusionRadius")
    rows = scrub(good_lines(lines, keys, is_science=is_science, **cuts))
    if status_names is not None:
        rows = rows.withColumn("status_name", S.status_name("status", status_names))
    groups = [*keys, "status_type", "description"]
    rows = sigma_clip(rows, groups, {"xResid": "xResidOutlier", "yResid": "yResidOutlier"})
    if bundles is not None:
        rows = rows.join(bundles, "fiberId")
    keep = (F.col("isLine") & ~F.col("yResidOutlier")) | (F.col("isTrace") & ~F.col("xResidOutlier"))
    rows = rows.where(keep)
    # Last, so that only what is kept moves to its calibration, and once.
    return rows if calibration is None else with_dispersion(rows, calibration, places=lines)


def fit_stats(
    rows: DataFrame,
    keys: Sequence[str] = (*DATASET, "status_type", "description"),
    num_params: int = 0,
    clipped_only: bool = True,
    x_soften: float = 0.0,
    y_soften: float = 0.0,
) -> DataFrame:
    """Spatial and wavelength fit statistics per group, as two structs, with chi2 and dof.

    ``x_soften`` and ``y_soften`` are added in quadrature to the errors of chi2 and of the
    weighted RMS.
    """
    keys = list(keys)
    if clipped_only:
        rows = rows.where(~F.col("xResidOutlier"))
    line = F.col("isLine") & F.col("yResid").isNotNull()
    rows = cut(
        rows.select(
            *keys,
            "fiberId",
            "wavelength",
            "isTrace",
            line.alias("__line"),
            "xResid",
            "xErr",
            F.when(line, F.col("yResid")).alias("__y"),
            F.when(line, F.col("yErr")).alias("__yErr"),
        )
    )
    line = F.col("__line")
    half = num_params / 2.0
    stats = group_stats(
        rows,
        keys,
        [
            (F.count(F.lit(1)) - half).alias("xDof"),
            (F.count("__y") - half).alias("yDof"),
            T.chi2("xResid", "xErr", x_soften).alias("chi2X"),
            T.chi2("__y", "__yErr", y_soften).alias("chi2Y"),
            T.weighted_rms("xResid", "xErr", x_soften).alias("xWeighted"),
            T.weighted_rms("__y", "__yErr", y_soften).alias("yWeighted"),
        ],
        {
            "x25": ("xResid", 0.25),
            "x50": ("xResid", 0.5),
            "x75": ("xResid", 0.75),
            "y25": ("__y", 0.25),
            "y50": ("__y", 0.5),
            "y75": ("__y", 0.75),
        },
    )
    soft = soften_fit(rows, keys, {"xSoft": ("xResid", "xErr"), "ySoft": ("__y", "__yErr")}, num_params)
    # Distinct counts multiply their input rows, so they get an aggregation of their own.
    numbers = rows.groupBy(*keys).agg(
        F.count_distinct(F.when(F.col("isTrace"), F.col("fiberId"))).alias("xFibers"),
        F.count_distinct(F.when(line, F.col("fiberId"))).alias("yFibers"),
        F.count_distinct(F.when(line, F.col("wavelength"))).alias("yLines"),
    )
    joined = stats.join(soft, keys).join(numbers, keys)

    def part(a: str, lines_column: str):
        return F.struct(
            F.col(f"{a}50").alias("median"),
            ((F.col(f"{a}75") - F.col(f"{a}25")) * T.IQR_ROBUST).alias("robustRms"),
            F.col(f"{a}Weighted").alias("weightedRms"),
            F.col(f"{a}Soft").alias("softenFit"),
            F.col(f"{a}Dof").alias("dof"),
            F.col(f"{a}Fibers").alias("num_fibers"),
            F.col(lines_column).alias("num_lines"),
        )

    return joined.select(
        *keys,
        (F.col("xDof") + F.col("yDof")).alias("dof"),
        "chi2X",
        "chi2Y",
        part("x", "xFibers").alias("spatial"),
        part("y", "yLines").alias("wavelength"),
    )


def with_detector(stats: DataFrame, reason: str | DataFrame | None = None) -> DataFrame:
    """Statistics with the detector's name, and ``observationReason``: one for all rows, or from
    a table with one row per visit.
    """
    out = stats.withColumn("ccd", S.ccd())
    if isinstance(reason, DataFrame):
        return join_per_group(out, reason.select("visit", "observationReason"), ["visit"], "left")
    return out if reason is None else out.withColumn("observationReason", F.lit(reason))


def stats_over_visits(stats: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Median of every numeric statistic over the visits (flattened columns)."""
    return group_stats(stats, keys, quantiles={c: (c, 0.5) for c in columns})


# tables of the per-visit report


def plot_rows(rows: DataFrame, column: str) -> DataFrame:
    """Rows for one residual, once per status flag: lines for y, traces for x."""
    kind = ~F.col("isTrace") if column.startswith("y") else F.col("isTrace")
    return melt_status(rows).where(kind).withColumnRenamed(f"{column}Outlier", "isOutlier")


def fiber_summary(rows: DataFrame, column: str, keys: Sequence[str] = DATASET) -> DataFrame:
    """Count, median and weighted RMS per fiber, status and outlier flag."""
    group, err = [*keys, "fiberId", "status", "isOutlier"], f"{column[0]}Err"
    return group_stats(
        cut(rows.select(*group, column, err)),
        group,
        [
            F.count(F.lit(1)).alias("count"),
            T.weighted_rms(column, err).alias("weightedRms"),
        ],
        {"median": (column, 0.5)},
    )


def outlier_fibers(summary: DataFrame, rms: DataFrame, keys: Sequence[str] = DATASET) -> DataFrame:
    """Reserved fibers whose median is beyond one and beyond 2.5 weighted RMS of the dataset.

    ``rms`` has the dataset's ``rms``.
    """
    size = F.abs(F.col("median"))
    good = summary.where((F.col("status") == "isReserved") & ~F.col("isOutlier")).join(rms, list(keys))
    return good.groupBy(*keys).agg(
        T.count_where(size >= F.col("rms")).alias("beyond1"),
        T.count_where((size >= F.col("rms")) & (size >= F.col("rms") * SIGMA_RANGE)).alias("beyond2"),
        F.max("rms").alias("limit1"),
        (F.max("rms") * SIGMA_RANGE).alias("limit2"),
    )


def binned_residual(rows: DataFrame, column: str, step: float, keys: Sequence[str] = DATASET) -> DataFrame:
    """Median wavelength and residual per wavelength bin, status and outlier flag."""
    rows = rows.na.drop(subset=["wavelength"]).select(*keys, "status", "isOutlier", "wavelength", column)
    binned = step_bin(cut(rows), keys, "wavelength", step, "bin")
    return group_stats(
        cut(binned.na.drop(subset=[column])),
        [*keys, "bin", "status", "isOutlier"],
        quantiles={"wavelength": ("wavelength", 0.5), column: (column, 0.5)},
    )


# tables of the combined report


def combine_visits(rows: DataFrame, place: Sequence[str] = ("arm", "spectrograph")) -> DataFrame:
    """Mean over visits per detector, status, kind, fiber and row; flags become fractions."""
    columns = [
        "wavelength", "x", "xErr", "yErr", "xResid", "yResid",
        "isTrace", "xResidOutlier", "yResidOutlier", "isUsed", "isReserved",
    ]
    types = dict(rows.dtypes)
    means = [F.avg(F.col(c).cast("int") if types[c] == "boolean" else F.col(c)).alias(c) for c in columns]
    return rows.groupBy(*place, "status", "isLine", "fiberId", "y").agg(*means)


def ccd_position(ccd: str = "ccd"):
    """Sort key of a detector; zero for one that is not in the fixed order."""
    return F.array_position(F.array(*[F.lit(c) for c in DETECTOR_ORDER]), F.col(ccd))


def detector_summary(stats: DataFrame) -> DataFrame:
    """Mean statistics per detector: spatial ones from traces, wavelength ones from lines."""
    trace = S.is_trace()
    means = [F.avg(F.when(trace, F.col(f"spatial_{m}"))).alias(f"spatial_{m}") for m in METRICS]
    means += [F.avg(F.when(~trace, F.col(f"wavelength_{m}"))).alias(f"wavelength_{m}") for m in METRICS]
    return stats.groupBy("ccd").agg(*means)


def stats_long(stats: DataFrame) -> DataFrame:
    """(ccd, description, variable, value) rows; spatial values of lines are left out."""
    columns = [f"{part}_{m}" for m in METRICS for part in ("spatial", "wavelength")]
    long = stats.select("ccd", "description", *columns).unpivot(["ccd", "description"], columns, "variable", "value")
    spatial_of_line = ~S.is_trace() & F.startswith(F.col("variable"), F.lit("spatial"))
    return long.withColumn("value", F.when(~spatial_of_line, F.col("value"))).na.drop(subset=["value"])


def detector_box(stats: DataFrame) -> DataFrame:
    """Box-plot numbers per detector, description and metric; whiskers end at the last value
    within 1.5 interquartile ranges.
    """
    keys = ["ccd", "description", "variable"]
    long = cut(stats_long(stats))
    box = group_stats(
        long,
        keys,
        [F.count("value").alias("count")],
        {"q25": ("value", 0.25), "q50": ("value", 0.5), "q75": ("value", 0.75)},
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = (F.col("value") >= F.col("q25") - reach) & (F.col("value") <= F.col("q75") + reach)
    whiskers = (
        long.join(box, keys)
        .where(inside)
        .groupBy(*keys)
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )
    return box.join(whiskers, keys)


def visit_summary(stats: DataFrame) -> DataFrame:
    """Per detector and kind: median of the medians and one weighted RMS to both sides."""
    kinds = []
    for kind, rows in (("spatial", S.is_trace()), ("wavelength", ~S.is_trace())):
        one = group_stats(
            stats.where(rows),
            ["ccd"],
            quantiles={"median": (f"{kind}_median", 0.5), "rms": (f"{kind}_weightedRms", 0.5)},
        )
        kinds.append(one.withColumn("kind", F.lit(kind)))
    both = kinds[0].unionByName(kinds[1])
    return both.withColumns({"upper": F.col("median") + F.col("rms"), "lower": F.col("median") - F.col("rms")})


def visit_order(stats: DataFrame, ties_by: Sequence[str] = ("description", "status_type")) -> DataFrame:
    """Position of each statistics row in visit order per detector, and of its visit."""
    ranked = first_come_rank(stats, ["ccd"], "visit", ties_by, "visit_idx")
    first = ranked.groupBy("ccd", "visit").agg(F.min("visit_idx").alias("first_idx"))
    return ranked.join(first, ["ccd", "visit"])
