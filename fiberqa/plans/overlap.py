"""Lines measured in two arms at once, compared through the wavelength calibration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats as T
from ..functions.scalars import wavelength_key
from ..operators.interpolation import interpolate
from ..operators.lines import measured_lines
from ..operators.ordering import group_stats
from ..operators.windows import first_per_key
from ..sources.frames import cut, fiber_keys

# Lines seen by both arms.
OVERLAP_LINES = (
    "630.20", "636.55", "937.69", "937.85", "942.23", "947.94", "952.20",
    "957.00", "970.19", "972.25", "979.21", "979.38", "980.24",
)
PLACE = ("visit", "spectrograph", "fiberId", "wavelength")


def overlap_pairs(
    lines: DataFrame, arms: tuple[str, str], listed: Sequence[str] | None = OVERLAP_LINES,
    order: Sequence[str] = ("y",),
) -> DataFrame:
    """Rows of both arms for the same fiber and identical wavelength, as ``y0`` and ``y1``.

    Several measurements of one line count once, the first in ``order``. Only listed lines
    are kept, all of them with ``listed=None``.
    """
    rows = measured_lines(lines)
    if listed is not None:
        rows = rows.where(wavelength_key("wavelength").isin(*listed))
    sides = []
    for i, arm in enumerate(arms):
        own = first_per_key(rows.where(F.col("arm") == arm).select(*PLACE, "y"), list(PLACE), list(order))
        sides.append(own.withColumnRenamed("y", f"y{i}"))
    return sides[0].join(sides[1], list(PLACE))


def wavelength_at_row(pairs: DataFrame, calibration: DataFrame, arms: tuple[str, str]) -> DataFrame:
    """Calibrated wavelength of both rows, interpolated in a sampled table
    (arm, spectrograph, fiberId, row, wavelength), and their difference. A calibration with a
    ``visit`` column is taken visit by visit.
    """
    keys = fiber_keys(calibration, "spectrograph", "fiberId")
    out = cut(pairs)
    for i, arm in enumerate(arms):
        knots = calibration.where(F.col("arm") == arm).select(*keys, F.col("row").alias(f"y{i}"), F.col("wavelength").alias(f"w{i}"))
        out = interpolate(out, knots, keys, f"y{i}", f"w{i}")
    return out.withColumn("difference", F.col("w0") - F.col("w1"))


def overlap_stats(pairs: DataFrame, keys: Sequence[str] = ("visit", "spectrograph", "wavelength")) -> DataFrame:
    """Fibers, median and robust sigma of the difference per visit, spectrograph and line."""
    out = group_stats(
        pairs,
        keys,
        [F.count_distinct("fiberId").alias("fibers"), F.count(F.lit(1)).alias("pairs")],
        {"q25": ("difference", 0.25), "median": ("difference", 0.5), "q75": ("difference", 0.75)},
    )
    return out.withColumn("sigma", (F.col("q75") - F.col("q25")) / T.IQR_PER_SIGMA).drop("q25", "q75")
