"""Histograms of fiber-profile measures per detector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.binning import histogram

# Names of the measures, and the ranges that the report fixes.
MEASURES = ("centroid", "min", "max", "r90", "skew", "variation", "width", "wingFrac")
RANGES = {"variation": (0.0, 0.03), "max": (0.1, 0.5)}


def profile_histograms(
    profiles: DataFrame,
    keys: Sequence[str] = ("arm", "spectrograph"),
    n: int = 30,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Counts per detector, measure and bin, over the range that the report fixes for the
    measure, or else between the extremes of the detector's values.
    """
    long = profiles.select(*keys, *measures).unpivot(list(keys), list(measures), "measure", "value")
    series = [*keys, "measure"]
    ends = long.groupBy(*series).agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))
    low, high = F.col("__lo"), F.when(F.col("__hi") > F.col("__lo"), F.col("__hi")).otherwise(F.col("__lo") + 1)
    for name, (a, b) in RANGES.items():
        low = F.when(F.col("measure") == name, F.lit(a)).otherwise(low)
        high = F.when(F.col("measure") == name, F.lit(b)).otherwise(high)
    ranged = long.join(ends, series).withColumns({"lo": low, "hi": high})
    return histogram(ranged, series, "value", n, "lo", "hi")
