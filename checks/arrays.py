"""Queries on spectra that are stored as arrays, with the SQL of those on pixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.operators.reshape import arrays_of_rows, rows_of_arrays
from fiberqa.operators.spectra import running_median
from fiberqa.plans import fluxcal as X
from fiberqa.plans import sky as K
from fiberqa.sources.frames import cut

from .flux import SN
from .norms import medfilt_sql
from .registry import case
from .sky import DS, DS_SQL, SKY


@case("fiber_sn_of_arrays", "Q9 G22 R6", "quartz", f"WITH {SN} SELECT * FROM sn", "SN")
def _(v):
    rows = v.quartz.withColumn("w", F.col("wavelength"))
    stored = cut(arrays_of_rows(rows, ["visit", "fiberId"], "w", ["wavelength", "flux", "mask", "covar0"]))
    return X.fiber_sn_of_arrays(stored).select("visit", "fiberId", "SN")


def packed(v):
    rows = v.spectra.withColumn("p", F.col("pix"))
    return cut(arrays_of_rows(rows, [*DS, "fiberId"], "p", ["pix", "flux", "sky", "variance", "mask"]))


@case(
    "sky_chi_of_arrays", "Q11 P9 P10 R6", "spectra", f"WITH {SKY} SELECT {DS_SQL}, fiberId, pix, chi, chi_poisson FROM sk", "chi chi_poisson",
)
def _(v):
    out = K.sky_arrays(packed(v)).select(*DS, "fiberId", "pix", "chi", "chi_poisson")
    return rows_of_arrays(out, ["pix", "chi", "chi_poisson"], "place").drop("place")


@case(
    "sky_fiber_stats_of_arrays", "Q11 G4 R6", "spectra",
    f"WITH {SKY} SELECT {DS_SQL}, fiberId, avg(chi) AS fiberChiMean, median(chi) AS fiberChiMedian, stddev_samp(chi) AS fiberChiStd, 0.741 * (quantile_cont(chi, 0.75) - quantile_cont(chi, 0.25)) AS fiberChiIQR FROM sk GROUP BY ALL",
    "fiberChiMean fiberChiMedian fiberChiStd fiberChiIQR",
)
def _(v):
    return K.chi_stats_of_arrays(packed(v)).select(*DS, "fiberId", "fiberChiMean", "fiberChiMedian", "fiberChiStd", "fiberChiIQR")


@case("median_filter_of_arrays", "W5 R6", "quartz", f"WITH {medfilt_sql('m', 'quartz', 'flux', 'visit, arm, fiberId')} SELECT visit, arm, fiberId, pix, filtered FROM m", "filtered")
def _(v):
    rows = v.quartz.withColumn("p", F.col("pix"))
    stored = cut(arrays_of_rows(rows, ["visit", "arm", "fiberId"], "p", ["pix", "flux"]))
    out = stored.select("visit", "arm", "fiberId", "pix", running_median("pix", "flux").alias("filtered"))
    return rows_of_arrays(out, ["pix", "filtered"], "place").drop("place")
