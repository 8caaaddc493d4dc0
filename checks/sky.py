"""Queries on sky-subtracted spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.functions import stats as T
from fiberqa.operators.binning import bin_label, equal_width_bin
from fiberqa.operators.ordering import average_rank, percent_rank_of, ranked
from fiberqa.operators.reshape import arrays_of_rows, rows_of_arrays, same_value_or_error
from fiberqa.operators.windows import mean_of_others, median_of_others
from fiberqa.plans import sky as K

from .catalog import LOT
from .overlap import interp_sql
from .registry import case

DS = ["visit", "arm", "spectrograph"]
DS_SQL = "visit, arm, spectrograph"
OK = "flux IS NOT NULL AND sky > 0 AND variance > 0 AND mask = 0"
SKY = f"""sk AS (SELECT *, ({OK}) AS usable, CASE WHEN {OK} THEN sqrt(variance) END AS std, CASE WHEN {OK} THEN flux / sqrt(variance) END AS chi,
  CASE WHEN {OK} THEN sqrt(abs(flux + sky)) END AS std_poisson, CASE WHEN {OK} THEN flux / nullif(sqrt(abs(flux + sky)), 0) END AS chi_poisson FROM spectra)"""


@case("sky_chi", "Q11 P9 P10 F13", "spectra", f"WITH {SKY} SELECT {DS_SQL}, fiberId, pix, usable, std, chi, std_poisson, chi_poisson FROM sk", "std chi std_poisson chi_poisson")
def _(v):
    return K.sky_columns(v.spectra).select(*DS, "fiberId", "pix", "usable", "std", "chi", "std_poisson", "chi_poisson")


@case(
    "sky_fiber_stats", "Q11 G4 R7", "spectra",
    f"WITH {SKY} SELECT {DS_SQL}, fiberId, avg(chi) AS fiberChiMean, median(chi) AS fiberChiMedian, stddev_samp(chi) AS fiberChiStd, 0.741 * (quantile_cont(chi, 0.75) - quantile_cont(chi, 0.25)) AS fiberChiIQR FROM sk GROUP BY ALL",
    "fiberChiMean fiberChiMedian fiberChiStd fiberChiIQR",
)
def _(v):
    return K.chi_stats(K.sky_columns(v.spectra))


LOO = "s AS (SELECT * FROM spectra WHERE fiberId IN (SELECT fiberId FROM fibers WHERE targetType = 'SKY'))"


@case(
    "sky_left_one_out_median", "Q10 I3 W6 J3", "spectra fibers",
    f"""WITH {LOO} SELECT a.visit, a.arm, a.spectrograph, a.fiberId, a.pix, any_value(a.flux) AS flux, median(b.flux) FILTER (WHERE b.mask = 0) AS skyModel, any_value(a.flux) - median(b.flux) FILTER (WHERE b.mask = 0) AS residual
    FROM s AS a LEFT JOIN s AS b ON a.visit = b.visit AND a.arm = b.arm AND a.spectrograph = b.spectrograph AND a.pix = b.pix AND a.fiberId <> b.fiberId GROUP BY a.visit, a.arm, a.spectrograph, a.fiberId, a.pix""",
    "flux skyModel residual",
)
def _(v):
    return K.subtract_others(v.spectra, v.fibers).select(*DS, "fiberId", "pix", "flux", "skyModel", "residual")


@case(
    "sky_left_one_out_mean", "Q10 I3 W6", "spectra fibers",
    f"""WITH {LOO} SELECT a.visit, a.arm, a.spectrograph, a.fiberId, a.pix, any_value(a.flux) AS flux, avg(b.flux) FILTER (WHERE b.mask = 0) AS skyModel, any_value(a.flux) - avg(b.flux) FILTER (WHERE b.mask = 0) AS residual
    FROM s AS a LEFT JOIN s AS b ON a.visit = b.visit AND a.arm = b.arm AND a.spectrograph = b.spectrograph AND a.pix = b.pix AND a.fiberId <> b.fiberId GROUP BY a.visit, a.arm, a.spectrograph, a.fiberId, a.pix""",
    "flux skyModel residual",
)
def _(v):
    return K.subtract_others(v.spectra, v.fibers, how="mean").select(*DS, "fiberId", "pix", "flux", "skyModel", "residual")


@case(
    "others_in_dataset", "W6", "spectra",
    f"""WITH n AS (SELECT *, count(*) OVER g AS n, row_number() OVER (PARTITION BY {DS_SQL}, pix ORDER BY flux, fiberId) AS k, list(flux) OVER (PARTITION BY {DS_SQL}, pix ORDER BY flux, fiberId ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS vs FROM spectra WINDOW g AS (PARTITION BY {DS_SQL}, pix))
    SELECT {DS_SQL}, fiberId, pix, list_median(list_concat(vs[1:k - 1], vs[k + 1:])) AS middle, (list_sum(vs) - flux) / nullif(n - 1, 0) AS mean FROM n""",
    "middle mean",
)
def _(v):
    rows = median_of_others(v.spectra, [*DS, "pix"], "flux", "middle")
    return mean_of_others(rows, [*DS, "pix"], "flux", "mean").select(*DS, "fiberId", "pix", "middle", "mean")


@case(
    "chi_heat_map", "Q11 R4 P27", "spectra",
    f"""WITH {SKY}, c AS (SELECT {DS_SQL}, fiberId, CAST(floor(wavelength) AS INT) AS wave_row, avg(chi) AS chi FROM sk WHERE chi IS NOT NULL GROUP BY ALL),
    e AS (SELECT {DS_SQL}, min(wave_row) AS a, max(wave_row) AS b FROM c GROUP BY ALL), f AS (SELECT DISTINCT {DS_SQL}, fiberId FROM c),
    d AS (SELECT {DS_SQL}, fiberId, CAST(unnest(range(a, b + 1)) AS INT) AS wave_row FROM f JOIN e USING ({DS_SQL}))
    SELECT {DS_SQL}, fiberId, wave_row, chi FROM d LEFT JOIN c USING ({DS_SQL}, fiberId, wave_row)""",
    "chi",
)
def _(v):
    return K.heat_map(K.sky_columns(v.spectra))


@case("chi_outliers", "Q11 P22 F15", "spectra", f"WITH {SKY} SELECT arm, fiberId, pix, chi, CASE WHEN abs(chi) < 3 THEN '< 3' WHEN abs(chi) > 10 THEN '> 10' ELSE '3 < x < 10' END AS chi_value FROM sk WHERE abs(chi) >= 3", "chi")
def _(v):
    return K.outliers(K.sky_columns(v.spectra)).select("arm", "fiberId", "pix", "chi", "chi_value")


def reference_sql(name: str, value: str, source: str = "sk") -> str:
    """CTEs up to ``<name>_on``: fibers interpolated to the longest fiber's grid."""
    return f"""{name}_u AS (SELECT {DS_SQL}, fiberId, wavelength, {value} AS m FROM {source} WHERE usable),
  {name}_n AS (SELECT {DS_SQL}, fiberId, count(*) AS n FROM {name}_u GROUP BY ALL),
  {name}_g AS (SELECT {DS_SQL}, wavelength FROM {name}_u JOIN (SELECT {DS_SQL}, fiberId FROM {name}_n QUALIFY row_number() OVER (PARTITION BY {DS_SQL} ORDER BY n DESC, fiberId) = 1) AS l USING ({DS_SQL}, fiberId)),
  {name}_f AS (SELECT {DS_SQL}, fiberId, wavelength FROM {name}_g JOIN (SELECT {DS_SQL}, fiberId FROM {name}_n) AS f USING ({DS_SQL})),
  {interp_sql(f'{name}_on', f'{name}_f', 'wavelength', f'{name}_u', ['visit', 'arm', 'spectrograph', 'fiberId'], 'wavelength', 'm', 'value')}"""


REFERENCES = {
    "total": ("none", "median", "sky + flux", "median(value)"),
    "sky": ("sky", "mean", "sky", "avg(value)"),
    "chi": ("chi", "median", "chi", "median(value)"),
    "chi_poisson": ("chi_poisson", "mean", "chi_poisson", "avg(value)"),
    "residual": ("residuals", "mean", "flux", "avg(value)"),
    "variance": ("variance", "quadrature", "std * std", "sqrt(sum(value * value))"),
    "total_chi": ("sky_chi", "median", "(sky + flux) / std", "median(value)"),
}


def _register_reference(name: str, model: str, func: str, value: str, how: str) -> None:
    @case(
        f"reference_{name}", "Q11 G35 W10 A1" + (" A9" if func == "quadrature" else ""), "spectra",
        f"WITH {SKY}, {reference_sql('r', value)} SELECT {DS_SQL}, wavelength, count(value) AS fibers, {how} AS value FROM r_on GROUP BY ALL",
        "wavelength value",
    )
    def _(v):
        return K.build_reference(K.sky_columns(v.spectra), model, func)


for _name, _spec in REFERENCES.items():
    _register_reference(_name, *_spec)


@case(
    "reference_grid", "Q11 W10", "spectra",
    f"WITH {SKY}, {reference_sql('r', 'flux')} SELECT * FROM r_g", "wavelength",
)
def _(v):
    return K.reference_grid(K.sky_columns(v.spectra).where("usable"))


def split_sql(value: str) -> str:
    """CTEs up to ``rs``: the test fibers' median of ``value`` with the reference fibers' sky."""
    return f"""{SKY}, sl AS (SELECT *, {LOT} AS lot FROM sk WHERE usable), sf AS (SELECT DISTINCT {DS_SQL}, fiberId, lot FROM sl),
  so AS (SELECT *, row_number() OVER (PARTITION BY {DS_SQL} ORDER BY lot) AS place, count(*) OVER (PARTITION BY {DS_SQL}) AS n FROM sf),
  se AS (SELECT {DS_SQL}, lot AS last FROM so WHERE place = greatest(floor(n * 0.3::DOUBLE), 1)),
  sr AS (SELECT sl.* FROM sl JOIN se USING ({DS_SQL}) WHERE lot <= last), st AS (SELECT sl.* FROM sl JOIN se USING ({DS_SQL}) WHERE lot > last),
  {reference_sql('a', 'sky + flux', 'sr')}, {reference_sql('b', value, 'st')},
  va AS (SELECT {DS_SQL}, wavelength, median(value) AS sky FROM a_on GROUP BY ALL), vb AS (SELECT {DS_SQL}, wavelength, median(value) AS value FROM b_on GROUP BY ALL),
  {interp_sql('rs', 'vb', 'wavelength', 'va', DS, 'wavelength', 'sky', 'sky')}"""


@case("residual_and_sky", "Q11 W13 G35 A1", "spectra", f"WITH {split_sql('flux')} SELECT {DS_SQL}, wavelength, value, sky FROM rs", "wavelength value sky")
def _(v):
    return K.residual_against_sky(K.sky_columns(v.spectra), fraction=0.3)


@case(
    "chi_by_reference_brightness", "Q11 W13 W1 A2 G36", "spectra",
    f"""WITH {split_sql('chi')}, rk AS (SELECT *, 100.0 * (rank() OVER (PARTITION BY {DS_SQL} ORDER BY sky) + (count(*) OVER (PARTITION BY {DS_SQL}, sky) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY {DS_SQL}) AS ranked FROM rs),
    bn AS (SELECT *, (CAST(least(10, greatest(1, ceil(coalesce((ranked - min(ranked) OVER p) / nullif(max(ranked) OVER p - min(ranked) OVER p, 0) * 10, 1)))) AS INT) - 1) * 11 AS ranked_bin FROM rk WINDOW p AS (PARTITION BY {DS_SQL}))
    SELECT {DS_SQL}, ranked_bin, count(value) AS count, median(value) AS median, 0.741 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS robustRms FROM bn GROUP BY ALL""",
    "median robustRms",
)
def _(v):
    return K.chi_by_brightness(K.reference_brightness(K.sky_columns(v.spectra), fraction=0.3))


RANK = f"""{SKY}, t AS (SELECT *, flux + sky AS totalFlux FROM sk WHERE usable),
  rk AS (SELECT *, 100.0 * (rank() OVER (PARTITION BY visit, spectrograph, fiberId ORDER BY totalFlux) + (count(*) OVER (PARTITION BY visit, spectrograph, fiberId, totalFlux) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY visit, spectrograph, fiberId) AS ranked,
    rank() OVER (PARTITION BY visit, spectrograph, arm, fiberId ORDER BY wavelength) + (count(*) OVER (PARTITION BY visit, spectrograph, arm, fiberId, wavelength) - 1) / 2.0::DOUBLE AS wave_rank FROM t),
  bn AS (SELECT *, CAST(least(10, greatest(1, ceil(coalesce((ranked - min(ranked) OVER p) / nullif(max(ranked) OVER p - min(ranked) OVER p, 0) * 10, 1)))) AS INT) AS bin FROM rk WINDOW p AS (PARTITION BY visit, spectrograph)),
  lb AS (SELECT *, (bin - 1) * 11 AS ranked_bin FROM bn)"""


@case("brightness_ranks", "Q11 W1 W2 A2", "spectra", f"WITH {RANK} SELECT visit, arm, fiberId, pix, ranked, wave_rank, bin, ranked_bin FROM lb", "ranked wave_rank")
def _(v):
    return K.brightness_bins(K.sky_columns(v.spectra)).select("visit", "arm", "fiberId", "pix", "ranked", "wave_rank", "bin", "ranked_bin")


@case(
    "chi_by_brightness", "Q11 G36", "spectra",
    f"WITH {RANK} SELECT visit, arm, spectrograph, ranked_bin, count(chi) AS count, median(chi) AS median, 0.741 * (quantile_cont(chi, 0.75) - quantile_cont(chi, 0.25)) AS robustRms FROM lb GROUP BY ALL", "median robustRms",
)
def _(v):
    return K.chi_by_brightness(K.brightness_bins(K.sky_columns(v.spectra)))


@case(
    "poisson_chi_by_brightness", "Q11 G36", "spectra",
    f"WITH {RANK} SELECT visit, arm, spectrograph, ranked_bin, count(chi_poisson) AS count, median(chi_poisson) AS median, 0.741 * (quantile_cont(chi_poisson, 0.75) - quantile_cont(chi_poisson, 0.25)) AS robustRms FROM lb GROUP BY ALL", "median robustRms",
)
def _(v):
    return K.chi_by_brightness(K.brightness_bins(K.sky_columns(v.spectra)), column="chi_poisson")


@case(
    "percent_ranks", "W1 W2", "lines",
    """SELECT visit, arm, fiberId, wavelength, 100.0 * (rank() OVER w + (count(*) OVER (PARTITION BY visit, arm, wavelength) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY visit, arm) AS pct,
    rank() OVER w + (count(*) OVER (PARTITION BY visit, arm, wavelength) - 1) / 2.0::DOUBLE AS rnk, flux FROM lines WINDOW w AS (PARTITION BY visit, arm ORDER BY wavelength)""",
    "wavelength pct rnk flux",
)
def _(v):
    rows = percent_rank_of(v.lines.select("visit", "arm", "fiberId", "wavelength", "flux"), ["visit", "arm"], "wavelength", "pct")
    rows = ranked(rows, ["visit", "arm"], "wavelength").withColumn("rnk", average_rank())
    return rows.select("visit", "arm", "fiberId", "wavelength", "pct", "rnk", "flux")


@case(
    "equal_width_bins", "A2", "spectra",
    f"SELECT {DS_SQL}, fiberId, pix, flux, CAST(least(10, greatest(1, ceil((flux - min(flux) OVER w) / (max(flux) OVER w - min(flux) OVER w) * 10))) AS INT) AS bin FROM spectra WINDOW w AS (PARTITION BY {DS_SQL})", "flux",
)
def _(v):
    return equal_width_bin(v.spectra, DS, "flux", 10, "bin").select(*DS, "fiberId", "pix", "flux", "bin")


@case(
    "bin_labels", "A2", "spectra",
    """WITH b AS (SELECT arm, (CAST(least(10, greatest(1, ceil((flux - min(flux) OVER w) / (max(flux) OVER w - min(flux) OVER w) * 10))) AS INT) - 1) * 11 AS label FROM spectra WINDOW w AS (PARTITION BY arm))
    SELECT arm, label, count(*) AS n FROM b GROUP BY ALL""",
)
def _(v):
    rows = equal_width_bin(v.spectra, ["arm"], "flux", 10, "bin")
    return rows.groupBy("arm", bin_label("bin", 10).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def density_sql(column: str, keys: str) -> str:
    return f"""c AS (SELECT {keys}, CAST(least(floor(({column} + 5) / 10::DOUBLE * 30), 29) AS INT) AS bin, count(*) AS n FROM sk WHERE {column} >= -5 AND {column} <= 5 GROUP BY ALL),
  e AS (SELECT {keys}, CAST(unnest(range(30)) AS INT) AS bin FROM (SELECT DISTINCT {keys} FROM sk) AS k), h AS (SELECT {keys}, bin, -5 + bin * (10::DOUBLE / 30) AS "left", -5 + (bin + 1) * (10::DOUBLE / 30) AS "right", coalesce(n, 0) AS count FROM e LEFT JOIN c USING ({keys}, bin))
  SELECT *, count / nullif(sum(count) OVER (PARTITION BY {keys}) * ("right" - "left"), 0) AS density, exp(-0.5 * ((("left" + "right") / 2) * (("left" + "right") / 2))) / sqrt(2 * pi()) AS normal FROM h"""


@case("chi_histograms", "Q11 A5 A11", "spectra", f"WITH {SKY}, {density_sql('chi', f'{DS_SQL}, fiberId')}", "left right density normal")
def _(v):
    return K.chi_histogram(K.sky_columns(v.spectra))


@case("combined_chi_histograms", "Q11 A5 A11", "spectra", f"WITH {SKY}, {density_sql('chi_poisson', 'arm')}", "left right density normal")
def _(v):
    return K.chi_histogram(K.sky_columns(v.spectra), ["arm"], "chi_poisson")


@case("quadrature_sum", "A9", "spectra", "SELECT arm, pix, sqrt(sum(flux * flux)) AS total FROM spectra GROUP BY ALL", "total")
def _(v):
    return v.spectra.groupBy("arm", "pix").agg(T.quadrature_sum("flux").alias("total"))


@case("whole_wavelengths", "P27", "spectra", "SELECT arm, CAST(floor(wavelength) AS INT) AS wave_row, count(*) AS n FROM spectra GROUP BY ALL")
def _(v):
    return v.spectra.groupBy("arm", S.wave_row("wavelength").alias("wave_row")).agg(F.count(F.lit(1)).alias("n"))


@case("spectra_as_arrays", "R6", "spectra", f"SELECT {DS_SQL}, fiberId, CAST(row_number() OVER (PARTITION BY {DS_SQL}, fiberId ORDER BY pix) - 1 AS INT) AS place, pix, flux, sky FROM spectra", "flux sky")
def _(v):
    keys = [*DS, "fiberId"]
    packed = arrays_of_rows(v.spectra.withColumn("p", F.col("pix")), keys, "p", ["pix", "flux", "sky"])
    return rows_of_arrays(packed, ["pix", "flux", "sky"], "place")


@case(
    "combined_arms", "Q11 G40 U1", "spectra",
    f"WITH {SKY} SELECT {DS_SQL}, 20 AS blockSize, count(chi) AS n, avg(chi) AS chi FROM sk GROUP BY {DS_SQL}", "chi",
)
def _(v):
    rows = K.sky_columns(v.spectra).groupBy(*DS).agg(F.count("chi").alias("n"), F.avg("chi").alias("chi"))
    return same_value_or_error(rows.withColumn("blockSize", F.lit(20)), ["visit", "spectrograph"], "blockSize")


# Aggregates handed in by the caller.
@case(
    "reference_of_quantile", "Q11 G35", "spectra",
    f"WITH {SKY}, {reference_sql('r', 'sky + flux')} SELECT {DS_SQL}, wavelength, count(value) AS fibers, quantile_cont(value, 0.9) AS value FROM r_on GROUP BY ALL",
    "wavelength value",
)
def _(v):
    return K.build_reference(K.sky_columns(v.spectra), "none", 0.9)


@case(
    "reference_of_function", "Q11 G35", "spectra",
    f"WITH {SKY}, {reference_sql('r', 'chi')} SELECT {DS_SQL}, wavelength, count(value) AS fibers, max(abs(value)) AS value FROM r_on GROUP BY ALL",
    "wavelength value",
)
def _(v):
    return K.build_reference(K.sky_columns(v.spectra), "chi", lambda c: F.max(F.abs(c)))


@case(
    "aggregates_by_brightness", "Q11 G36", "spectra",
    f"WITH {RANK} SELECT visit, arm, spectrograph, ranked_bin, quantile_cont(chi, 0.1) AS low, avg(chi) AS mean, quantile_cont(chi, 0.9) AS high, stddev_samp(chi) AS spread FROM lb GROUP BY ALL", "low mean high spread",
)
def _(v):
    how = {"low": 0.1, "mean": F.avg, "high": 0.9, "spread": F.stddev_samp}
    return K.aggregates_by_brightness(K.brightness_bins(K.sky_columns(v.spectra)), how)


@case(
    "chi_heat_map_of_quantile", "Q11 R4", "spectra",
    f"""WITH {SKY}, c AS (SELECT {DS_SQL}, fiberId, CAST(floor(wavelength) AS INT) AS wave_row, quantile_cont(chi, 0.75) AS chi FROM sk WHERE chi IS NOT NULL GROUP BY ALL),
    e AS (SELECT {DS_SQL}, min(wave_row) AS a, max(wave_row) AS b FROM c GROUP BY ALL), f AS (SELECT DISTINCT {DS_SQL}, fiberId FROM c),
    d AS (SELECT {DS_SQL}, fiberId, CAST(unnest(range(a, b + 1)) AS INT) AS wave_row FROM f JOIN e USING ({DS_SQL}))
    SELECT {DS_SQL}, fiberId, wave_row, chi FROM d LEFT JOIN c USING ({DS_SQL}, fiberId, wave_row)""",
    "chi",
)
def _(v):
    return K.heat_map(K.sky_columns(v.spectra), how=0.75)
