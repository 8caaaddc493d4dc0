"""Queries on lamp spectra: throughput ratios and their stability."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.operators.normalization import normalize_2d
from fiberqa.operators.windows import median_filter
from fiberqa.plans import norms as N
from fiberqa.sources.catalog import stability_inputs
from fiberqa.sources.frames import cut

from .registry import case

DS = ["visit", "arm", "spectrograph"]
DS_SQL = "visit, arm, spectrograph"
BAND = "CASE arm WHEN 'b' THEN wavelength BETWEEN 450 AND 650 WHEN 'n' THEN wavelength BETWEEN 950 AND 1250 ELSE wavelength BETWEEN 650 AND 950 END"
PAIRS = f"""good AS (SELECT fiberId, spectrograph FROM fibers WHERE targetType <> 'ENGINEERING' AND fiberStatus = 'GOOD'),
  usable AS (SELECT quartz.* FROM quartz JOIN good USING (fiberId, spectrograph)),
  pairs AS (SELECT t.*, r.flux AS refFlux, r.norm AS refNorm, CASE WHEN {BAND.replace('wavelength', 't.wavelength').replace('CASE arm', 'CASE t.arm')} THEN t.flux / nullif(r.flux, 0) END AS naive,
    CASE WHEN {BAND.replace('wavelength', 't.wavelength').replace('CASE arm', 'CASE t.arm')} THEN (t.flux / t.norm) / nullif(r.flux / r.norm, 0) END AS flattened
    FROM usable AS t JOIN usable AS r ON r.visit = 1000 AND t.arm = r.arm AND t.spectrograph = r.spectrograph AND t.fiberId = r.fiberId AND t.pix = r.pix WHERE t.visit <> 1000)"""


def normal_sql(name, source, value):
    return f"""{name} AS (SELECT *, {value} / nullif(median({value}) OVER (PARTITION BY {DS_SQL}, pix) * median({value}) OVER (PARTITION BY {DS_SQL}, fiberId) / nullif(median({value}) OVER (PARTITION BY {DS_SQL}), 0), 0) AS ratio FROM {source})"""


RATIO = f"{PAIRS}, {normal_sql('ratios', 'pairs', 'naive')}"
SIGMA = f"""{RATIO}, sig AS (SELECT {DS_SQL}, fiberId, stddev_pop(ratio) AS sigma_std, median(ratio) AS ratioMedian, 0.741 * (quantile_cont(ratio, 0.75) - quantile_cont(ratio, 0.25)) AS s0, median(variance) AS vm FROM ratios GROUP BY ALL),
  sigma AS (SELECT {DS_SQL}, fiberId, sigma_std, ratioMedian, CASE WHEN s0 IS NOT NULL THEN sqrt(greatest(s0 * s0 - 2 / vm, 0)) END AS sigma FROM sig)"""
TABLE = f"""{SIGMA}, tab AS (SELECT f.fiberId, f.mtp_A, substring(f.mtp_A, 1, 6) AS mtpGroup, j.visit, j.arm, coalesce(s.spectrograph, 0) AS SM, s.sigma, s.sigma_std FROM (SELECT DISTINCT visit, arm FROM sigma) AS j CROSS JOIN (SELECT DISTINCT fiberId, mtp_A FROM fibers) AS f LEFT JOIN sigma AS s ON s.visit = j.visit AND s.arm = j.arm AND s.fiberId = f.fiberId)"""
LIMIT = "CASE arm WHEN 'b' THEN 0.009 WHEN 'n' THEN 0.012 ELSE 0.0055 END"


def pairs(v):
    return N.ratio_pairs(v.quartz, v.fibers, 1000)


def sigma(v):
    return cut(N.fiber_sigma(N.normalized_ratio(pairs(v))))


def table(v):
    return N.fiber_table(sigma(v), v.fibers)


@case("in_band", "F7", "quartz", f"SELECT visit, arm, fiberId, pix, CASE WHEN {BAND} THEN flux END AS flux FROM quartz", "flux")
def _(v):
    return v.quartz.select("visit", "arm", "fiberId", "pix", N.in_band("flux").alias("flux"))


@case("finite_ratio", "P5", "quartz", "SELECT visit, fiberId, pix, arm, CASE WHEN pix % 7 <> 0 THEN flux / (pix % 7) END AS value FROM quartz", "value")
def _(v):
    step = (F.col("pix") % 7).cast("double")
    raw = F.when(step == 0, F.lit(float("inf"))).otherwise(F.col("flux") / F.when(step != 0, step))
    return v.quartz.select("visit", "fiberId", "pix", "arm", S.finite_or_null(raw).alias("value"))


@case("reference_pairs", "Q7 J7 J3", "quartz fibers", f"WITH {PAIRS} SELECT {DS_SQL}, fiberId, pix, naive, flattened FROM pairs", "naive flattened")
def _(v):
    return pairs(v).select(*DS, "fiberId", "pix", "naive", "flattened")


@case("normalized_ratio", "Q7 W7 G21", "quartz fibers", f"WITH {RATIO} SELECT {DS_SQL}, fiberId, pix, ratio FROM ratios", "ratio")
def _(v):
    return N.normalized_ratio(pairs(v)).select(*DS, "fiberId", "pix", "ratio")


@case("flattened_ratio", "Q7 W7", "quartz fibers", f"WITH {PAIRS}, {normal_sql('ratios', 'pairs', 'flattened')} SELECT {DS_SQL}, fiberId, pix, ratio FROM ratios", "ratio")
def _(v):
    return N.normalized_ratio(pairs(v), "flattened").select(*DS, "fiberId", "pix", "ratio")


def medfilt_sql(name, source, value, keys):
    return f"""{name} AS (SELECT * EXCLUDE (near), list_sort(list_concat(near, list_transform(range(15 - len(near)), lambda i: 0::DOUBLE)))[8] AS filtered FROM
    (SELECT *, coalesce(list({value}) FILTER (WHERE {value} IS NOT NULL) OVER (PARTITION BY {keys} ORDER BY pix RANGE BETWEEN 7 PRECEDING AND 7 FOLLOWING), []) AS near FROM {source}) AS w)"""


@case("median_filter", "W5", "quartz", f"WITH {medfilt_sql('m', 'quartz', 'flux', 'visit, arm, fiberId')} SELECT visit, arm, fiberId, pix, filtered FROM m", "filtered")
def _(v):
    out = median_filter(v.quartz, ["visit", "arm", "fiberId"], "pix", "flux", "filtered", chunk=16)
    return out.select("visit", "arm", "fiberId", "pix", "filtered")


@case(
    "filtered_ratio", "Q7 W5 W7", "quartz fibers",
    f"WITH {PAIRS}, {medfilt_sql('m', 'pairs', 'flattened', f'{DS_SQL}, fiberId')}, {normal_sql('ratios', 'm', 'filtered')} SELECT {DS_SQL}, fiberId, pix, ratio FROM ratios", "ratio",
)
def _(v):
    return N.filtered_ratio(pairs(v)).select(*DS, "fiberId", "pix", "ratio")


@case(
    "two_way_norm_of_lines", "W7", "lines",
    f"WITH s AS (SELECT visit, arm, spectrograph, fiberId, CAST(wavelength * 2 AS INT) AS pix, flux FROM lines), {normal_sql('r', 's', 'flux')} SELECT * FROM r", "flux ratio",
)
def _(v):
    rows = v.lines.select(*DS, "fiberId", (F.col("wavelength") * 2).cast("int").alias("pix"), "flux")
    return normalize_2d(rows, DS, "fiberId", "pix", "flux", "ratio")


@case("fiber_sigma", "Q7 G28 G31", "quartz fibers", f"WITH {SIGMA} SELECT * FROM sigma", "sigma_std ratioMedian sigma")
def _(v):
    return sigma(v)


@case("fiber_table", "Q7 J9 P24 S11", "quartz fibers", f"WITH {TABLE} SELECT fiberId, mtp_A, mtpGroup, arm, SM, sigma, sigma_std FROM tab", "sigma sigma_std")
def _(v):
    return table(v).select("fiberId", "mtp_A", "mtpGroup", "arm", "SM", "sigma", "sigma_std")


@case(
    "norms_record", "Q7 G29", "quartz fibers",
    f"""WITH {SIGMA} SELECT visit, arm, CASE WHEN count(sigma_std) = count(*) THEN median(sigma_std) END AS sigma_std_median, quantile_cont(sigma_std, 0.95) AS sigma_std_95,
    CASE WHEN count(sigma_std) = count(*) THEN median(sigma_std) * 2 END AS twosigma_std, quantile_cont(sigma_std, 0.95) * 2 AS twosigma_std_95, median(sigma) AS sigma_iqr FROM sigma GROUP BY ALL""",
    "sigma_std_median sigma_std_95 twosigma_std twosigma_std_95 sigma_iqr",
)
def _(v):
    return N.norms_record(sigma(v))


@case(
    "norms_flag", "Q7 G30 F16", "quartz fibers",
    f"WITH {SIGMA} SELECT visit, arm, median(sigma) AS sigmaMedian, median(sigma) + 4 * stddev_pop(sigma) AS sigmaLimit, CASE WHEN median(sigma) >= {LIMIT} THEN 'Yes' ELSE 'No' END AS flag FROM sigma GROUP BY visit, arm",
    "sigmaMedian sigmaLimit",
)
def _(v):
    return N.norms_flag(sigma(v))


@case("plotted_fibers", "Q7 F12", "quartz fibers", f"WITH {TABLE} SELECT fiberId, mtpGroup, visit, arm, SM, sigma FROM tab WHERE (mtpGroup LIKE '%U%' OR mtpGroup LIKE '%D%') AND SM <> 0", "sigma")
def _(v):
    return N.plotted_fibers(table(v)).select("fiberId", "mtpGroup", "visit", "arm", "SM", "sigma")


@case(
    "odd_fibers", "Q7 W8 F16", "quartz fibers",
    f"WITH {TABLE} SELECT visit, arm, fiberId, SM, sigma FROM tab WHERE sigma > {LIMIT} QUALIFY row_number() OVER (PARTITION BY visit, arm ORDER BY sigma DESC, fiberId) <= 15", "sigma",
)
def _(v):
    return N.odd_fibers(table(v)).select("visit", "arm", "fiberId", "SM", "sigma")


@case("used_groups", "Q7 G33 U3", "quartz fibers", f"WITH {TABLE} SELECT DISTINCT SM, mtpGroup FROM tab WHERE SM <> 0")
def _(v):
    return N.used_groups(table(v))


@case("ratio_at_pixels", "Q7 G31 A8", "quartz fibers", f"WITH {RATIO} SELECT visit, arm, fiberId, pix, ratio FROM ratios WHERE pix IN (15, 35)", "ratio")
def _(v):
    return N.ratio_at_pixel(N.normalized_ratio(pairs(v)), (15, 35)).select("visit", "arm", "fiberId", "pix", "ratio")


CLEAN = f"""cl AS (SELECT visit, arm, fiberId, pix, CASE WHEN {BAND} THEN flux / norm END AS "values" FROM quartz WHERE fiberId IN (SELECT fiberId FROM fibers WHERE fiberStatus = 'GOOD'))"""


def norms(v):
    return v.quartz.withColumn("values", F.col("flux") / F.col("norm"))


@case("clean_norms", "Q7 F7 F5", "quartz fibers", f"WITH {CLEAN} SELECT * FROM cl", "values")
def _(v):
    return N.clean_norms(norms(v), v.fibers).select("visit", "arm", "fiberId", "pix", "values")


@case(
    "norms_limits", "Q7 G32", "quartz fibers",
    f"""WITH {CLEAN}, m AS (SELECT visit, arm, fiberId, median("values") AS v FROM cl GROUP BY ALL)
    SELECT visit, arm, median(v) AS median, CASE WHEN count(v) = count(*) THEN median(v) - 2.5 * stddev_pop(v) END AS lower, CASE WHEN count(v) = count(*) THEN median(v) + 2.5 * stddev_pop(v) END AS upper FROM m GROUP BY ALL""",
    "median lower upper",
)
def _(v):
    return N.norms_limits(N.clean_norms(norms(v), v.fibers))


@case("stability_records", "Q7", "quartz fibers", f"WITH {SIGMA} SELECT visit, arm, quantile_cont(sigma_std, 0.95) AS sigma_std_95, median(sigma) AS sigma_iqr, CASE WHEN median(sigma) >= {LIMIT} THEN 'Yes' ELSE 'No' END AS flag FROM sigma GROUP BY visit, arm", "sigma_std_95 sigma_iqr")
def _(v):
    _, record, flag = N.stability(v.quartz, v.fibers, 1000)
    return record.join(flag, ["visit", "arm"]).select("visit", "arm", "sigma_std_95", "sigma_iqr", "flag")


# From the catalogue on: complete groups, the reference of each dataset, header values.
JOB_INPUTS = """ls AS (SELECT DISTINCT * FROM lamp_datasets WHERE dataset_type = 'spectra'),
  lg AS (SELECT DISTINCT s.visit, s.arm FROM ls AS s JOIN lamp_datasets AS n ON n.dataset_type = 'norms' AND n.visit = s.visit AND n.arm = s.arm JOIN lamp_datasets AS c ON c.dataset_type = 'config' AND c.visit = s.visit),
  lr AS (SELECT min(visit) AS r FROM lg), li AS (SELECT s.instrument, s.visit, s.arm, s.spectrograph, r AS refVisit FROM ls AS s JOIN lg USING (visit, arm) CROSS JOIN lr WHERE s.visit <> r AND EXISTS (SELECT 1 FROM ls AS t WHERE t.visit = r AND t.arm = s.arm AND t.spectrograph = s.spectrograph))"""
JOB_SIGMA = f"{JOB_INPUTS}, {SIGMA.replace('WHERE t.visit <> 1000', 'WHERE (t.visit, t.arm, t.spectrograph) IN (SELECT (visit, arm, spectrograph) FROM li)')}"


def job(v):
    cards = v.lamp_headers.withColumn("metadata", F.create_map(F.lit("HST"), "hst", F.lit("INSROT"), "insrot", F.lit("AZIMUTH"), "azimuth"))
    return N.stability_job(v.lamp_datasets, v.quartz, v.fibers, cards)


@case("stability_inputs", "Q7 S3 S4 S5", "lamp_datasets", f"WITH {JOB_INPUTS} SELECT * FROM li")
def _(v):
    return stability_inputs(v.lamp_datasets, N.INPUT_TYPES)


@case(
    "stability_job", "Q7 S3 S4 S9 G29 G30", "lamp_datasets lamp_headers quartz fibers",
    f"""WITH {JOB_SIGMA}, h AS (SELECT visit, arm, min(hst) AS hst, min(insrot) AS insrot, min(azimuth) AS azimuth FROM lamp_headers JOIN li USING (visit, arm, spectrograph) GROUP BY ALL),
    k AS (SELECT visit, arm, CASE WHEN count(sigma_std) = count(*) THEN median(sigma_std) END AS sigma_std_median, quantile_cont(sigma_std, 0.95) AS sigma_std_95, CASE WHEN count(sigma_std) = count(*) THEN median(sigma_std) * 2 END AS twosigma_std,
      quantile_cont(sigma_std, 0.95) * 2 AS twosigma_std_95, median(sigma) AS sigma_iqr, median(sigma) AS sigmaMedian, median(sigma) + 4 * stddev_pop(sigma) AS sigmaLimit, CASE WHEN median(sigma) >= {LIMIT} THEN 'Yes' ELSE 'No' END AS flag FROM sigma GROUP BY visit, arm)
    SELECT k.*, r AS refVisit, hst, insrot, azimuth FROM k LEFT JOIN h USING (visit, arm) CROSS JOIN lr""",
    "sigma_std_median sigma_std_95 twosigma_std twosigma_std_95 sigma_iqr sigmaMedian sigmaLimit",
)
def _(v):
    return job(v)[1]


@case("stability_fibers", "Q7 J9", "lamp_datasets quartz fibers", f"WITH {JOB_SIGMA}{TABLE[len(SIGMA):]} SELECT visit, arm, fiberId, mtp_A, mtpGroup, SM, sigma, sigma_std FROM tab", "sigma sigma_std")
def _(v):
    cards = v.quartz.select("visit", "arm", "spectrograph").distinct().withColumn("metadata", F.create_map().cast("map<string,string>"))
    return N.stability_job(v.lamp_datasets, v.quartz, v.fibers, cards)[0]
