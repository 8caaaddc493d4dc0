"""Queries on flux calibration: magnitudes, colors, calibration vector and visit records."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.functions import stats as T
from fiberqa.operators import photometry as P
from fiberqa.operators.normalization import against_median
from fiberqa.operators.ordering import group_stats
from fiberqa.operators.reshape import spread
from fiberqa.plans import fluxcal as X
from fiberqa.sources.frames import cut

from .registry import case

BANDS = X.BANDS


def mag(f: str, zero: float = 31.4) -> str:
    return f"CASE WHEN {f} > 0 THEN -2.5 * log10({f}) + {zero}::DOUBLE END"


SEGMENTS = """seg AS (SELECT filter_name, wavelength AS w0, transmission AS t0, lead(wavelength) OVER f AS w1, lead(transmission) OVER f AS t1, lead(wavelength, 2) OVER f IS NULL AS last FROM filters WINDOW f AS (PARTITION BY filter_name ORDER BY wavelength))"""


def synth_sql(where: str = "mask = 0", source: str = "quartz") -> str:
    return f"""{SEGMENTS}, px AS (SELECT visit, fiberId, filter_name, flux, (t1 - t0) / (w1 - w0) * (wavelength - w0) + t0 AS t FROM {source} JOIN seg ON wavelength >= w0 AND (wavelength < w1 OR (last AND wavelength = w1)) WHERE {where}),
  synth AS (SELECT visit, fiberId, filter_name, sum(flux * t) / nullif(sum(t), 0) AS synthFlux FROM px GROUP BY ALL HAVING sum(t) <> 0)"""


def flux_sql(where: str = "mask = 0", source: str = "quartz", stars: str = "targetType = 'FLUXSTD'") -> str:
    singles = ", ".join(f"max({mag('synthFlux')}) FILTER (WHERE filter_name = '{b}') AS single_mag_{b}" for b in BANDS)
    design = ", ".join(f"flux_{b} AS design_flux_{b}, {mag(f'flux_{b}')} AS design_mag_{b}" for b in BANDS)
    diffs = ", ".join(f"single_mag_{b} - design_mag_{b} AS diff_{b}, single_mag_g - single_mag_{b} AS color_g_{b}" for b in BANDS)
    return f"""{synth_sql(where, source)}, singles AS (SELECT visit, fiberId, {singles} FROM synth GROUP BY ALL),
  design AS (SELECT fiberId, spectrograph, objId, catId, ra, decl, xFocal, yFocal, {design} FROM fibers WHERE {stars}),
  ft AS (SELECT *, {diffs} FROM design JOIN singles USING (fiberId))"""


FLUX = flux_sql()
FT_DOUBLES = (
    "ra decl xFocal yFocal "
    + " ".join(f"design_flux_{b} design_mag_{b} single_mag_{b} diff_{b} color_g_{b}" for b in BANDS)
)


def fibers(v):
    return v.fibers.withColumnRenamed("decl", "dec")


def flux_table(v):
    return cut(X.flux_table(fibers(v), v.quartz, v.filters))


@case("ab_magnitudes", "P12 P30", "fibers", f"SELECT fiberId, {mag('flux_g')} AS mag_g, {mag('flux_i', 31.400094)} AS mag_i, {mag('flux_g - 24000')} AS faint, pow(10, -0.4 * ({mag('flux_y')} - 31.4::DOUBLE)) AS back FROM fibers", "mag_g mag_i faint back")
def _(v):
    return v.fibers.select(
        "fiberId", S.ab_mag("flux_g").alias("mag_g"), S.ab_mag("flux_i", S.ZERO_POINT_EXACT).alias("mag_i"),
        S.ab_mag(F.col("flux_g") - 24000).alias("faint"), S.flux_of_mag(S.ab_mag("flux_y")).alias("back"),
    )


@case("synthetic_flux", "Q8 G38 A1 F13", "quartz filters", f"WITH {synth_sql()} SELECT * FROM synth", "synthFlux")
def _(v):
    return P.synth_flux(v.quartz.where(F.col("mask") == 0), v.filters, ["visit", "fiberId"])


@case("design_fluxes", "Q8 P31", "fibers", "SELECT fiberId, ra, " + ", ".join(f"flux_{b} AS design_flux_{b}, {mag(f'flux_{b}')} AS design_mag_{b}" for b in BANDS) + " FROM fibers", "ra " + " ".join(f"design_flux_{b} design_mag_{b}" for b in BANDS))
def _(v):
    return P.design_flux(v.fibers, BANDS, ["fiberId", "ra"])


@case("design_fluxes_long", "P31", "fibers", f"SELECT fiberId, filter_name, design_flux, {mag('design_flux')} AS design_mag FROM (SELECT fiberId, 'g' AS filter_name, flux_g AS design_flux FROM fibers UNION ALL SELECT fiberId, 'y', flux_y FROM fibers) AS u", "design_flux design_mag")
def _(v):
    rows = v.fibers.withColumn("psfFlux", F.create_map(F.lit("g"), "flux_g", F.lit("y"), "flux_y"))
    return P.design_flux_long(rows, ["fiberId"])


@case("fake_band", "P16", "fibers", "SELECT fiberId, unnest(['g', 'y', 'fakeJ']) AS name, unnest([flux_g, flux_y, flux_y - 0.054]) AS flux FROM fibers", "flux")
def _(v):
    rows = v.fibers.select("fiberId", F.array("flux_g", "flux_y").alias("f"), F.array(F.lit("g"), F.lit("y")).alias("n"))
    zipped = F.explode(F.arrays_zip(S.fake_band("f").alias("flux"), S.fake_band_names("n").alias("name")))
    return rows.select("fiberId", zipped.alias("z")).select("fiberId", F.col("z.name"), F.col("z.flux"))


@case("flux_wide", "R3", "quartz filters", f"WITH {synth_sql()} SELECT visit, fiberId, " + ", ".join(f"max(synthFlux) FILTER (WHERE filter_name = '{b}') AS f_{b}" for b in BANDS) + " FROM synth GROUP BY ALL", " ".join(f"f_{b}" for b in BANDS))
def _(v):
    flux = P.synth_flux(v.quartz.where(F.col("mask") == 0), v.filters, ["visit", "fiberId"])
    return spread(flux, ["visit", "fiberId"], "filter_name", "synthFlux", BANDS, "f_")


@case("flux_table", "Q8 J2 J3 P13 P14 P31", "quartz filters fibers", f"WITH {FLUX} SELECT * FROM ft", FT_DOUBLES)
def _(v):
    return X.flux_table(fibers(v), v.quartz, v.filters).withColumnRenamed("dec", "decl")


@case(
    "filter_summary", "Q8 G37", "quartz filters fibers",
    f"""WITH {FLUX}, l AS (SELECT visit, filter_name, value FROM (UNPIVOT (SELECT visit, {', '.join(f'diff_{b} AS {b}' for b in BANDS)} FROM ft) ON g, r, i, z, y INTO NAME filter_name VALUE value)),
    lim AS (SELECT filter_name, CAST(floor(min(wavelength)) AS INT) AS wlMin, CAST(floor(max(wavelength)) AS INT) AS wlMax FROM filters GROUP BY ALL)
    SELECT filter_name, visit, count(value) AS count, median(value) AS median, 0.741 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS robustRms, any_value(wlMin) AS wlMin, any_value(wlMax) AS wlMax FROM l JOIN lim USING (filter_name) GROUP BY ALL""",
    "median robustRms",
)
def _(v):
    return X.filter_summary(flux_table(v), v.filters)


@case(
    "calibrated_lookup", "Q9 J3 J4 W4", "quartz fibers",
    """WITH sp AS (SELECT DISTINCT visit, fiberId - fiberId % 2 AS objId, arm, fiberId FROM quartz), c AS (SELECT visit, objId, max(fiberId) AS spectrumId FROM sp GROUP BY ALL),
    st AS (SELECT fiberId, objId FROM fibers WHERE targetType = 'FLUXSTD')
    SELECT visit, objId, spectrumId, st.fiberId, count(*) AS pixels, sum(flux) AS flux FROM c JOIN (SELECT visit, fiberId - fiberId % 2 AS objId, fiberId AS spectrumId, flux FROM quartz) AS q USING (visit, objId, spectrumId) JOIN st USING (objId) GROUP BY ALL""",
    "flux",
)
def _(v):
    spectra = v.quartz.select("visit", (F.col("fiberId") - F.col("fiberId") % 2).cast("long").alias("objId"), F.col("fiberId").alias("spectrumId"), "flux")
    stars = v.fibers.where(F.col("targetType") == "FLUXSTD")
    found = X.calibrated_of(spectra, stars)
    out = found.groupBy("visit", "objId", "spectrumId", "fiberId").agg(F.count(F.lit(1)).alias("pixels"), F.sum("flux").alias("flux"))
    return out


@case("identity_lookup", "J4", "fibers spectra", "SELECT f.fiberId, f.objId, f.catId, count(*) AS pixels FROM fibers AS f JOIN (SELECT fiberId, CAST(fiberId AS BIGINT) AS objId, (fiberId % 5) * 5 AS catId FROM spectra) AS s ON f.objId = s.objId AND f.catId = s.catId GROUP BY ALL")
def _(v):
    spectra = v.spectra.select(F.col("fiberId").cast("long").alias("objId"), ((F.col("fiberId") % 5) * 5).alias("catId"))
    return spectra.join(v.fibers, ["objId", "catId"]).groupBy("fiberId", "objId", "catId").agg(F.count(F.lit(1)).alias("pixels"))


@case("color_residuals", "Q9 P15 G20 G21 J10", "quartz filters fibers", f"WITH {FLUX} SELECT visit, fiberId, diff_g - diff_i AS color, diff_g - diff_i - median(diff_g - diff_i) OVER (PARTITION BY visit) AS centered FROM ft", "color centered")
def _(v):
    rows = flux_table(v).select("visit", "fiberId", X.color_residual().alias("color"))
    return against_median(rows, ["visit"], "color", "centered")


@case("global_median", "G21 J10", "fibers", "SELECT fiberId, flux_g / (SELECT median(flux_g) FROM fibers) AS normalized FROM fibers", "normalized")
def _(v):
    return against_median(v.fibers.select("fiberId", "flux_g"), [], "flux_g", "normalized", divide=True).drop("flux_g")


@case("narrow_j", "P16 P17", "quartz filters fibers", f"WITH {FLUX} SELECT visit, fiberId, design_mag_y - (-0.172811 + 0.362018 * (design_mag_g - design_mag_r) + 0.00223607 * (design_mag_g - design_mag_r) * (design_mag_g - design_mag_r)) AS nJ, design_mag_y + 0.08 AS fakeJ FROM ft", "nJ fakeJ")
def _(v):
    rows = X.with_fake_j(flux_table(v))
    return rows.select("visit", "fiberId", S.narrow_j("design_mag_g", "design_mag_r", "design_mag_y").alias("nJ"), F.col("design_mag_nJ").alias("fakeJ"))


COEF = {
    "gri": ("-12.74432612", "5.72884386", "1.35199207", "0.12986592"),
    "riz": ("73.19247901", "-5.73469827", "1.42925779", "0.09580749"),
    "izy": ("88.5481888", "-6.46929173", "1.10589459", "0.000633426991"),
}


def locus(a: str, b: str, c: str, name: str) -> str:
    k = [f"({x}::DOUBLE)" for x in COEF[name]]
    x = f"(({b}) - ({c}))"
    return f"(({a}) - ({b})) - ((({k[0]} * {x} + {k[1]}) * {x} + {k[2]}) * {x} + {k[3]})"


LOCUS = "loc AS (SELECT visit, fiberId, " + ", ".join(
    f"{locus(*[f'design_mag_{b}' for b in n], n)} AS ref_{n}, {locus(*[f'(diff_{b} + design_mag_{b})' for b in n], n)} AS obs_{n}" for n in COEF
) + " FROM ft)"
LOCUS_NAMES = [f"{k}_{n}" for n in COEF for k in ("ref", "obs")]


@case("locus_residuals", "P18", "quartz filters fibers", f"WITH {FLUX}, {LOCUS} SELECT visit, fiberId, {', '.join(f'{n} / 1000 AS {n}' for n in LOCUS_NAMES)} FROM loc", " ".join(LOCUS_NAMES))
def _(v):
    cols = []
    for n in COEF:
        cols.append((S.locus_residual(*[F.col(f"design_mag_{b}") for b in n], n) / 1000).alias(f"ref_{n}"))
        cols.append((S.locus_residual(*[F.col(f"diff_{b}") + F.col(f"design_mag_{b}") for b in n], n) / 1000).alias(f"obs_{n}"))
    return flux_table(v).select("visit", "fiberId", *cols)


def sigma_sql(column: str, scale: str = "1.35") -> str:
    return f"(quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) / {scale}"


@case("locus_scatter", "Q9 G26", "quartz filters fibers", f"WITH {FLUX}, {LOCUS} SELECT visit, {', '.join(f'{sigma_sql(n)} AS sigma_{n}' for n in LOCUS_NAMES)} FROM loc GROUP BY visit", " ".join(f"sigma_{n}" for n in LOCUS_NAMES))
def _(v):
    return X.locus_scatter(flux_table(v))


SN = """sn AS (SELECT visit, fiberId, median(CASE WHEN wavelength > 840 AND wavelength < 875 AND mask = 0 AND covar0 > 0 THEN flux / sqrt(covar0) END) AS SN FROM quartz GROUP BY ALL)"""


@case("fiber_sn", "Q9 G22 F8 F13", "quartz", f"WITH {SN} SELECT * FROM sn", "SN")
def _(v):
    return X.fiber_sn(v.quartz)


@case("low_sn_standards", "Q9 F16", "quartz", f"WITH {SN} SELECT visit, fiberId, SN / 14 AS SN FROM sn WHERE SN / 14 < 10", "SN")
def _(v):
    return X.low_sn(X.fiber_sn(v.quartz).withColumn("SN", F.col("SN") / 14))


@case("best_star", "Q9 W9", "quartz", f"WITH {SN} SELECT visit, fiberId, SN FROM sn QUALIFY row_number() OVER (PARTITION BY visit ORDER BY SN DESC NULLS LAST, fiberId) = 1", "SN")
def _(v):
    return X.best_star(X.fiber_sn(v.quartz))


@case("sn_scatter", "Q9 G20", "quartz", f"WITH {SN} SELECT visit, median(SN) AS mergedSNMedian, {sigma_sql('SN')} AS mergedSNSigma FROM sn GROUP BY visit", "mergedSNMedian mergedSNSigma")
def _(v):
    return X.scatter(X.fiber_sn(v.quartz), ["visit"], "SN", "mergedSN")


@case(
    "vector_percentiles", "Q9 G24 P28", "quartz",
    "WITH p AS (SELECT visit, wavelength, quantile_cont(flux - 20500, 0.16) AS a, median(flux - 20500) AS b, quantile_cont(flux - 20500, 0.84) AS c FROM quartz GROUP BY ALL) SELECT visit, wavelength, CASE WHEN a > 0 THEN log10(a) END AS log16, CASE WHEN b > 0 THEN log10(b) END AS log50, CASE WHEN c > 0 THEN log10(c) END AS log84 FROM p",
    "wavelength log16 log50 log84",
)
def _(v):
    return X.vector_percentiles(v.quartz.withColumn("value", F.col("flux") - 20500))


@case(
    "vector_color", "Q9 G25 A8", "quartz",
    """WITH r AS (SELECT visit, fiberId, max(flux) FILTER (WHERE wavelength = 500) / nullif(max(flux) FILTER (WHERE wavelength = 672), 0) AS ratio FROM quartz WHERE wavelength IN (500, 672) GROUP BY ALL)
    SELECT *, ratio / nullif(median(ratio) OVER (PARTITION BY visit), 0) AS normalized FROM r""",
    "ratio normalized",
)
def _(v):
    return X.vector_color(v.quartz.withColumn("value", F.col("flux")), (500.0, 672.0))


PLANE = "pl AS (SELECT visit, fiberId, max(flux) AS value FROM quartz WHERE arm = 'b' AND pix = 34 GROUP BY ALL), nm AS (SELECT *, value / median(value) OVER (PARTITION BY visit) AS normalized FROM pl)"


def plane(v):
    return X.plane_norm(v.quartz.where("arm = 'b' AND pix = 34").groupBy("visit", "fiberId").agg(F.max("flux").alias("value")), ["visit"], "value")


@case("plane_norm", "Q9 G41 G21", "quartz", f"WITH {PLANE} SELECT * FROM nm", "value normalized")
def _(v):
    return plane(v)[0]


@case("plane_norm_scatter", "Q9 G41", "quartz", f"WITH {PLANE} SELECT visit, median(normalized) AS normMedian, {sigma_sql('normalized')} AS normSigma, {sigma_sql('normalized')} * 100 AS scatterPercent FROM nm GROUP BY visit", "normMedian normSigma scatterPercent")
def _(v):
    return plane(v)[1]


# The same over the whole view: each pixel of each arm is a plane of its own.
PLANES = "pl AS (SELECT visit, arm, pix, fiberId, max(flux) AS value FROM quartz GROUP BY ALL), nm AS (SELECT *, value / median(value) OVER (PARTITION BY visit, arm, pix) AS normalized FROM pl)"


def planes(v):
    keys = ["visit", "arm", "pix"]
    return X.plane_norm(v.quartz.groupBy(*keys, "fiberId").agg(F.max("flux").alias("value")), keys, "value")


@case("plane_norm_all", "Q9 G41 G21", "quartz", f"WITH {PLANES} SELECT * FROM nm", "value normalized")
def _(v):
    return planes(v)[0]


@case("plane_norm_scatter_all", "Q9 G41", "quartz", f"WITH {PLANES} SELECT visit, arm, pix, median(normalized) AS normMedian, {sigma_sql('normalized')} AS normSigma, {sigma_sql('normalized')} * 100 AS scatterPercent FROM nm GROUP BY ALL", "normMedian normSigma scatterPercent")
def _(v):
    return planes(v)[1]


@case(
    "scaled_spectrum", "Q9 P20 P17", "quartz fibers",
    f"""WITH g AS (SELECT *, median(flux) OVER (PARTITION BY visit, fiberId) AS fluxMedian FROM quartz WHERE mask = 0),
    m AS (SELECT fiberId, flux_g, {mag('flux_g')} AS mg, {mag('flux_r')} AS mr, {mag('flux_y')} AS my FROM fibers),
    n AS (SELECT *, my - (-0.172811 + 0.362018 * (mg - mr) + 0.00223607 * (mg - mr) * (mg - mr)) AS mj FROM m)
    SELECT visit, arm, fiberId, pix, fluxMedian, flux / fluxMedian AS scaled, flux_g / fluxMedian AS scaled_g, pow(10, -0.4 * (mj - 31.4::DOUBLE)) / fluxMedian AS "scaled_nJ" FROM g JOIN n USING (fiberId)""",
    "fluxMedian scaled scaled_g scaled_nJ",
)
def _(v):
    return X.scaled_spectrum(v.quartz, fluxes=v.fibers).select("visit", "arm", "fiberId", "pix", "fluxMedian", "scaled", "scaled_g", "scaled_nJ")


SETS = """nf AS (SELECT CAST(fiberId // 10 AS INT) AS visit, fiberId, targetType, CASE fiberId // 10 % 4 WHEN 0 THEN ['g_ps1', 'r_ps1', 'i_ps1', 'z_ps1', 'y_ps1'] WHEN 1 THEN ['bp_gaia', 'rp_gaia', 'g_gaia'] WHEN 2 THEN ['i_ps1', 'g_ps1'] ELSE ['g_hsc'] END AS names FROM fibers),
  fs AS (SELECT visit, arg_min(names, fiberId) AS names FROM nf WHERE targetType = 'FLUXSTD' GROUP BY visit)"""


@case(
    "filter_choice", "Q9 P32", "fibers",
    f"""WITH {SETS} SELECT visit, CASE visit % 4 WHEN 1 THEN 'Gaia' WHEN 3 THEN NULL ELSE 'PS1' END AS system, CASE visit % 4 WHEN 1 THEN 'g_gaia' WHEN 3 THEN NULL ELSE 'i_ps1' END AS fluxFilter,
    CASE visit % 4 WHEN 0 THEN 'g_ps1' WHEN 1 THEN 'bp_gaia' WHEN 2 THEN 'i_ps1' END AS colorFilter1, CASE visit % 4 WHEN 0 THEN 'i_ps1' WHEN 1 THEN 'rp_gaia' WHEN 2 THEN 'i_ps1' END AS colorFilter2, visit % 4 = 2 AS noColor FROM fs""",
)
def _(v):
    def names(*n):
        return F.array(*[F.lit(x) for x in n])

    visit = F.floor(F.col("fiberId") / 10).cast("int")
    sets = (
        F.when(visit % 4 == 0, names("g_ps1", "r_ps1", "i_ps1", "z_ps1", "y_ps1"))
        .when(visit % 4 == 1, names("bp_gaia", "rp_gaia", "g_gaia"))
        .when(visit % 4 == 2, names("i_ps1", "g_ps1"))
        .otherwise(names("g_hsc"))
    )
    return P.choose_filters(v.fibers.withColumns({"visit": visit, "filterNames": sets}))


@case(
    "visit_fiber_table", "Q9 S11 G21", "quartz filters fibers",
    f"""WITH {FLUX}, {SN} SELECT visit, fiberId, diff_i AS mag, diff_g - diff_i AS color, design_mag_i AS mag_cat, diff_i - median(diff_i) OVER w AS "magCentered", diff_g - diff_i - median(diff_g - diff_i) OVER w AS "colorCentered", SN AS "SNR"
    FROM ft LEFT JOIN sn USING (visit, fiberId) WINDOW w AS (PARTITION BY visit)""",
    "mag color mag_cat magCentered colorCentered SNR",
)
def _(v):
    return X.visit_fibers(flux_table(v), X.fiber_sn(v.quartz))


RESULT_DOUBLES = (
    "transparencyMedian transparencySigma seeingMedian seeingSigma mergedMedian mergedSigma mergedSNMedian mergedSNSigma imagMedian imagSigma "
    "mergedColorMedian mergedColorSigma singleMedian singleSigma singleColorMedian singleColorSigma stellarSequenceSigmaGRI stellarSequenceSigmaRIZ stellarSequenceSigmaIZY"
)


@case(
    "visit_results", "Q9 G27 G20", "quartz filters fibers seeing transparency",
    f"""WITH {FLUX}, {LOCUS}, {SN}, gs AS (SELECT * FROM seeing JOIN transparency USING (agc_exposure_id)),
    g AS (SELECT visit, median(transparency_median) AS "transparencyMedian", {sigma_sql('transparency_median', '1.349')} AS "transparencySigma", median(seeing_median) AS "seeingMedian", {sigma_sql('seeing_median', '1.349')} AS "seeingSigma" FROM gs GROUP BY visit),
    m AS (SELECT visit, median(diff_i) AS "mergedMedian", {sigma_sql('diff_i')} AS "mergedSigma", median(design_mag_i) AS "imagMedian", {sigma_sql('design_mag_i')} AS "imagSigma", median(diff_g - diff_i) AS "mergedColorMedian", {sigma_sql('(diff_g - diff_i)')} AS "mergedColorSigma",
      median(diff_i) AS "singleMedian", {sigma_sql('diff_i')} AS "singleSigma", median(diff_g - diff_i) AS "singleColorMedian", {sigma_sql('(diff_g - diff_i)')} AS "singleColorSigma" FROM ft GROUP BY visit),
    s AS (SELECT visit, median(SN) AS "mergedSNMedian", {sigma_sql('SN')} AS "mergedSNSigma" FROM sn GROUP BY visit),
    l AS (SELECT visit, {sigma_sql('obs_gri')} AS "stellarSequenceSigmaGRI", {sigma_sql('obs_riz')} AS "stellarSequenceSigmaRIZ", {sigma_sql('obs_izy')} AS "stellarSequenceSigmaIZY" FROM loc GROUP BY visit)
    SELECT *, '1.0' AS version, 'tables' AS collection, 'i' AS "mergedFilter", 'g-i' AS "mergedColorFilters" FROM g FULL JOIN m USING (visit) FULL JOIN s USING (visit) FULL JOIN l USING (visit)""",
    RESULT_DOUBLES,
)
def _(v):
    table = flux_table(v)
    guide = v.seeing.join(v.transparency, "agc_exposure_id")
    return X.visit_results(table, table, X.fiber_sn(v.quartz), guide, "1.0", "tables")


# The merged path: accepted standards, listed mask planes, counts over norm and exposure time.
PLANES_OF_MERGED = {"BAD": 0, "SAT": 1, "CR": 3, "NO_DATA": 8, "REFLINE": 14}
ACCEPTED = "targetType = 'FLUXSTD' AND fiberStatus = 'GOOD' AND sqrt(pow(xNominal - xFocal, 2) + pow(yNominal - yFocal, 2)) <= 0.05"
MERGED = f"""mp AS (SELECT visit, fiberId, pix, wavelength, flux AS counts, covar0, flux / norm / exptime AS flux FROM merged JOIN shots USING (visit) WHERE mask & 267 = 0 AND fiberId IN (SELECT fiberId FROM fibers WHERE {ACCEPTED}))"""
MERGED_SN = """sn AS (SELECT visit, fiberId, median(CASE WHEN wavelength > 840 AND wavelength < 875 AND covar0 > 0 THEN counts / sqrt(covar0) END) AS SN FROM mp GROUP BY ALL)"""
MERGED_VIEWS = "merged shots fibers"


def pixels(v):
    return X.merged_pixels(v.merged, fibers(v), v.shots, PLANES_OF_MERGED)


@case("merged_pixels", "Q9 F6 F13", MERGED_VIEWS, f"WITH {MERGED} SELECT * FROM mp", "wavelength counts covar0 flux")
def _(v):
    return pixels(v).select("visit", "fiberId", "pix", "wavelength", "counts", "covar0", "flux")


@case("merged_flux_table", "Q9 P13 P14", f"{MERGED_VIEWS} filters", f"WITH {MERGED}, {flux_sql('true', 'mp', ACCEPTED)} SELECT * FROM ft", FT_DOUBLES)
def _(v):
    return X.flux_table(X.standards(fibers(v)), pixels(v), v.filters).withColumnRenamed("dec", "decl")


@case("merged_sn", "Q9 G22", MERGED_VIEWS, f"WITH {MERGED}, {MERGED_SN} SELECT * FROM sn", "SN")
def _(v):
    return X.merged_sn(pixels(v))


@case("low_sn_accepted", "Q9 F16", MERGED_VIEWS, f"WITH {MERGED}, {MERGED_SN} SELECT * FROM sn WHERE SN < 10", "SN")
def _(v):
    return X.low_sn(X.merged_sn(pixels(v)))


@case("best_accepted", "Q9 W9", MERGED_VIEWS, f"WITH {MERGED}, {MERGED_SN} SELECT * FROM sn QUALIFY row_number() OVER (PARTITION BY visit ORDER BY SN DESC NULLS LAST, fiberId) = 1", "SN")
def _(v):
    return X.best_star(X.merged_sn(pixels(v)))


@case("accepted_sn_scatter", "Q9 G20", MERGED_VIEWS, f"WITH {MERGED}, {MERGED_SN} SELECT visit, median(SN) AS mergedSNMedian, {sigma_sql('SN')} AS mergedSNSigma FROM sn GROUP BY visit", "mergedSNMedian mergedSNSigma")
def _(v):
    return X.scatter(X.merged_sn(pixels(v)), ["visit"], "SN", "mergedSN")


def table_sql(name: str, where: str, source: str) -> str:
    """CTE of a flux table of the accepted standards, with its steps inside."""
    return f"{name} AS (WITH {flux_sql(where, source, ACCEPTED)} SELECT * FROM ft)"


@case(
    "visit_record", "Q9 G27 F16 G20", f"{MERGED_VIEWS} quartz filters seeing transparency",
    f"""WITH {MERGED}, {MERGED_SN}, {table_sql('mt', 'true', 'mp')}, {table_sql('ft', 'mask = 0', 'quartz')}, {LOCUS}, gs AS (SELECT * FROM seeing JOIN transparency USING (agc_exposure_id)),
    g AS (SELECT visit, median(transparency_median) AS "transparencyMedian", {sigma_sql('transparency_median', '1.349')} AS "transparencySigma", median(seeing_median) AS "seeingMedian", {sigma_sql('seeing_median', '1.349')} AS "seeingSigma" FROM gs GROUP BY visit),
    m AS (SELECT visit, median(diff_i) AS "mergedMedian", {sigma_sql('diff_i')} AS "mergedSigma", median(design_mag_i) AS "imagMedian", {sigma_sql('design_mag_i')} AS "imagSigma", median(diff_g - diff_i) AS "mergedColorMedian", {sigma_sql('(diff_g - diff_i)')} AS "mergedColorSigma" FROM mt GROUP BY visit),
    i AS (SELECT visit, median(diff_i) AS "singleMedian", {sigma_sql('diff_i')} AS "singleSigma", median(diff_g - diff_i) AS "singleColorMedian", {sigma_sql('(diff_g - diff_i)')} AS "singleColorSigma" FROM ft GROUP BY visit),
    s AS (SELECT visit, median(SN) AS "mergedSNMedian", {sigma_sql('SN')} AS "mergedSNSigma" FROM sn GROUP BY visit),
    l AS (SELECT visit, {sigma_sql('obs_gri')} AS "stellarSequenceSigmaGRI", {sigma_sql('obs_riz')} AS "stellarSequenceSigmaRIZ", {sigma_sql('obs_izy')} AS "stellarSequenceSigmaIZY" FROM loc GROUP BY visit)
    SELECT *, '1.0' AS version, 'tables' AS collection, 'i' AS "mergedFilter", 'g-i' AS "mergedColorFilters" FROM g FULL JOIN m USING (visit) FULL JOIN i USING (visit) FULL JOIN s USING (visit) FULL JOIN l USING (visit)""",
    RESULT_DOUBLES,
)
def _(v):
    guide = v.seeing.join(v.transparency, "agc_exposure_id")
    return X.visit_record(v.merged, v.quartz, v.shots, fibers(v), v.filters, guide, PLANES_OF_MERGED, "1.0", "tables")


@case("band_scatter", "G20 G3", "fibers", f"SELECT targetType, median(flux_g) AS median, {sigma_sql('flux_g', '1.349')} AS sigma, 0.741 * (quantile_cont(flux_r, 0.75) - quantile_cont(flux_r, 0.25)) AS robust FROM fibers GROUP BY ALL", "median sigma robust")
def _(v):
    q = {"a": ("flux_g", 0.25), "median": ("flux_g", 0.5), "b": ("flux_g", 0.75), "c": ("flux_r", 0.25), "d": ("flux_r", 0.75)}
    out = group_stats(v.fibers, ["targetType"], quantiles=q)
    sigma = ((F.col("b") - F.col("a")) / T.IQR_PER_SIGMA).alias("sigma")
    return out.select("targetType", "median", sigma, ((F.col("d") - F.col("c")) * T.IQR_ROBUST).alias("robust"))
