"""Queries on detector pixels: extraction statistics, image summaries and their maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.plans import extraction as E

from .registry import case

DS = ["visit", "arm", "spectrograph"]
DS_SQL = "visit, arm, spectrograph"
PIX = """pix AS (SELECT *, image - model AS residual, (image - model) / sqrt(variance) AS chi, (image - model) / nullif(model, 0) AS frac_model, (image - model) / nullif(image, 0) AS frac_image FROM pixels)"""
RESFRAC = f"""byrow AS (SELECT {DS_SQL}, fiberId, y, sum(CASE WHEN mask = 0 THEN residual END) / nullif(sum(CASE WHEN mask = 0 THEN image END), 0) AS r FROM pix GROUP BY ALL),
  resfrac AS (SELECT {DS_SQL}, fiberId, median(r) * 100 AS resFrac FROM byrow GROUP BY ALL)"""
STATS = f"""{PIX}, {RESFRAC}, fstat AS (SELECT {DS_SQL}, fiberId, avg(x) AS xa, avg(chi * chi) FILTER (WHERE mask = 0) AS chiSquare, avg(image) FILTER (WHERE mask = 0) AS imAve,
  avg(chi) FILTER (WHERE mask = 0) AS chiAve, avg(chi) FILTER (WHERE mask = 0 AND dx = 0) AS chiAtPeak, median(chi) FILTER (WHERE mask = 0) AS chiMed,
  (quantile_cont(chi, 0.75) FILTER (WHERE mask = 0) - quantile_cont(chi, 0.25) FILTER (WHERE mask = 0)) / 1.349 AS chiStd FROM pix GROUP BY {DS_SQL}, fiberId),
  stat AS (SELECT fstat.*, resFrac FROM fstat JOIN resfrac USING ({DS_SQL}, fiberId))"""
STAT_DOUBLES = "xa chiSquare imAve chiAve chiAtPeak chiMed chiStd resFrac"


@case("image_residuals", "P11", "pixels", f"WITH {PIX} SELECT visit, fiberId, x, y, residual, chi, frac_model, frac_image FROM pix", "residual chi frac_model frac_image")
def _(v):
    return E.image_residuals(v.pixels).select("visit", "fiberId", "x", "y", "residual", "chi", "frac_model", "frac_image")


@case("extraction_stats", "Q4 G14", "pixels", f"WITH {STATS} SELECT * FROM stat", STAT_DOUBLES)
def _(v):
    return E.extraction_stats(v.pixels)


@case("residual_fraction", "Q4 G15", "pixels", f"WITH {PIX}, {RESFRAC} SELECT * FROM resfrac", "resFrac")
def _(v):
    return E.residual_fraction(v.pixels)


@case("chi_by_row", "Q4 G16", "pixels", f"WITH {PIX} SELECT {DS_SQL}, fiberId, y, avg(chi) FILTER (WHERE mask = 0) AS chiAve FROM pix GROUP BY ALL", "chiAve")
def _(v):
    return E.chi_by_row(v.pixels)


@case(
    "trace_window", "Q4 A7", "detector traces",
    """WITH w AS (SELECT spectrograph, fiberId, y, xCenter, d AS dx, CAST(round_even(xCenter, 0) AS INT) + d AS x FROM traces CROSS JOIN (SELECT CAST(unnest(range(-3, 4)) AS INT) AS d) AS o)
    SELECT w.*, image, variance, mask, detector.x IS NOT NULL AS inImage FROM w LEFT JOIN detector USING (spectrograph, x, y)""".replace(", mask,", ", CAST(mask AS DOUBLE) AS mask,"),
    "xCenter image variance mask",
)
def _(v):
    out = E.trace_window(v.traces, v.detector, ["spectrograph"])
    return out.withColumn("mask", F.col("mask").cast("double"))


WINDOWED = """w AS (SELECT spectrograph, fiberId, y, d AS dx, CAST(round_even(xCenter, 0) AS INT) + d AS x FROM traces CROSS JOIN (SELECT CAST(unnest(range(-3, 4)) AS INT) AS d) AS o),
  pix AS (SELECT w.*, image, image * 0.99::DOUBLE AS model, variance, mask, detector.x IS NOT NULL AS ok FROM w LEFT JOIN detector USING (spectrograph, x, y)),
  c AS (SELECT *, image - model AS residual, (image - model) / sqrt(variance) AS chi FROM pix)"""


@case(
    "window_stats", "Q4 A7 G14", "detector traces",
    f"""WITH {WINDOWED}, z AS (SELECT spectrograph, fiberId, y, dx, x, image AS i0, chi AS c0, mask, ok, CASE WHEN ok AND mask = 0 THEN chi WHEN NOT ok THEN 0 END AS chi,
      CASE WHEN ok AND mask = 0 THEN residual WHEN NOT ok THEN 0 END AS residual, CASE WHEN ok AND mask = 0 THEN image WHEN NOT ok THEN 0 END AS image FROM c),
    byrow AS (SELECT spectrograph, fiberId, y, sum(residual) / nullif(sum(image), 0) AS r FROM z GROUP BY ALL), rf AS (SELECT spectrograph, fiberId, median(r) * 100 AS resFrac FROM byrow GROUP BY ALL)
    SELECT z.spectrograph, z.fiberId, avg(x) AS xa, avg(c0 * c0) FILTER (WHERE ok AND mask = 0) AS chiSquare, avg(i0) FILTER (WHERE ok AND mask = 0) AS imAve, avg(chi) AS chiAve, avg(chi) FILTER (WHERE dx = 0) AS chiAtPeak,
      median(chi) AS chiMed, (quantile_cont(chi, 0.75) - quantile_cont(chi, 0.25)) / 1.349 AS chiStd, any_value(resFrac) AS resFrac FROM z JOIN rf USING (spectrograph, fiberId) GROUP BY z.spectrograph, z.fiberId""",
    STAT_DOUBLES,
)
def _(v):
    image = v.detector.withColumn("model", F.col("image") * 0.99)
    window = E.trace_window(v.traces, image, ["spectrograph"])
    return E.extraction_stats(window, ["spectrograph"], include_edge_zeros=True)


@case(
    "fiber_window_stats", "Q4 A7 G14", "detector traces spectra fibers",
    f"""WITH good AS (SELECT spectrograph, fiberId, targetType FROM fibers WHERE fiberStatus = 'GOOD' AND targetType <> 'ENGINEERING'),
    {WINDOWED}, z AS (SELECT spectrograph, fiberId, y, dx, image AS i0, chi AS c0, mask, ok, CASE WHEN ok AND mask = 0 THEN chi WHEN NOT ok THEN 0 END AS chi,
      CASE WHEN ok AND mask = 0 THEN residual WHEN NOT ok THEN 0 END AS residual, CASE WHEN ok AND mask = 0 THEN image WHEN NOT ok THEN 0 END AS image FROM c JOIN good USING (spectrograph, fiberId)),
    byrow AS (SELECT spectrograph, fiberId, y, sum(residual) / nullif(sum(image), 0) AS r FROM z GROUP BY ALL), rf AS (SELECT spectrograph, fiberId, median(r) * 100 AS resFrac FROM byrow GROUP BY ALL),
    centers AS (SELECT spectrograph, fiberId, avg(xCenter) AS xa FROM traces GROUP BY ALL), flux AS (SELECT spectrograph, fiberId, avg(flux) AS pfsArmAve FROM spectra GROUP BY ALL),
    st AS (SELECT spectrograph, fiberId, avg(c0 * c0) FILTER (WHERE ok AND mask = 0) AS chiSquare, avg(i0) FILTER (WHERE ok AND mask = 0) AS imAve, avg(chi) AS chiAve, avg(chi) FILTER (WHERE dx = 0) AS chiAtPeak,
      median(chi) AS chiMed, (quantile_cont(chi, 0.75) - quantile_cont(chi, 0.25)) / 1.349 AS chiStd FROM z GROUP BY spectrograph, fiberId)
    SELECT st.*, resFrac, xa, pfsArmAve * pi() AS pfsArmAve, targetType FROM st JOIN rf USING (spectrograph, fiberId) JOIN centers USING (spectrograph, fiberId) JOIN good USING (spectrograph, fiberId) LEFT JOIN flux USING (spectrograph, fiberId)""",
    STAT_DOUBLES + " pfsArmAve",
)
def _(v):
    image = v.detector.withColumn("model", F.col("image") * 0.99)
    out = E.fiber_window_stats(v.traces, image, v.spectra, v.fibers, ["spectrograph"])
    # Means of values with two decimals can end exactly between two rounded values, which the engines
    # round differently; an irrational factor on both sides leaves no such ties.
    return out.withColumn("pfsArmAve", F.col("pfsArmAve") * F.pi())


PLANES = "image model residual variance chi frac_model frac_image".split()


@case(
    "image_summary", "Q5 G17", "pixels",
    f"""WITH {PIX}, p AS (SELECT {DS_SQL}, plane, v FROM (UNPIVOT (SELECT {DS_SQL}, {', '.join(PLANES)} FROM pix) ON {', '.join(PLANES)} INTO NAME plane VALUE v))
    SELECT {DS_SQL}, plane, avg(v) AS mean, median(v) AS median, quantile_cont(v, 0.01) AS q01, quantile_cont(v, 0.05) AS q05, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.75) AS q75,
    quantile_cont(v, 0.95) AS q95, quantile_cont(v, 0.99) AS q99, round(0.741 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)), 7) AS sigma FROM p GROUP BY ALL""",
    "mean median q01 q05 q25 q75 q95 q99 sigma",
)
def _(v):
    # Prices have few decimals, so sigma can end exactly between two rounded values.
    return E.image_summary(v.pixels).withColumn("sigma", F.round("sigma", 7))


@case(
    "cutouts", "Q5 F14", "pixels",
    """WITH c AS (SELECT x, y FROM (VALUES (500), (2000), (3500)) AS a(x) CROSS JOIN (VALUES (500), (2000), (3500)) AS b(y)), p AS (SELECT visit, fiberId, x, y * 37 + 400 AS y, image FROM pixels)
    SELECT visit, fiberId, p.x, p.y, image, c.x AS xCut, c.y AS yCut FROM p JOIN c ON p.x >= c.x - 75 AND p.x < c.x + 75 AND p.y >= c.y - 75 AND p.y < c.y + 75""",
    "image",
)
def _(v):
    placed = v.pixels.select("visit", "fiberId", "x", (F.col("y") * 37 + 400).alias("y"), "image")
    return E.cutouts(placed)


HIST = f"""lim AS (SELECT {DS_SQL}, quantile_cont(v, LOW) * 1.5 AS lo, quantile_cont(v, HIGH) * 1.5 AS hi FROM src GROUP BY {DS_SQL}),
  counted AS (SELECT {DS_SQL}, CAST(least(floor((v - lo) / (hi - lo) * 50), 49) AS INT) AS bin, count(*) AS n FROM src JOIN lim USING ({DS_SQL}) WHERE v >= lo AND v <= hi GROUP BY ALL),
  hist AS (SELECT {DS_SQL}, e.bin, lo + e.bin * ((hi - lo) / 50) AS "left", lo + (e.bin + 1) * ((hi - lo) / 50) AS "right", coalesce(n, 0) AS count
    FROM (SELECT *, CAST(unnest(range(50)) AS INT) AS bin FROM lim) AS e LEFT JOIN counted USING ({DS_SQL}, bin))"""


def hist_sql(column, low, high):
    return f"{PIX}, src AS (SELECT {DS_SQL}, {column} AS v FROM pix), " + HIST.replace("LOW", low).replace("HIGH", high)


@case("fraction_histogram", "Q5 A5 A6", "pixels", f"WITH {hist_sql('frac_model', '0.05', '0.95')} SELECT * FROM hist", "left right")
def _(v):
    return E.image_histogram(v.pixels, "frac_model", 0.05, 0.95)


@case(
    "chi_histogram_with_normal", "Q5 A5 A6 A11", "pixels",
    f"""WITH {hist_sql('chi', '0.01', '0.99')} SELECT *, exp(-0.5 * ((("left" + "right") / 2) * (("left" + "right") / 2))) * max(count) OVER (PARTITION BY {DS_SQL}) AS normal FROM hist""",
    "left right normal",
)
def _(v):
    return E.image_histogram(v.pixels, "chi", 0.01, 0.99, normal=True)


@case(
    "histogram_peak", "A6", "pixels",
    f"""WITH {hist_sql('chi', '0.01', '0.99')} SELECT {DS_SQL}, bin, "left", "right", count FROM (SELECT *, row_number() OVER (PARTITION BY {DS_SQL} ORDER BY count DESC, bin) AS k FROM hist) AS h WHERE k = 1""",
    "left right",
)
def _(v):
    return E.peak_bin(E.image_histogram(v.pixels, "chi", 0.01, 0.99), DS)


@case(
    "histogram_limits", "A6", "pixels",
    f"WITH {PIX} SELECT {DS_SQL}, quantile_cont(chi, 0.01) * 1.5 AS lo, quantile_cont(chi, 0.99) * 1.5 AS hi FROM pix GROUP BY ALL", "lo hi",
)
def _(v):
    return E.hist_limits(E.image_residuals(v.pixels), DS, "chi", 0.01, 0.99)


@case(
    "color_range", "Q6 G18", "pixels",
    f"WITH {STATS} SELECT visit, arm, quantile_cont(imAve, 0.01) AS vmin, quantile_cont(imAve, 0.99) AS vmax FROM stat GROUP BY ALL", "vmin vmax",
)
def _(v):
    return E.color_range(E.extraction_stats(v.pixels), ["visit", "arm"], "imAve")


@case(
    "extraction_map", "Q6 J6 P23 U1", "pixels fibers",
    f"""WITH {STATS} SELECT visit, arm, fiberId, xFocal, yFocal, chiMed, CASE WHEN chiMed < -5 THEN 'under' WHEN chiMed > 5 THEN 'over' WHEN chiMed IS NOT NULL THEN 'inside' END AS rangeClass,
    least(greatest(chiMed, -5), 5) AS shown FROM stat JOIN (SELECT fiberId, xFocal, yFocal FROM fibers) AS f USING (fiberId)""",
    "xFocal yFocal chiMed shown",
)
def _(v):
    out = E.on_focal_plane(E.extraction_stats(v.pixels), v.fibers, "chiMed", -5.0, 5.0)
    return out.select("visit", "arm", "fiberId", "xFocal", "yFocal", "chiMed", "rangeClass", "shown")


PROFILE_HISTOGRAMS = """WITH l AS (SELECT arm, spectrograph, measure, value FROM (UNPIVOT (SELECT * EXCLUDE (fiberId) FROM profiles) ON centroid, "min", "max", r90, skew, variation, width, wingFrac INTO NAME measure VALUE value)),
    b AS (SELECT *, CASE measure WHEN 'variation' THEN 0::DOUBLE WHEN 'max' THEN 0.1::DOUBLE ELSE min(value) OVER w END AS lo, CASE measure WHEN 'variation' THEN 0.03::DOUBLE WHEN 'max' THEN 0.5::DOUBLE ELSE CASE WHEN max(value) OVER w > min(value) OVER w THEN max(value) OVER w ELSE min(value) OVER w + 1 END END AS hi FROM l WINDOW w AS (PARTITION BY arm, spectrograph, measure)),
    c AS (SELECT arm, spectrograph, measure, CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INT) AS bin, count(*) AS n FROM b WHERE value >= lo AND value <= hi GROUP BY ALL),
    e AS (SELECT DISTINCT arm, spectrograph, measure, lo, hi FROM b), g AS (SELECT *, CAST(unnest(range(30)) AS INT) AS bin FROM e)
    SELECT arm, spectrograph, measure, bin, lo + bin * ((hi - lo) / 30) AS "left", lo + (bin + 1) * ((hi - lo) / 30) AS "right", coalesce(n, 0) AS count FROM g LEFT JOIN c USING (arm, spectrograph, measure, bin)"""


@case("profile_histograms", "Q13 A10", "profiles", PROFILE_HISTOGRAMS, "left right")
def _(v):
    from fiberqa.plans.profiles import profile_histograms

    return profile_histograms(v.profiles)


@case("profile_histograms_all", "Q13 A10", "all_profiles", PROFILE_HISTOGRAMS.replace("FROM profiles", "FROM all_profiles"), "left right")
def _(v):
    from fiberqa.plans.profiles import profile_histograms

    return profile_histograms(v.all_profiles)
