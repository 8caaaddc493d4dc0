"""Queries on emission lines: selection, clipping, fit statistics and residual reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.functions import stats as T
from fiberqa.operators import lines as L
from fiberqa.operators.binning import step_bin
from fiberqa.operators.clipping import sigma_clip, soften_fit
from fiberqa.operators.ordering import group_stats
from fiberqa.operators.reshape import concat_tables, flatten, melt_status
from fiberqa.operators.windows import first_per_key
from fiberqa.plans import detmap as D
from fiberqa.sources.frames import cut

from .overlap import interp_sql
from .registry import case

DS = ["visit", "arm", "spectrograph"]
GROUP = [*DS, "status_type", "description"]
DS_SQL = "visit, arm, spectrograph"
GROUP_SQL = f"{DS_SQL}, status_type, description"

RES = """res AS (SELECT *, description = 'Trace' AS isTrace, description <> 'Trace' AS isLine, x - xModel AS xResid,
  CASE WHEN description <> 'Trace' THEN y - yModel END AS yResid, (status & 1) <> 0 AS isUsed, (status & 2) <> 0 AS isReserved,
  CASE WHEN (status & 1) <> 0 THEN 'USED' WHEN (status & 2) <> 0 THEN 'RESERVED' END AS status_type FROM lines)"""
SCRUB = f"{RES}, scrub AS (SELECT * FROM res WHERE NOT flag AND (isUsed OR isReserved) AND x IS NOT NULL AND y IS NOT NULL)"


def clip_sql(source: str, keys: str, columns: list[str], rounds: int = 5) -> str:
    """CTEs c0…: the unrolled clipping; the last one has the flags."""
    parts = [f"c0 AS (SELECT *, {', '.join(f'{c} AS k_{c}' for c in columns)} FROM {source})"]
    for i in range(rounds):
        new = ", ".join(
            f"CASE WHEN k_{c} >= median(k_{c}) OVER g - 3 * stddev_pop(k_{c}) OVER g "
            f"AND k_{c} <= median(k_{c}) OVER g + 3 * stddev_pop(k_{c}) OVER g THEN k_{c} END AS k_{c}"
            for c in columns
        )
        parts.append(f"c{i + 1} AS (SELECT * REPLACE ({new}) FROM c{i} WINDOW g AS (PARTITION BY {keys}))")
    flags = ", ".join(f"k_{c} IS NULL AS {c}Outlier" for c in columns)
    drop = ", ".join(f"k_{c}" for c in columns)
    parts.append(f"clipped AS (SELECT * EXCLUDE ({drop}), {flags} FROM c{rounds})")
    return ", ".join(parts)


CLIPPED = f"{SCRUB}, {clip_sql('scrub', GROUP_SQL, ['xResid', 'yResid'])}"
KEPT = (
    f"{CLIPPED}, kept AS (SELECT clipped.*, mtp_A FROM clipped JOIN (SELECT fiberId, mtp_A FROM fibers) AS f USING (fiberId) "
    "WHERE (isLine AND NOT yResidOutlier) OR (isTrace AND NOT xResidOutlier))"
)


def soften_sql(name: str, source: str, keys: str, r: str, e: str, where: str = "TRUE") -> str:
    return f"""{name}0 AS (SELECT {keys}, list({r} * {r}) FILTER (WHERE {where} AND {r} IS NOT NULL) AS rr, list({e} * {e}) FILTER (WHERE {where} AND {r} IS NOT NULL) AS ee,
    count({r}) FILTER (WHERE {where}) AS dof FROM {source} GROUP BY {keys}),
  {name}1 AS (SELECT *, 0 AS it, 0::DOUBLE AS a, 1::DOUBLE AS b FROM {name}0 UNION ALL
    SELECT {keys}, rr, ee, dof, it + 1, CASE WHEN f > 0 THEN m ELSE a END, CASE WHEN f > 0 THEN b ELSE m END FROM
    (SELECT *, (a + b) / 2 AS m, list_sum(list_transform(list_zip(rr, ee), lambda p: p[1] / (p[2] + ((a + b) / 2) * ((a + b) / 2)))) / dof - 1 AS f FROM {name}1 WHERE it < 45)),
  {name} AS (SELECT {keys}, CASE WHEN dof = 0 OR list_sum(list_transform(list_zip(rr, ee), lambda p: p[1] / p[2])) / dof - 1 <= 0 THEN 0::DOUBLE
    WHEN list_sum(list_transform(list_zip(rr, ee), lambda p: p[1] / (p[2] + 1))) / dof - 1 > 0 THEN NULL ELSE (a + b) / 2 END AS s FROM {name}1 WHERE it = 45)"""


STATS = f"""{KEPT}, srows AS (SELECT * FROM kept WHERE NOT xResidOutlier),
  {soften_sql('sx', 'srows', GROUP_SQL, 'xResid', 'xErr')}, {soften_sql('sy', 'srows', GROUP_SQL, 'yResid', 'yErr', 'isLine')},
  fstats AS (SELECT {GROUP_SQL}, count(*)::DOUBLE + count(yResid) FILTER (WHERE isLine) AS dof,
    sum(xResid * xResid / (xErr * xErr)) AS chi2X, coalesce(sum(yResid * yResid / (yErr * yErr)), 0) AS chi2Y,
    median(xResid) AS spatial_median, 0.741 * (quantile_cont(xResid, 0.75) - quantile_cont(xResid, 0.25)) AS spatial_robustRms,
    sqrt(sum(xResid * xResid / (xErr * xErr)) / sum(1 / (xErr * xErr))) AS spatial_weightedRms, count(*)::DOUBLE AS spatial_dof,
    count(DISTINCT CASE WHEN isTrace THEN fiberId END) AS spatial_num_fibers, count(DISTINCT CASE WHEN isTrace THEN fiberId END) AS spatial_num_lines,
    median(yResid) AS wavelength_median, 0.741 * (quantile_cont(yResid, 0.75) - quantile_cont(yResid, 0.25)) AS wavelength_robustRms,
    sqrt(sum(yResid * yResid / (yErr * yErr)) / sum(CASE WHEN yResid IS NOT NULL THEN 1 / (yErr * yErr) END)) AS wavelength_weightedRms, count(yResid)::DOUBLE AS wavelength_dof,
    count(DISTINCT CASE WHEN isLine THEN fiberId END) AS wavelength_num_fibers, count(DISTINCT CASE WHEN isLine THEN wavelength END) AS wavelength_num_lines
    FROM srows GROUP BY {GROUP_SQL}),
  stats AS (SELECT fstats.*, sx.s AS spatial_softenFit, sy.s AS wavelength_softenFit, concat(arm, spectrograph::VARCHAR) AS ccd, 'science' AS observationReason
    FROM fstats JOIN sx USING ({GROUP_SQL}) JOIN sy USING ({GROUP_SQL}))"""
STAT_DOUBLES = (
    "dof chi2X chi2Y spatial_median spatial_robustRms spatial_weightedRms spatial_softenFit spatial_dof "
    "wavelength_median wavelength_robustRms wavelength_weightedRms wavelength_softenFit wavelength_dof"
)


def bundles(v):
    return v.fibers.select("fiberId", "mtp_A")


def kept_rows(v):
    return D.residual_data(v.lines, bundles(v), is_science=True)


def flat_stats(v):
    stats = D.with_detector(D.fit_stats(kept_rows(v)), "science")
    return flatten(stats, ["spatial", "wavelength"])


# columns


@case("line_residuals", "P1 P7", "lines", f"WITH {RES} SELECT fiberId, wavelength, description, visit, arm, isTrace, isLine, xResid, yResid, flux FROM res", "wavelength xResid yResid flux")
def _(v):
    return D.residual_columns(v.lines).select("fiberId", "wavelength", "description", "visit", "arm", "isTrace", "isLine", "xResid", "yResid", "flux")


@case(
    "status_labels", "P2 P3 P4", "lines",
    f"""WITH {RES} SELECT status, status_type, isUsed, isReserved, (status & 6) <> 0 AS anyOther,
    CASE status WHEN 1 THEN 'USED' WHEN 2 THEN 'RESERVED' WHEN 3 THEN 'USED|RESERVED' ELSE 'OTHER' END AS status_name, count(*) AS n FROM res GROUP BY ALL""",
)
def _(v):
    names = {"USED": 1, "RESERVED": 2, "OTHER": 4}
    cols = D.residual_columns(v.lines).withColumns({"anyOther": S.has_any("status", 6), "status_name": S.status_name("status", names)})
    return cols.groupBy("status", "status_type", "isUsed", "isReserved", "anyOther", "status_name").agg(F.count(F.lit(1)).alias("n"))


@case(
    "detector_names", "P8", "lines",
    "SELECT concat(arm, spectrograph::VARCHAR) AS ccd, arm AS ccd_arm, spectrograph AS ccd_spectrograph, count(*) AS n FROM lines GROUP BY ALL",
)
def _(v):
    named = v.lines.select(S.ccd().alias("ccd"))
    return named.groupBy("ccd", S.ccd_arm("ccd").alias("ccd_arm"), S.ccd_spectrograph("ccd").alias("ccd_spectrograph")).agg(F.count(F.lit(1)).alias("n"))


@case(
    "rows_with_position", "P6 P30", "lines",
    f"WITH {RES} SELECT {DS_SQL}, count(*) AS n, sum(CASE WHEN yModel IS NOT NULL THEN 1 ELSE 0 END) AS with_model FROM res WHERE x IS NOT NULL AND yModel IS NOT NULL GROUP BY {DS_SQL}".replace("sum(CASE WHEN yModel IS NOT NULL THEN 1 ELSE 0 END)", "count(yModel)"),
)
def _(v):
    rows = v.lines.na.drop(how="all").na.drop(subset=["x", "yModel"])
    return rows.groupBy(*DS).agg(F.count(F.lit(1)).alias("n"), F.count("yModel").alias("with_model"))


# selection


@case(
    "scrubbed_lines", "F9 F10 P6", "lines",
    f"WITH {SCRUB} SELECT {DS_SQL}, status_type, count(*) AS n, count(yResid) AS with_y FROM scrub GROUP BY ALL",
)
def _(v):
    return D.scrub(v.lines).groupBy(*DS, "status_type").agg(F.count(F.lit(1)).alias("n"), F.count("yResid").alias("with_y"))


@case(
    "good_lines", "F1", "lines",
    f"SELECT {DS_SQL}, fiberId, wavelength, description, xErr FROM lines WHERE NOT flag AND description <> 'Trace' AND (status & 4) = 0",
    "wavelength xErr",
)
def _(v):
    return L.good_lines(v.lines, line_flags=4).select(*DS, "fiberId", "wavelength", "description", "xErr")


SN_CUT = f"""cut AS (SELECT {DS_SQL}, least(avg(flux / fluxErr) - stddev_pop(flux / fluxErr), 12.0) AS c FROM lines WHERE NOT flag GROUP BY {DS_SQL})"""


@case(
    "signal_to_noise_cut", "F2", "lines",
    f"WITH {SN_CUT} SELECT {DS_SQL}, description, count(*) AS n, sum(flux) AS flux FROM lines JOIN cut USING ({DS_SQL}) WHERE NOT flag AND flux / fluxErr >= c GROUP BY ALL",
    "flux",
)
def _(v):
    good = L.good_lines(v.lines, is_science=True, min_sn=12.0)
    return good.groupBy(*DS, "description").agg(F.count(F.lit(1)).alias("n"), F.sum("flux").alias("flux"))


@case(
    "centroid_error_cut", "F3", "lines",
    f"SELECT {DS_SQL}, description, count(*) AS n FROM lines WHERE NOT flag AND xErr > 0 AND xErr < 0.025 AND ((yErr > 0 AND yErr < 0.025) OR description = 'Trace') GROUP BY ALL",
)
def _(v):
    good = L.good_lines(v.lines, is_science=True, max_centroid_error=0.025)
    return good.groupBy(*DS, "description").agg(F.count(F.lit(1)).alias("n"))


ZONE = f"""waves AS (SELECT {DS_SQL}, wavelength + (fiberId % 3) * 0.7::DOUBLE AS w, bit_or(status) AS status FROM lines WHERE description <> 'Trace' GROUP BY ALL),
  zone AS (SELECT {DS_SQL}, a.w AS wavelength, a.status, bool_or(b.w IS NOT NULL) AS excluded FROM waves AS a LEFT JOIN waves AS b
    ON a.visit = b.visit AND a.arm = b.arm AND a.spectrograph = b.spectrograph AND a.w <> b.w AND abs(a.w - b.w) < 0.75 GROUP BY a.visit, a.arm, a.spectrograph, a.w, a.status)""".replace(
    f"zone AS (SELECT {DS_SQL},", "zone AS (SELECT a.visit, a.arm, a.spectrograph,"
)


def shifted(v):
    return v.lines.withColumn("wavelength", F.col("wavelength") + (F.col("fiberId") % 3) * 0.7)


@case("exclusion_zone", "J8 G39 U3", "lines", f"WITH {ZONE} SELECT * FROM zone", "wavelength")
def _(v):
    return L.exclusion_zone(shifted(v), DS, 0.75)


@case(
    "lines_outside_zones", "J8", "lines",
    f"WITH {ZONE} SELECT l.visit, l.arm, l.spectrograph, description, count(*) AS n FROM (SELECT *, wavelength + (fiberId % 3) * 0.7::DOUBLE AS w FROM lines) AS l "
    "LEFT JOIN zone AS z ON l.visit = z.visit AND l.arm = z.arm AND l.spectrograph = z.spectrograph AND l.w = z.wavelength AND z.excluded "
    "WHERE NOT flag AND (z.visit IS NULL OR description = 'Trace') GROUP BY ALL",
)
def _(v):
    good = L.good_lines(shifted(v), is_science=True, exclusion_radius=0.75)
    return good.groupBy(*DS, "description").agg(F.count(F.lit(1)).alias("n"))


@case(
    "stage_counts", "F4", "lines",
    f"""WITH {SN_CUT}, st AS (SELECT lines.*, NOT flag AS s1, NOT flag AND (status & 4) = 0 AS s3 FROM lines),
    cut2 AS (SELECT {DS_SQL}, least(avg(flux / fluxErr) - stddev_pop(flux / fluxErr), 12.0) AS c FROM st WHERE s3 GROUP BY {DS_SQL}),
    st2 AS (SELECT st.*, s3 AND flux / fluxErr >= c AS s5 FROM st JOIN cut2 USING ({DS_SQL})),
    st3 AS (SELECT *, s5 AND xErr > 0 AND xErr < 0.025 AND ((yErr > 0 AND yErr < 0.025) OR description = 'Trace') AS s6 FROM st2),
    u AS (SELECT description, count(*) FILTER (WHERE s1) AS flags, count(*) FILTER (WHERE s1) AS traces, count(*) FILTER (WHERE s3) AS status, count(*) FILTER (WHERE s3) AS finite,
      count(*) FILTER (WHERE s5) AS sn, count(*) FILTER (WHERE s6) AS centroid, count(*) FILTER (WHERE s6) AS zone FROM st3 GROUP BY description)
    SELECT * FROM (UNPIVOT u ON flags, traces, status, finite, sn, centroid, zone INTO NAME stage VALUE lines)""",
)
def _(v):
    staged = L.line_stages(v.lines, is_science=True, line_flags=4, min_sn=12.0, max_centroid_error=0.025)
    return L.stage_counts(staged)


@case(
    "measured_lines", "F11", "overlap_lines",
    "SELECT visit, arm, count(*) AS n, sum(flux) AS flux FROM overlap_lines WHERE y IS NOT NULL GROUP BY visit, arm", "flux",
)
def _(v):
    return L.measured_lines(v.overlap_lines).groupBy("visit", "arm").agg(F.count(F.lit(1)).alias("n"), F.sum("flux").alias("flux"))


DISPERSION = f"""lo AS (SELECT *, y - 0.5 AS ra, y + 0.5 AS rb FROM lines), {interp_sql('i0', 'lo', 'ra', 'calibration', ['arm', 'spectrograph', 'fiberId'], 'row', 'wavelength', 'w0')},
  {interp_sql('i1', 'i0', 'rb', 'calibration', ['arm', 'spectrograph', 'fiberId'], 'row', 'wavelength', 'w1')}"""


@case(
    "line_dispersion", "P29 A1", "lines calibration",
    f"WITH {DISPERSION} SELECT fiberId, wavelength, arm, description, abs(w1 - w0) AS dispersion, abs(w1 - w0) * 2.5 AS radius, xErr FROM i1",
    "wavelength dispersion radius xErr",
)
def _(v):
    rows = L.with_dispersion(v.lines, v.calibration)
    return rows.select("fiberId", "wavelength", "arm", "description", "dispersion", (F.col("dispersion") * 2.5).alias("radius"), "xErr")


# statistics


@case(
    "weighted_rms", "G1 G2 G39", "lines",
    f"""WITH {RES} SELECT {DS_SQL}, description, sqrt(sum(xResid * xResid / (xErr * xErr + 0.0001)) / sum(1 / (xErr * xErr + 0.0001))) AS rms,
    sqrt(sum(yResid * yResid / (yErr * yErr)) / sum(1 / (yErr * yErr))) AS rmsY, sum(xResid * xResid / (xErr * xErr + 0.0001)) AS chi2,
    coalesce(sum(yResid * yResid / (yErr * yErr)), 0) AS chi2Y, bit_or(status) AS statuses FROM res GROUP BY {DS_SQL}, description""",
    "rms rmsY chi2 chi2Y",
)
def _(v):
    rows = D.residual_columns(v.lines)
    return rows.groupBy(*DS, "description").agg(
        T.weighted_rms("xResid", "xErr", 0.01).alias("rms"), T.weighted_rms("yResid", "yErr").alias("rmsY"),
        T.chi2("xResid", "xErr", 0.01).alias("chi2"), T.chi2("yResid", "yErr").alias("chi2Y"), F.bit_or("status").alias("statuses"),
    )


@case(
    "robust_rms", "G3 G4 G20", "lines",
    f"""WITH {RES} SELECT {DS_SQL}, count(*) AS n, avg(xResid) AS mean, stddev_pop(xResid) AS sd, stddev_samp(yResid) AS sdY, quantile_cont(xResid, 0.25) AS q25, median(xResid) AS q50,
    quantile_cont(xResid, 0.75) AS q75, 0.741 * (quantile_cont(yResid, 0.75) - quantile_cont(yResid, 0.25)) AS robustY,
    CASE WHEN count(yResid) = count(*) THEN avg(yResid) END AS strictMean FROM res GROUP BY {DS_SQL}""",
    "mean sd sdY q25 q50 q75 robustY strictMean",
)
def _(v):
    rows = D.residual_columns(v.lines)
    out = group_stats(
        rows, DS,
        [F.count(F.lit(1)).alias("n"), F.avg("xResid").alias("mean"), F.stddev_pop("xResid").alias("sd"), F.stddev_samp("yResid").alias("sdY"), T.strict(F.avg("yResid"), "yResid").alias("strictMean")],
        {"q25": ("xResid", 0.25), "q50": ("xResid", 0.5), "q75": ("xResid", 0.75), "y25": ("yResid", 0.25), "y75": ("yResid", 0.75)},
    )
    return out.withColumn("robustY", (F.col("y75") - F.col("y25")) * T.IQR_ROBUST).drop("y25", "y75")


@case(
    "sigma_clip", "I1", "lines",
    f"WITH {CLIPPED} SELECT {GROUP_SQL}, fiberId, xResid, yResid, xResidOutlier, yResidOutlier FROM clipped",
    "xResid yResid",
)
def _(v):
    rows = sigma_clip(D.scrub(v.lines), GROUP, {"xResid": "xResidOutlier", "yResid": "yResidOutlier"})
    return rows.select(*GROUP, "fiberId", "xResid", "yResid", "xResidOutlier", "yResidOutlier")


@case(
    "soften_fit", "I2", "lines",
    f"WITH {SCRUB}, {soften_sql('sx', 'scrub', GROUP_SQL, 'xResid', 'xErr')}, {soften_sql('sy', 'scrub', GROUP_SQL, 'yResid', 'yErr')} SELECT {GROUP_SQL}, sx.s AS xSoft, sy.s AS ySoft FROM sx JOIN sy USING ({GROUP_SQL})",
    "xSoft ySoft",
)
def _(v):
    return soften_fit(D.scrub(v.lines), GROUP, {"xSoft": ("xResid", "xErr"), "ySoft": ("yResid", "yErr")})


@case(
    "bundle_join", "J1 P24", "lines fibers",
    "SELECT visit, substring(mtp_A, 1, 6) AS mtpGroup, count(*) AS n FROM lines JOIN (SELECT fiberId, mtp_A FROM fibers) AS f USING (fiberId) GROUP BY ALL",
)
def _(v):
    rows = v.lines.join(bundles(v), "fiberId")
    return rows.groupBy("visit", S.bundle_group("mtp_A").alias("mtpGroup")).agg(F.count(F.lit(1)).alias("n"))


@case(
    "distinct_fibers_and_lines", "G6 U3", "lines",
    f"SELECT {DS_SQL}, count(DISTINCT CASE WHEN description = 'Trace' THEN fiberId END) AS trace_fibers, count(DISTINCT CASE WHEN description <> 'Trace' THEN fiberId END) AS line_fibers, count(DISTINCT CASE WHEN description <> 'Trace' THEN wavelength END) AS wavelengths FROM lines GROUP BY {DS_SQL}",
)
def _(v):
    trace = S.is_trace()
    return v.lines.groupBy(*DS).agg(
        F.count_distinct(F.when(trace, F.col("fiberId"))).alias("trace_fibers"),
        F.count_distinct(F.when(~trace, F.col("fiberId"))).alias("line_fibers"),
        F.count_distinct(F.when(~trace, F.col("wavelength"))).alias("wavelengths"),
    )


@case(
    "residual_rows", "Q1 F9 J1", "lines fibers",
    f"WITH {KEPT} SELECT {GROUP_SQL}, fiberId, wavelength, mtp_A, isTrace, isLine, xResid, yResid, xResidOutlier, yResidOutlier, xErr FROM kept",
    "wavelength xResid yResid xErr",
)
def _(v):
    return kept_rows(v).select(*GROUP, "fiberId", "wavelength", "mtp_A", "isTrace", "isLine", "xResid", "yResid", "xResidOutlier", "yResidOutlier", "xErr")


STATUS_NAMES = {"USED": 1, "RESERVED": 2, "OTHER": 4}
PIXELS = 11
# Every detector has the radius that its own calibration gives, every visit its own reason.
RADII = f"""middle AS (SELECT arm, spectrograph, f[len(f) // 2 + 1] AS fiberId, m FROM (SELECT arm, spectrograph, list_sort(list(DISTINCT fiberId)) AS f, (min(row) + max(row)) / 2 AS m FROM calibration GROUP BY ALL) AS d),
  radii AS (SELECT arm, spectrograph, abs((arg_min(wavelength, row) FILTER (WHERE row > m) - arg_max(wavelength, row) FILTER (WHERE row <= m)) / (min(row) FILTER (WHERE row > m) - max(row) FILTER (WHERE row <= m))) AS width,
    width * {PIXELS} AS radius FROM calibration JOIN middle USING (arm, spectrograph, fiberId) GROUP BY arm, spectrograph)"""
NEAR = f"""sh AS (SELECT * REPLACE (wavelength + (fiberId % 3) * 0.7::DOUBLE AS wavelength) FROM lines), {RADII},
  waves AS (SELECT {DS_SQL}, wavelength AS w, bit_or(status) AS status FROM sh WHERE description <> 'Trace' GROUP BY ALL),
  near AS (SELECT a.visit, a.arm, a.spectrograph, a.w AS wavelength, a.status, bool_or(b.w IS NOT NULL) AS excluded FROM waves AS a LEFT JOIN radii AS r ON a.arm = r.arm AND a.spectrograph = r.spectrograph
    LEFT JOIN waves AS b ON a.visit = b.visit AND a.arm = b.arm AND a.spectrograph = b.spectrograph AND a.w <> b.w AND abs(a.w - b.w) < r.radius GROUP BY a.visit, a.arm, a.spectrograph, a.w, a.status)"""
BY_VISIT = f"""{NEAR}, has AS (SELECT {DS_SQL}, bool_or(description <> 'Trace') AS has_lines FROM sh GROUP BY {DS_SQL}),
  good AS (SELECT sh.*, observationReason FROM sh JOIN has USING ({DS_SQL}) LEFT JOIN observations USING (visit) LEFT JOIN (SELECT * EXCLUDE (status) FROM near WHERE excluded) AS n USING ({DS_SQL}, wavelength)
    WHERE NOT flag AND (observationReason = 'science' OR description <> 'Trace' OR NOT has_lines) AND (excluded IS NULL OR description = 'Trace')),
  {CLIPPED.replace('FROM lines)', 'FROM good)')}, lo AS (SELECT *, y - 0.5 AS ra, y + 0.5 AS rb FROM clipped WHERE (isLine AND NOT yResidOutlier) OR (isTrace AND NOT xResidOutlier)),
  {interp_sql('i0', 'lo', 'ra', 'calibration', ['arm', 'spectrograph', 'fiberId'], 'row', 'wavelength', 'w0')},
  {interp_sql('i1', 'i0', 'rb', 'calibration', ['arm', 'spectrograph', 'fiberId'], 'row', 'wavelength', 'w1')}"""


@case("exclusion_zone_by_detector", "J8 G39 U3", "lines calibration", f"WITH {NEAR} SELECT * FROM near", "wavelength")
def _(v):
    rows = D.with_observation(shifted(v), calibration=v.calibration, exclusion_pixels=PIXELS)
    return L.exclusion_zone(rows, DS, F.col("exclusionRadius"))


@case("dispersion_at_center", "J8 P29", "calibration", f"WITH {RADII} SELECT arm, spectrograph, width AS dispersion FROM radii", "dispersion")
def _(v):
    return L.dispersion_at_center(v.calibration)


@case(
    "residual_rows_by_visit", "Q1 F9 J1 J8", "lines calibration observations fibers",
    f"""WITH {BY_VISIT} SELECT {GROUP_SQL}, observationReason, fiberId, wavelength, mtp_A, isTrace, xResid, yResid, abs(w1 - w0) AS dispersion,
    CASE status WHEN 1 THEN 'USED' WHEN 2 THEN 'RESERVED' ELSE 'USED|RESERVED' END AS status_name FROM i1 JOIN (SELECT fiberId, mtp_A FROM fibers) AS f USING (fiberId)""",
    "wavelength xResid yResid dispersion",
)
def _(v):
    rows = D.residual_data(
        shifted(v), bundles(v), observations=v.observations, calibration=v.calibration, exclusion_pixels=PIXELS, status_names=STATUS_NAMES
    )
    return rows.select(*GROUP, "observationReason", "fiberId", "wavelength", "mtp_A", "isTrace", "xResid", "yResid", "dispersion", "status_name")


@case("residual_stats", "Q1 G5 R5", "lines fibers", f"WITH {STATS} SELECT * FROM stats", STAT_DOUBLES)
def _(v):
    return flat_stats(v)


@case(
    "stats_over_visits", "G7", "lines fibers",
    f"WITH {STATS} SELECT arm, spectrograph, status_type, description, median(dof) AS dof, median(chi2X) AS chi2X, median(spatial_median) AS spatial_median, median(wavelength_weightedRms) AS wavelength_weightedRms FROM stats GROUP BY ALL",
    "dof chi2X spatial_median wavelength_weightedRms",
)
def _(v):
    keys = ["arm", "spectrograph", "status_type", "description"]
    return D.stats_over_visits(flat_stats(v), keys, ["dof", "chi2X", "spatial_median", "wavelength_weightedRms"])


# tables of the per-visit report

MELTED = f"""{KEPT}, melted AS (SELECT *, 'isUsed' AS status_flag FROM kept WHERE isUsed UNION ALL SELECT *, 'isReserved' FROM kept WHERE isReserved)"""


@case(
    "status_rows", "R1", "lines",
    f"WITH {RES} SELECT status_flag AS status, isLine, count(*) AS n FROM (SELECT *, 'isUsed' AS status_flag FROM res WHERE isUsed UNION ALL SELECT *, 'isReserved' FROM res WHERE isReserved) AS m GROUP BY ALL",
)
def _(v):
    return melt_status(D.residual_columns(v.lines).drop("status")).groupBy("status", "isLine").agg(F.count(F.lit(1)).alias("n"))


def report_rows(v, column):
    return D.plot_rows(kept_rows(v).drop("status"), column)


SUMMARY_Y = f"""{MELTED}, summary AS (SELECT {DS_SQL}, fiberId, status_flag AS status, yResidOutlier AS isOutlier, count(*) AS count, median(yResid) AS median,
    sqrt(sum(yResid * yResid / (yErr * yErr)) / sum(1 / (yErr * yErr))) AS weightedRms FROM melted WHERE NOT isTrace GROUP BY ALL)"""


@case("fiber_residual_summary", "Q2 G8 W11", "lines fibers", f"WITH {SUMMARY_Y} SELECT * FROM summary", "median weightedRms")
def _(v):
    return D.fiber_summary(report_rows(v, "yResid"), "yResid").orderBy("fiberId", "status")


RMS_OF_DATASET = f"rms AS (SELECT {DS_SQL}, sqrt(sum(yResid * yResid / (yErr * yErr)) / sum(1 / (yErr * yErr))) / 4 AS rms FROM melted WHERE NOT isTrace AND status_flag = 'isReserved' AND NOT yResidOutlier GROUP BY {DS_SQL})"


@case(
    "outlier_fiber_counts", "Q2 G9 P30", "lines fibers",
    f"WITH {SUMMARY_Y}, {RMS_OF_DATASET} SELECT {DS_SQL}, count(*) FILTER (WHERE abs(median) >= rms) AS beyond1, count(*) FILTER (WHERE abs(median) >= rms * 2.5) AS beyond2, max(rms) AS limit1, max(rms) * 2.5 AS limit2 FROM summary JOIN rms USING ({DS_SQL}) WHERE status = 'isReserved' AND NOT isOutlier GROUP BY ALL",
    "limit1 limit2",
)
def _(v):
    rows = cut(report_rows(v, "yResid"))
    reserved = rows.where((F.col("status") == "isReserved") & ~F.col("isOutlier"))
    rms = reserved.groupBy(*DS).agg((T.weighted_rms("yResid", "yErr") / 4).alias("rms"))
    return D.outlier_fibers(D.fiber_summary(rows, "yResid"), rms)


@case(
    "step_bins", "A3", "lines",
    f"""WITH b AS (SELECT *, min(wavelength) OVER (PARTITION BY {DS_SQL}) - 1 AS a, max(wavelength) OVER (PARTITION BY {DS_SQL}) + 1 AS z FROM lines)
    SELECT {DS_SQL}, CASE WHEN ceil((wavelength - a) / 7.0) - 1 <= ceil((z - a) / 7.0) - 2 THEN CAST(ceil((wavelength - a) / 7.0) - 1 AS INT) END AS bin, wavelength FROM b""",
    "wavelength",
)
def _(v):
    return step_bin(v.lines, DS, "wavelength", 7.0, "bin").select(*DS, "bin", "wavelength")


@case(
    "binned_residuals", "Q2 A4", "lines fibers",
    f"""WITH {MELTED}, e AS (SELECT *, min(wavelength) OVER (PARTITION BY {DS_SQL}) - 1 AS a, max(wavelength) OVER (PARTITION BY {DS_SQL}) + 1 AS z FROM melted WHERE isTrace),
    b AS (SELECT *, CAST(ceil((wavelength - a) / 10.0) - 1 AS INT) AS bin FROM e WHERE ceil((wavelength - a) / 10.0) - 1 <= ceil((z - a) / 10.0) - 2)
    SELECT {DS_SQL}, bin, status_flag AS status, xResidOutlier AS isOutlier, median(wavelength) AS wavelength, median(xResid) AS xResid FROM b GROUP BY ALL""",
    "wavelength xResid",
)
def _(v):
    return D.binned_residual(report_rows(v, "xResid"), "xResid", 10.0)


# tables of the combined report


@case(
    "mean_over_visits", "Q3 G10", "lines fibers",
    f"""WITH {KEPT} SELECT arm, spectrograph, status, isLine, fiberId, y, avg(wavelength) AS wavelength, avg(x) AS x, avg(xErr) AS xErr, avg(yErr) AS yErr, avg(xResid) AS xResid, avg(yResid) AS yResid,
    avg(isTrace::INT) AS isTrace, avg(xResidOutlier::INT) AS xResidOutlier, avg(yResidOutlier::INT) AS yResidOutlier, avg(isUsed::INT) AS isUsed, avg(isReserved::INT) AS isReserved FROM kept GROUP BY ALL""",
    "y wavelength x xErr yErr xResid yResid isTrace xResidOutlier yResidOutlier isUsed isReserved",
)
def _(v):
    return D.combine_visits(kept_rows(v))


@case(
    "ordered_detector_stats", "Q3 W11 W12 U1", "lines fibers",
    f"""WITH {STATS} SELECT visit, arm, spectrograph, description, status_type, ccd, CASE arm WHEN 'b' THEN 0 WHEN 'r' THEN 4 WHEN 'm' THEN 8 ELSE 12 END + spectrograph AS ccd_order, spatial_median FROM stats""",
    "spatial_median",
)
def _(v):
    stats = flat_stats(v)
    by_status = [stats.where(F.col("status_type") == s) for s in ("USED", "RESERVED")]
    out = concat_tables(*by_status).withColumn("ccd_order", D.ccd_position().cast("int"))
    cols = ["visit", "arm", "spectrograph", "description", "status_type", "ccd", "ccd_order", "spatial_median"]
    return out.select(*cols).orderBy("visit", "arm", "spectrograph", "description")


RESERVED = f"{STATS}, reserved AS (SELECT * FROM stats WHERE status_type = 'RESERVED')"
SIX = "spatial_median spatial_weightedRms spatial_softenFit wavelength_median wavelength_weightedRms wavelength_softenFit"


def reserved_stats(v):
    return cut(flat_stats(v).where(F.col("status_type") == "RESERVED"))


@case(
    "detector_summary", "Q3 G11 R7", "lines fibers",
    f"WITH {RESERVED} SELECT ccd, "
    + ", ".join(f"avg({c}) FILTER (WHERE description {'=' if c.startswith('spatial') else '<>'} 'Trace') AS {c}" for c in SIX.split())
    + " FROM reserved GROUP BY ccd",
    SIX,
)
def _(v):
    return D.detector_summary(reserved_stats(v))


LONG = f"""{RESERVED}, slong AS (SELECT ccd, description, variable, value FROM (UNPIVOT (SELECT ccd, description, {', '.join(SIX.split())} FROM reserved) ON {', '.join(SIX.split())} INTO NAME variable VALUE value)
  WHERE value IS NOT NULL AND (description = 'Trace' OR NOT variable LIKE 'spatial%'))"""


@case("stats_long_form", "R2", "lines fibers", f"WITH {LONG} SELECT * FROM slong", "value")
def _(v):
    return D.stats_long(reserved_stats(v))


@case(
    "detector_box_table", "Q3 G12", "lines fibers",
    f"""WITH {LONG}, box AS (SELECT ccd, description, variable, count(value) AS count, quantile_cont(value, 0.25) AS q25, median(value) AS q50, quantile_cont(value, 0.75) AS q75 FROM slong GROUP BY ALL)
    SELECT box.*, (SELECT min(value) FROM slong AS s WHERE s.ccd = box.ccd AND s.description = box.description AND s.variable = box.variable AND value >= q25 - (q75 - q25) * 1.5) AS low,
    (SELECT max(value) FROM slong AS s WHERE s.ccd = box.ccd AND s.description = box.description AND s.variable = box.variable AND value <= q75 + (q75 - q25) * 1.5) AS high FROM box""",
    "q25 q50 q75 low high",
)
def _(v):
    return D.detector_box(reserved_stats(v))


@case(
    "visit_ranges", "Q3 G13", "lines fibers",
    f"""WITH {RESERVED}, kinds AS (SELECT ccd, 'spatial' AS kind, median(spatial_median) AS median, median(spatial_weightedRms) AS rms FROM reserved WHERE description = 'Trace' GROUP BY ccd
    UNION ALL SELECT ccd, 'wavelength', median(wavelength_median), median(wavelength_weightedRms) FROM reserved WHERE description <> 'Trace' GROUP BY ccd)
    SELECT *, median + rms AS upper, median - rms AS lower FROM kinds""",
    "median rms upper lower",
)
def _(v):
    return D.visit_summary(reserved_stats(v))


@case(
    "visit_order", "Q3 W3", "lines fibers",
    f"""WITH {RESERVED}, r AS (SELECT ccd, visit, description, row_number() OVER (PARTITION BY ccd ORDER BY visit, description, status_type) AS visit_idx FROM reserved)
    SELECT *, min(visit_idx) OVER (PARTITION BY ccd, visit) AS first_idx FROM r""",
)
def _(v):
    return D.visit_order(reserved_stats(v)).select("ccd", "visit", "description", "visit_idx", "first_idx")


@case(
    "first_line_per_key", "W4", "lines",
    "SELECT DISTINCT visit, arm, fiberId, first_value(flux) OVER (PARTITION BY visit, arm, fiberId ORDER BY flux, wavelength) AS flux FROM lines",
    "flux",
)
def _(v):
    rows = v.lines.select("visit", "arm", "fiberId", "flux", "wavelength")
    return first_per_key(rows, ["visit", "arm", "fiberId"], ["flux", "wavelength"]).drop("wavelength")
