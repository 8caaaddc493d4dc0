"""Queries on catalogues, fiber tables and observation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.operators.reshape import flag_per_value
from fiberqa.operators.sampling import sample_fibers, split_fibers
from fiberqa.plans import extraction as E
from fiberqa.plans import fluxcal as X
from fiberqa.sources import catalog as C
from fiberqa.sources.frames import load

from .registry import case

PLACE = ["instrument", "visit", "arm"]
TYPES = {
    "config": ("instrument", "visit"),
    "spectra": ("instrument", "visit", "arm", "spectrograph"),
    "norms": ("instrument", "visit", "arm"),
}
GROUPS = """s AS (SELECT instrument, visit, arm, count(DISTINCT spectrograph) AS n_spectra FROM datasets WHERE dataset_type = 'spectra' GROUP BY ALL),
  n AS (SELECT instrument, visit, arm, count(*) AS n_norms FROM (SELECT DISTINCT * FROM datasets WHERE dataset_type = 'norms') AS d GROUP BY ALL),
  c AS (SELECT instrument, visit, count(*) AS n_config FROM (SELECT DISTINCT * FROM datasets WHERE dataset_type = 'config') AS d GROUP BY ALL)"""


@case("load_dataset", "S1 S2", "", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_linenumber <= 3 GROUP BY ALL")
def _(v):
    return load(v.spark, f"{v.folder}/lineitem.parquet", "l_returnflag in ('A', 'N') and l_linenumber <= 3").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@case(
    "data_selection", "S2 F5", "lines",
    "SELECT visit, arm, spectrograph, count(*) AS n FROM lines WHERE visit IN (1000, 1001, 1002) AND arm IN ('b', 'r') GROUP BY ALL",
)
def _(v):
    return v.lines.where(F.expr("visit in (1000, 1001, 1002) and arm in ('b', 'r')")).groupBy("visit", "arm", "spectrograph").agg(F.count(F.lit(1)).alias("n"))


@case(
    "dataset_groups", "Q7 S3", "datasets",
    f"WITH {GROUPS} SELECT instrument, visit, arm, n_config, n_spectra, n_norms, CASE WHEN n_config > 1 THEN 'config' WHEN n_norms > 1 THEN 'norms' END AS violation FROM s JOIN n USING (instrument, visit, arm) JOIN c USING (instrument, visit)",
)
def _(v):
    groups = C.dataset_groups(v.datasets, TYPES, PLACE, multiple=["spectra"])
    return C.require_groups(groups)


@case(
    "group_keys", "U2", "datasets",
    "SELECT visit, arm, 'both' AS part FROM (SELECT DISTINCT visit, arm FROM datasets WHERE dataset_type = 'spectra' INTERSECT SELECT visit, arm FROM datasets WHERE dataset_type = 'norms') AS a "
    "UNION ALL SELECT visit, arm, 'any' FROM (SELECT visit, arm FROM datasets WHERE dataset_type = 'spectra' UNION SELECT visit, arm FROM datasets WHERE dataset_type = 'norms') AS b",
)
def _(v):
    keys = [v.datasets.where(F.col("dataset_type") == t).select("visit", "arm") for t in ("spectra", "norms")]
    both = keys[0].intersect(keys[1]).withColumn("part", F.lit("both"))
    return both.union(keys[0].union(keys[1]).distinct().withColumn("part", F.lit("any")))


@case(
    "reference_visit", "Q7 S4", "datasets",
    """WITH s AS (SELECT DISTINCT instrument, visit, arm, spectrograph FROM datasets WHERE dataset_type = 'spectra'), m AS (SELECT min(visit) AS r FROM s)
    SELECT instrument, arm, spectrograph, visit, r AS refVisit FROM s CROSS JOIN m WHERE visit <> r AND EXISTS (SELECT 1 FROM s AS t WHERE t.visit = r AND t.instrument = s.instrument AND t.arm = s.arm AND t.spectrograph = s.spectrograph)""",
)
def _(v):
    return C.with_reference(v.datasets.where(F.col("dataset_type") == "spectra"))


@case(
    "reference_visit_given", "S4", "datasets",
    """WITH s AS (SELECT DISTINCT instrument, visit, arm, spectrograph FROM datasets WHERE dataset_type = 'spectra')
    SELECT instrument, arm, spectrograph, visit, 1007 AS refVisit FROM s WHERE visit <> 1007 AND EXISTS (SELECT 1 FROM s AS t WHERE t.visit = 1007 AND t.instrument = s.instrument AND t.arm = s.arm AND t.spectrograph = s.spectrograph)""",
)
def _(v):
    return C.with_reference(v.datasets.where(F.col("dataset_type") == "spectra"), 1007)


@case(
    "group_validation", "S5", "jobs",
    """WITH f AS (SELECT job, count(DISTINCT instrument) AS i, count(DISTINCT CASE WHEN role <> 'reference' THEN visit END) AS v, count(DISTINCT CASE WHEN role <> 'config' THEN arm END) AS a,
      count(DISTINCT CASE WHEN role = 'reference' THEN visit END) AS rv FROM jobs GROUP BY job),
    sp AS (SELECT job, spectrograph, count(*) FILTER (WHERE role = 'target') AS t, count(*) FILTER (WHERE role = 'reference') AS r FROM jobs WHERE role IN ('target', 'reference') GROUP BY ALL)
    SELECT job, 'instrument' AS violation FROM f WHERE i > 1 UNION ALL SELECT job, 'visit' FROM f WHERE v > 1 UNION ALL SELECT job, 'arm' FROM f WHERE a > 1 UNION ALL SELECT job, 'reference visit' FROM f WHERE rv > 1
    UNION ALL SELECT job, 'duplicate spectrograph' FROM sp GROUP BY job HAVING bool_or(t > 1) UNION ALL SELECT job, 'spectrograph set' FROM sp GROUP BY job HAVING bool_or((t > 0) <> (r > 0))""",
)
def _(v):
    return C.validate_groups(v.jobs)


@case(
    "observation_info", "Q9 S6", "exposures telescope environment",
    """SELECT e.visit, time_exp_start, exptime, altitude, azimuth, insrot, outside_humidity FROM exposures AS e JOIN (SELECT * FROM telescope QUALIFY row_number() OVER (PARTITION BY visit ORDER BY seq) = 1) AS t USING (visit) JOIN environment USING (visit)""",
    "exptime altitude azimuth insrot outside_humidity",
)
def _(v):
    return C.obs_info(v.exposures, v.telescope, v.environment)


@case("guide_series", "Q9 S7", "seeing transparency", "SELECT agc_exposure_id, visit, seeing_median, transparency_median FROM seeing JOIN transparency USING (agc_exposure_id)", "seeing_median transparency_median")
def _(v):
    return C.guide_series(v.seeing, v.transparency)


@case(
    "guide_summary", "Q9 G23", "seeing transparency",
    """SELECT visit, median(transparency_median) AS transparencyMedian, (quantile_cont(transparency_median, 0.75) - quantile_cont(transparency_median, 0.25)) / 1.349 AS transparencySigma,
    median(seeing_median) AS seeingMedian, (quantile_cont(seeing_median, 0.75) - quantile_cont(seeing_median, 0.25)) / 1.349 AS seeingSigma FROM seeing JOIN transparency USING (agc_exposure_id) GROUP BY visit""",
    "transparencyMedian transparencySigma seeingMedian seeingSigma",
)
def _(v):
    return X.guide_summary(v.seeing.join(v.transparency, "agc_exposure_id"))


@case(
    "first_object", "Q9 S8", "headers",
    """SELECT visit, coalesce(arg_min(object, (spectrograph, CASE arm WHEN 'b' THEN 1 WHEN 'r' THEN 2 WHEN 'n' THEN 3 ELSE 4 END)) FILTER (WHERE object IS NOT NULL), 'unknown') AS object FROM headers GROUP BY visit""",
)
def _(v):
    return C.first_object(v.headers)


@case("header_metadata", "S9", "headers", "SELECT visit, arm, min(priority) AS PRIORITY, min(price) AS PRICE, CAST(NULL AS VARCHAR) AS MISSING FROM headers GROUP BY ALL")
def _(v):
    rows = v.headers.withColumn("metadata", F.create_map(F.lit("PRIORITY"), "priority", F.lit("PRICE"), "price"))
    return C.metadata(rows, ["visit", "arm"], ["PRIORITY", "PRICE", "MISSING"])


@case(
    "hawaii_time", "P25", "exposures",
    "SELECT visit, strftime(time_exp_start - INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M:%S.') || substr(strftime(time_exp_start, '%f'), 1, 1) AS hst FROM exposures",
)
def _(v):
    return v.exposures.select("visit", S.utc_to_hawaii("time_exp_start").alias("hst"))


@case(
    "event_hawaii_time", "P25", "",
    "SELECT event_id, strftime(ts - INTERVAL 10 HOUR, '%Y-%m-%dT%H:%M:%S.') || substr(strftime(ts, '%f'), 1, 1) AS hst FROM events",
)
def _(v):
    return v.table("events").select("event_id", S.utc_to_hawaii("ts").alias("hst"))


@case(
    "selected_fibers", "F5", "fibers",
    "SELECT fiberId, targetType, spectrograph FROM fibers WHERE fiberStatus = 'GOOD' AND targetType <> 'ENGINEERING' AND targetType IN ('SCIENCE', 'SKY', 'FLUXSTD') AND spectrograph IN (1, 3)",
)
def _(v):
    rows = v.fibers.where((F.col("fiberStatus") == "GOOD") & ~S.one_of("targetType", ["ENGINEERING"]))
    return rows.where(S.one_of("targetType", ["SCIENCE", "SKY", "FLUXSTD"]) & S.one_of("spectrograph", [1, 3])).select("fiberId", "targetType", "spectrograph")


@case("positioned_standards", "Q9 F6 P21", "fibers", "SELECT fiberId, sqrt((xNominal - xFocal) * (xNominal - xFocal) + (yNominal - yFocal) * (yNominal - yFocal)) AS distance FROM fibers WHERE targetType = 'FLUXSTD' AND fiberStatus = 'GOOD' AND sqrt((xNominal - xFocal) * (xNominal - xFocal) + (yNominal - yFocal) * (yNominal - yFocal)) <= 0.05", "distance")
def _(v):
    return X.standards(v.fibers).select("fiberId", S.offset("xNominal", "yNominal", "xFocal", "yFocal").alias("distance"))


@case("target_counts", "Q4 G19", "fibers", "SELECT spectrograph, targetType, count(*) AS fibers FROM fibers GROUP BY ALL")
def _(v):
    return E.target_counts(v.fibers)


@case("target_flags", "R8", "fibers", "SELECT fiberId, targetType = 'SCIENCE' AS is_science, targetType = 'SKY' AS is_sky, targetType = 'FLUXSTD' AS is_fluxstd FROM fibers")
def _(v):
    return flag_per_value(v.fibers, "targetType", ["SCIENCE", "SKY", "FLUXSTD"]).select("fiberId", "is_science", "is_sky", "is_fluxstd")


@case("anonymous_positions", "Q9 P19", "fibers", "SELECT fiberId, (ra - 150.1) * cos(radians(2.1)) AS ra, decl - 2.1 AS decl FROM fibers", "ra decl")
def _(v):
    rows = v.fibers.select("fiberId", "ra", "decl", F.lit(150.1).alias("ra0"), F.lit(2.1).alias("dec0"))
    return rows.select("fiberId", S.relative_ra("ra", "ra0", "dec0").alias("ra"), S.relative_dec("decl", "dec0").alias("decl"))


@case("split_counts", "Q11 W13", "spectra", "SELECT visit, arm, spectrograph, count(DISTINCT fiberId) AS fibers, CAST(greatest(1, floor(count(DISTINCT fiberId) * 0.1::DOUBLE)) AS BIGINT) AS reference FROM spectra GROUP BY ALL")
def _(v):
    split = split_fibers(v.spectra, ["visit", "arm", "spectrograph"])
    return split.groupBy("visit", "arm", "spectrograph").agg(
        F.count_distinct("fiberId").alias("fibers"), F.count_distinct(F.when(F.col("isReference"), F.col("fiberId"))).alias("reference")
    )


LOT = "('0x' || substr(md5(concat_ws('|', fiberId, 0)), 1, 13))::BIGINT"


@case(
    "split_members", "W13", "spectra",
    f"""WITH f AS (SELECT DISTINCT visit, arm, spectrograph, fiberId, {LOT} AS lot FROM spectra),
    o AS (SELECT *, row_number() OVER (PARTITION BY visit, arm, spectrograph ORDER BY lot) AS place, count(*) OVER (PARTITION BY visit, arm, spectrograph) AS n FROM f),
    e AS (SELECT visit, arm, spectrograph, lot AS last FROM o WHERE place = greatest(floor(n * 0.1::DOUBLE), 1))
    SELECT visit, arm, spectrograph, fiberId FROM f JOIN e USING (visit, arm, spectrograph) WHERE lot <= last""",
)
def _(v):
    return split_fibers(v.spectra, ["visit", "arm", "spectrograph"]).where("isReference").select("visit", "arm", "spectrograph", "fiberId").distinct()


@case(
    "sampled_fibers", "Q13 W14", "spectra",
    f"""WITH f AS (SELECT DISTINCT arm, spectrograph, fiberId, {LOT} AS lot FROM spectra),
    o AS (SELECT *, row_number() OVER (PARTITION BY arm, spectrograph ORDER BY lot, fiberId) AS place FROM f)
    SELECT arm, spectrograph, fiberId FROM o WHERE place <= 25""",
)
def _(v):
    return sample_fibers(v.spectra, ["arm", "spectrograph"], 25)


@case("sampled_fiber_counts", "W14", "spectra", "SELECT arm, spectrograph, least(25, count(DISTINCT fiberId)) AS n FROM spectra GROUP BY ALL")
def _(v):
    return sample_fibers(v.spectra, ["arm", "spectrograph"], 25).groupBy("arm", "spectrograph").agg(F.count_distinct("fiberId").alias("n"))
