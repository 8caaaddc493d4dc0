"""Views that give the given tables the shapes of spectroscopic data.

The text is plain SQL for both engines. Double literals are written ``1.0D0``, string type
is ``STRING``, and base tables stand in braces. Every view reads whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "supplier", "orders", "lineitem", "events", "embeddings")

ARM = "CASE l_returnflag WHEN 'A' THEN 'b' WHEN 'N' THEN 'r' ELSE 'n' END"

VIEWS = {
    # one row per (fiber, line, visit), with the detector map evaluated
    "lines": f"""
SELECT fiberId, wavelength, description, visit, arm, spectrograph, xModel, yModel, xModel + dx AS x,
  CASE WHEN description = 'Trace' THEN yRow ELSE yModel + dy END AS y,
  xErr, yErr, flux, fluxErr, flag, status
FROM (
  SELECT CAST(l_suppkey AS INT) AS fiberId, 600.0D0 + (l_partkey % 40) * 2.5D0 AS wavelength,
    CASE l_linenumber WHEN 1 THEN 'ArI' WHEN 2 THEN 'NeI' WHEN 3 THEN 'KrI' WHEN 4 THEN 'HgI' WHEN 5 THEN 'XeI' ELSE 'Trace' END AS description,
    CAST(1000 + l_orderkey % 4 AS INT) AS visit, {ARM} AS arm, CAST(1 + l_suppkey % 4 AS INT) AS spectrograph,
    40.0D0 * (l_suppkey % 100) + 20.0D0 AS xModel, (l_partkey % 40) * 100.0D0 + 50.0D0 AS yRow,
    CASE WHEN l_linenumber >= 6 THEN NULL ELSE (l_partkey % 40) * 100.0D0 + 50.0D0 END AS yModel,
    (floor(l_extendedprice * 100.0D0 + 0.5D0) % 2001 - 1000) / 10000.0D0 * CASE WHEN l_orderkey % 97 = 0 THEN 20.0D0 ELSE 1.0D0 END AS dx,
    (floor(l_extendedprice * 100.0D0 + 0.5D0) % 1777 - 888) / 10000.0D0 * CASE WHEN l_partkey % 89 = 0 THEN 20.0D0 ELSE 1.0D0 END AS dy,
    0.01D0 + l_quantity / 2000.0D0 AS xErr, 0.01D0 + l_tax / 4.0D0 AS yErr,
    l_extendedprice AS flux, l_quantity * 100.0D0 AS fluxErr, l_orderkey % 50 = 0 AS flag,
    CAST(CASE WHEN l_partkey % 10 < 6 THEN 1 WHEN l_partkey % 10 < 8 THEN 2 WHEN l_partkey % 10 < 9 THEN 3 ELSE 4 END AS INT) AS status
  FROM {{lineitem}}) AS l
""",
    # trace-window pixels of detector images
    "pixels": f"""
SELECT CAST(1000 + l_orderkey % 2 AS INT) AS visit, {ARM} AS arm, CAST(1 + l_suppkey % 4 AS INT) AS spectrograph,
  CAST(l_suppkey AS INT) AS fiberId, CAST(l_orderkey % 20 AS INT) AS y, CAST(l_linenumber - 4 AS INT) AS dx,
  CAST(20 * (l_suppkey % 200) + l_linenumber AS INT) AS x, l_extendedprice AS image,
  l_extendedprice * (0.95D0 + l_discount) AS model, l_extendedprice * (1.0D0 + l_quantity) AS variance,
  CAST(CASE WHEN l_partkey % 37 = 0 THEN 4 ELSE 0 END AS INT) AS mask
FROM {{lineitem}}
""",
    # one row per detector pixel, several measurements averaged
    "detector": f"""
SELECT CAST(1 + l_suppkey % 4 AS INT) AS spectrograph, CAST(l_orderkey % 100 AS INT) AS y,
  CAST(l_partkey % 200 AS INT) AS x, max(l_extendedprice) AS image, max(l_quantity) AS variance,
  CAST(min(l_linenumber) % 2 AS INT) AS mask
FROM {{lineitem}} GROUP BY 1, 2, 3
""",
    # centers of fiber traces per row
    "traces": """
SELECT CAST(1 + s_suppkey % 4 AS INT) AS spectrograph, CAST(s_suppkey AS INT) AS fiberId,
  CAST(s_suppkey % 100 AS INT) AS y, s_acctbal / 50.0D0 + 0.5D0 AS xCenter
FROM {supplier}
""",
    # fiber configuration
    "fibers": """
SELECT CAST(s_suppkey AS INT) AS fiberId, CAST(1 + s_suppkey % 4 AS INT) AS spectrograph, s_suppkey AS objId, CAST(s_nationkey AS INT) AS catId,
  CASE WHEN s_suppkey % 23 = 22 THEN 'BROKENFIBER' ELSE 'GOOD' END AS fiberStatus,
  CASE s_suppkey % 5 WHEN 0 THEN 'SKY' WHEN 1 THEN 'FLUXSTD' WHEN 2 THEN 'ENGINEERING' ELSE 'SCIENCE' END AS targetType,
  concat(CASE s_suppkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'D' ELSE 'C' END, CAST(1 + s_suppkey % 4 AS STRING), '-', CAST(s_suppkey % 3 AS STRING), '-', CAST(s_suppkey % 5 AS STRING), '-', CAST(s_suppkey AS STRING)) AS mtp_A,
  (s_suppkey % 10) * 40.0D0 - 180.0D0 AS xFocal, (s_suppkey % 17) * 25.0D0 - 200.0D0 AS yFocal,
  (s_suppkey % 10) * 40.0D0 - 180.0D0 + CASE WHEN s_suppkey % 19 = 18 THEN 0.2D0 ELSE 0.01D0 END AS xNominal, (s_suppkey % 17) * 25.0D0 - 200.0D0 AS yNominal,
  150.0D0 + (s_suppkey % 31) / 100.0D0 AS ra, 2.0D0 + (s_suppkey % 29) / 100.0D0 AS decl,
  20000.0D0 + s_acctbal AS flux_g, 24000.0D0 + s_acctbal AS flux_r, 26000.0D0 + s_acctbal AS flux_i, 27000.0D0 + s_acctbal AS flux_z, 27500.0D0 + s_acctbal AS flux_y
FROM {supplier}
""",
    # sky-subtracted spectra; measurements of one pixel are combined
    "spectra": f"""
SELECT CAST(1000 + l_linenumber % 2 AS INT) AS visit, {ARM} AS arm, CAST(l_suppkey AS INT) AS fiberId,
  CAST(1 + l_suppkey % 4 AS INT) AS spectrograph, CAST(l_partkey % 100 AS INT) AS pix,
  450.0D0 + (l_partkey % 100) * 2.5D0 + (l_suppkey % 7) * 0.01D0 AS wavelength,
  (sum(floor(l_extendedprice * 100.0D0 + 0.5D0)) % 2003 - 1001) / 50.0D0 AS flux,
  900.0D0 + max(l_quantity) * 4.0D0 + l_suppkey % 11 AS sky,
  40.0D0 + sum(l_linenumber) % 13 AS variance,
  CAST(CASE WHEN min(l_orderkey) % 41 = 0 THEN 1 ELSE 0 END AS INT) AS mask
FROM {{lineitem}} GROUP BY l_linenumber % 2, {ARM}, l_suppkey, l_partkey % 100
""",
    # lamp spectra of three visits; also stand for norms and for calibrated spectra in nJy
    "quartz": f"""
SELECT CAST(1000 + v AS INT) AS visit, arm, CAST(f AS INT) AS fiberId, CAST(1 + f % 4 AS INT) AS spectrograph, CAST(p AS INT) AS pix,
  CASE arm WHEN 'b' THEN 430.0D0 WHEN 'r' THEN 630.0D0 ELSE 930.0D0 END + p * CASE arm WHEN 'b' THEN 5.0D0 ELSE 7.0D0 END AS wavelength,
  (20000.0D0 + f % 1000 * 10.0D0 + p * 5.0D0) * (1.0D0 + v * 0.01D0) + s % 101 * CASE WHEN f % 13 = 5 AND v > 0 THEN 20.0D0 ELSE 1.0D0 END AS flux,
  1000.0D0 + (p * 7 + f * 3 + v) % 50 AS norm, 40000.0D0 + (f * 31 + p * 17) % 13 AS variance, 30000.0D0 + (f * 29 + p * 19) % 11 AS covar0,
  CAST(CASE WHEN (f + p) % 43 = 0 THEN 1 ELSE 0 END AS INT) AS mask
FROM (SELECT l_linenumber % 3 AS v, {ARM} AS arm, l_suppkey AS f, l_partkey % 50 AS p,
    sum(floor(l_extendedprice * 100.0D0 + 0.5D0)) AS s
  FROM {{lineitem}} GROUP BY l_linenumber % 3, {ARM}, l_suppkey, l_partkey % 50) AS q
""",
    # merged spectra in counts with several mask planes; standards from faint to bright
    "merged": f"""
SELECT visit, fiberId, pix, wavelength, flux, norm, mask, CASE WHEN pix % 17 = 0 THEN 0.0D0 ELSE floor((flux / snr) * (flux / snr)) END AS covar0
FROM (
  SELECT CAST(1000 + v AS INT) AS visit, CAST(f AS INT) AS fiberId, CAST(p AS INT) AS pix, 420.0D0 + p * 5.0D0 AS wavelength,
    (20000.0D0 + f % 1000 * 9.0D0 + p * 4.0D0 + s % 101) * (4.0D0 + (p * 7 + f * 3 + v) % 50 / 10.0D0) AS flux, 4.0D0 + (p * 7 + f * 3) % 50 / 10.0D0 AS norm,
    4.0D0 + (f * 5 + v * 7) % 29 + p % 5 / 10.0D0 AS snr,
    CAST(CASE WHEN (f + p) % 31 = 0 THEN 1 WHEN (f + p) % 31 = 7 THEN 8 WHEN (f + p) % 31 = 9 THEN 2 WHEN (f + p) % 31 = 11 THEN 256 ELSE 0 END + CASE WHEN p % 3 = 0 THEN 16384 ELSE 0 END AS INT) AS mask
  FROM (SELECT l_linenumber % 3 AS v, l_suppkey AS f, l_partkey % 100 AS p, sum(floor(l_extendedprice * 100.0D0 + 0.5D0)) AS s
    FROM {{lineitem}} GROUP BY l_linenumber % 3, l_suppkey, l_partkey % 100) AS g
) AS m
""",
    # exposure times, one visit unknown
    "shots": "SELECT CAST(1000 + l_linenumber % 3 AS INT) AS visit, 450.0D0 + 60.0D0 * (l_linenumber % 3) AS exptime FROM {lineitem} WHERE l_linenumber % 3 < 2 GROUP BY l_linenumber % 3",
    # what a stability job finds: norms missing for one visit and arm, one spectrograph missing in the first visit
    "lamp_datasets": f"""
SELECT 'spectra' AS dataset_type, 'MOS' AS instrument, CAST(1000 + l_linenumber % 3 AS INT) AS visit, {ARM} AS arm, CAST(1 + l_suppkey % 4 AS INT) AS spectrograph
FROM {{lineitem}} WHERE NOT (l_linenumber % 3 = 0 AND l_returnflag = 'N' AND l_suppkey % 4 = 1)
UNION SELECT 'config', 'MOS', CAST(1000 + l_linenumber % 3 AS INT), NULL, NULL FROM {{lineitem}}
UNION SELECT 'norms', 'MOS', CAST(1000 + l_linenumber % 3 AS INT), {ARM}, NULL FROM {{lineitem}} WHERE NOT (l_linenumber % 3 = 2 AND l_returnflag = 'R')
""",
    "lamp_headers": f"""
SELECT CAST(1000 + l_linenumber % 3 AS INT) AS visit, {ARM} AS arm, CAST(1 + l_suppkey % 4 AS INT) AS spectrograph,
  concat('2025-01-0', CAST(1 + l_linenumber % 3 AS STRING), 'T10:00:00') AS hst, CAST(max(l_linenumber) * 10 AS STRING) AS insrot, CAST(90 + l_linenumber % 3 AS STRING) AS azimuth
FROM {{lineitem}} GROUP BY l_linenumber % 3, {ARM}, 1 + l_suppkey % 4
""",
    # filter curves, five knots for each of five filters
    "filters": """
SELECT CASE n_nationkey % 5 WHEN 0 THEN 'g' WHEN 1 THEN 'r' WHEN 2 THEN 'i' WHEN 3 THEN 'z' ELSE 'y' END AS filter_name,
  405.0D0 + (n_nationkey % 5) * 55.0D0 + floor(n_nationkey / 5.0D0) * 15.0D0 AS wavelength,
  CASE WHEN n_nationkey < 5 OR n_nationkey >= 20 THEN 0.0D0 ELSE 0.8D0 END AS transmission
FROM {nation}
""",
    "exposures": "SELECT o_orderkey AS visit, o_orderdate AS time_exp_start, 300.0D0 + o_orderkey % 600 AS exptime FROM {orders}",
    # why a visit was taken
    "observations": """
SELECT CAST(1000 + o_orderkey % 4 AS INT) AS visit, CASE o_orderkey % 4 WHEN 1 THEN 'arc' WHEN 3 THEN 'trace' ELSE 'science' END AS observationReason FROM {orders} GROUP BY 1, 2
""",
    # several rows per visit; identical measurements are one row
    "telescope": """
SELECT l_orderkey AS visit, CAST(l_linenumber AS INT) AS seq, 30.0D0 + max(l_quantity) AS altitude, max(l_quantity) * 7.0D0 AS azimuth, max(l_tax) * 100.0D0 AS insrot
FROM {lineitem} GROUP BY l_orderkey, l_linenumber
""",
    # missing for some visits
    "environment": "SELECT o_orderkey AS visit, o_totalprice / 10000.0D0 AS outside_humidity FROM {orders} WHERE o_orderstatus <> 'P'",
    "headers": """
SELECT CAST(1000 + o_custkey AS INT) AS visit, CASE o_orderkey % 3 WHEN 0 THEN 'b' WHEN 1 THEN 'r' ELSE 'n' END AS arm,
  CAST(1 + o_orderkey % 4 AS INT) AS spectrograph, min(CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END) AS object,
  min(o_orderpriority) AS priority, CAST(max(o_totalprice) AS STRING) AS price
FROM {orders} GROUP BY 1, 2, 3
""",
    "seeing": "SELECT event_id AS agc_exposure_id, CAST(1000 + event_id % 4 AS INT) AS visit, 0.5D0 + value / 500.0D0 AS seeing_median FROM {events}",
    # missing for some exposures
    "transparency": "SELECT event_id AS agc_exposure_id, 1.0D0 - value / 1000.0D0 AS transparency_median FROM {events} WHERE event_type <> 'error'",
    # dataset catalogue; arm and spectrograph are NULL when the type lacks the dimension
    "datasets": """
SELECT 'spectra' AS dataset_type, 'MOS' AS instrument, CAST(1000 + o_custkey AS INT) AS visit, CASE o_orderkey % 3 WHEN 0 THEN 'b' WHEN 1 THEN 'r' ELSE 'n' END AS arm, CAST(1 + o_orderkey % 4 AS INT) AS spectrograph FROM {orders}
UNION SELECT 'config', 'MOS', CAST(1000 + o_custkey AS INT), NULL, NULL FROM {orders} WHERE o_orderpriority <> '1-URGENT'
UNION SELECT 'norms', 'MOS', CAST(1000 + o_custkey AS INT), CASE o_orderkey % 3 WHEN 0 THEN 'b' ELSE 'r' END, NULL FROM {orders}
""",
    # datasets of jobs, one job per (visit, arm), with some inconsistent ones
    "jobs": """
SELECT CAST(o_custkey AS INT) AS job, CASE WHEN o_orderstatus = 'P' THEN 'reference' WHEN o_orderstatus = 'O' THEN 'target' WHEN o_orderpriority = '1-URGENT' THEN 'config' ELSE 'norms' END AS role,
  CASE WHEN o_orderkey % 101 = 0 THEN 'OTHER' ELSE 'MOS' END AS instrument, CAST(1000 + CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS INT) AS visit,
  CASE WHEN o_orderkey % 29 = 0 THEN 'r' ELSE 'b' END AS arm, CAST(1 + o_orderkey % 4 AS INT) AS spectrograph
FROM {orders}
""",
    # arc lines that fall into two arms, with the same wavelength in both
    "overlap_lines": f"""
SELECT CAST(1000 + l_orderkey % 2 AS INT) AS visit, CASE WHEN l_linestatus = 'F' THEN 'r' ELSE 'n' END AS arm, CAST(1 + l_suppkey % 4 AS INT) AS spectrograph,
  CAST(l_suppkey AS INT) AS fiberId,
  CASE l_partkey % 8 WHEN 0 THEN 630.2D0 WHEN 1 THEN 636.55D0 WHEN 2 THEN 937.69D0 WHEN 3 THEN 942.23D0 WHEN 4 THEN 957.0D0 WHEN 5 THEN 980.24D0 WHEN 6 THEN 700.0D0 ELSE 800.0D0 END AS wavelength,
  l_extendedprice AS x, CASE WHEN l_quantity > 45.0D0 THEN NULL ELSE l_extendedprice / 40.0D0 END AS y, 0.1D0 AS xErr, 0.1D0 AS yErr, l_extendedprice AS flux, l_quantity AS fluxErr
FROM {{lineitem}}
""",
    # sampled wavelength calibration of both arms
    "calibration": """
SELECT arm, CAST(1 + f % 4 AS INT) AS spectrograph, CAST(f AS INT) AS fiberId, p * 30.0D0 AS row, 600.0D0 + p * 2.0D0 + (p * p) % 7 / 31.0D0 + k / 37.0D0 AS wavelength
FROM (SELECT CASE WHEN l_linestatus = 'F' THEN 'r' ELSE 'n' END AS arm, l_suppkey AS f, l_partkey % 100 AS p, max(l_linenumber) AS k
  FROM {lineitem} GROUP BY 1, 2, 3) AS c
""",
}

PROFILE_SPARK = """
SELECT CASE label % 4 WHEN 0 THEN 'b' WHEN 1 THEN 'r' WHEN 2 THEN 'm' ELSE 'n' END AS arm, CAST(1 + label % 4 AS INT) AS spectrograph, vec_id AS fiberId, {measures}
FROM {{embeddings}}
"""
MEASURES = ("centroid", "min", "max", "r90", "skew", "variation", "width", "wingFrac")
PROFILES = {
    "spark": PROFILE_SPARK.format(
        measures=", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS `{m}`" for i, m in enumerate(MEASURES))
    ),
    "duckdb": PROFILE_SPARK.format(
        measures=", ".join(f'CAST(embedding[{i + 1}] AS DOUBLE) AS "{m}"' for i, m in enumerate(MEASURES))
    ),
}
# all 64 components: eight values of each measure per vector
ALL_PROFILES_TEXT = PROFILE_SPARK.replace("FROM {{embeddings}}", "FROM (SELECT *, {numbers} AS k FROM {{embeddings}}) AS e")
ALL_PROFILES = {
    "spark": ALL_PROFILES_TEXT.format(
        numbers="explode(sequence(0, 7))", measures=", ".join(f"CAST(embedding[8 * k + {i}] AS DOUBLE) AS `{m}`" for i, m in enumerate(MEASURES))
    ),
    "duckdb": ALL_PROFILES_TEXT.format(
        numbers="unnest(range(8))", measures=", ".join(f'CAST(embedding[8 * k + {i + 1}] AS DOUBLE) AS "{m}"' for i, m in enumerate(MEASURES))
    ),
}
BY_ENGINE = {"profiles": PROFILES, "all_profiles": ALL_PROFILES}


def spark_text(text: str) -> str:
    return re.sub(r"(\d)D0\b", r"\1D", text)


def duckdb_text(text: str) -> str:
    text = re.sub(r"(\d)D0\b", r"\1::DOUBLE", text)
    text = re.sub(r"\bAS STRING\b", "AS VARCHAR", text)
    return re.sub(r"\{(\w+)\}", r"\1", text)


def ctes(*names: str) -> str:
    """WITH clause that defines the named views for DuckDB."""
    parts = []
    for n in names:
        text = BY_ENGINE[n]["duckdb"] if n in BY_ENGINE else VIEWS[n]
        parts.append(f"{n} AS ({duckdb_text(text).strip()})")
    return "WITH RECURSIVE " + ",\n".join(parts)


class Views:
    """The views over one folder of tables, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BY_ENGINE:
            text = BY_ENGINE[name]["spark"]
        elif name in VIEWS:
            text = VIEWS[name]
        else:
            raise AttributeError(name)
        used = {t: self.table(t) for t in TABLES if f"{{{t}}}" in text}
        return self.spark.sql(spark_text(text), **used)
