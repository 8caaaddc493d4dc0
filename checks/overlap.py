"""Queries on lines seen in two arms, and on interpolation."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.operators.interpolation import interpolate
from fiberqa.plans import overlap as O

from .registry import case

ARMS = ("r", "n")
LISTED = "('630.20', '636.55', '937.69', '937.85', '942.23', '947.94', '952.20', '957.00', '970.19', '972.25', '979.21', '979.38', '980.24')"
PAIRS = f"""m AS (SELECT visit, spectrograph, fiberId, wavelength, arm, min(y) AS y FROM overlap_lines WHERE y IS NOT NULL AND printf('%.2f', wavelength) IN {LISTED} GROUP BY ALL),
  pairs AS (SELECT a.visit, a.spectrograph, a.fiberId, a.wavelength, a.y AS y0, b.y AS y1 FROM m AS a JOIN m AS b ON a.arm = 'r' AND b.arm = 'n' AND a.visit = b.visit AND a.spectrograph = b.spectrograph AND a.fiberId = b.fiberId AND a.wavelength = b.wavelength)"""


def interp_sql(name: str, source: str, x: str, knots: str, keys: list[str], kx: str, ky: str, out: str) -> str:
    """Linear interpolation by as-of joins to the knots on both sides."""
    on = " AND ".join(f"g.{k} = k.{k}" for k in keys)
    using = ", ".join(keys)
    return f"""{name}_k AS (SELECT {using}, {kx} AS kx, {ky} AS ky FROM {knots} WHERE {ky} IS NOT NULL),
  {name}_lo AS (SELECT g.*, k.kx AS x0, k.ky AS y0_ FROM {source} AS g ASOF LEFT JOIN {name}_k AS k ON {on} AND g.{x} >= k.kx),
  {name}_hi AS (SELECT g.*, k.kx AS x1, k.ky AS y1_ FROM {name}_lo AS g ASOF LEFT JOIN {name}_k AS k ON {on} AND g.{x} <= k.kx),
  {name} AS (SELECT * EXCLUDE (x0, y0_, x1, y1_), CASE WHEN x0 IS NULL THEN y1_ WHEN x1 IS NULL THEN y0_ WHEN x0 = x1 THEN y0_ ELSE (y1_ - y0_) / (x1 - x0) * ({x} - x0) + y0_ END AS {out} FROM {name}_hi)"""


@case("line_keys", "P26", "overlap_lines", "SELECT printf('%.2f', wavelength) AS key, count(*) AS n FROM overlap_lines GROUP BY ALL")
def _(v):
    return v.overlap_lines.groupBy(S.wavelength_key("wavelength").alias("key")).agg(F.count(F.lit(1)).alias("n"))


@case("overlap_pairs", "Q12 J5 U2 F11", "overlap_lines", f"WITH {PAIRS} SELECT * FROM pairs", "wavelength y0 y1")
def _(v):
    return O.overlap_pairs(v.overlap_lines, ARMS)


CAL = f"""{PAIRS}, ca AS (SELECT * FROM calibration WHERE arm = 'r'), cb AS (SELECT * FROM calibration WHERE arm = 'n'),
  {interp_sql('i0', 'pairs', 'y0', 'ca', ['spectrograph', 'fiberId'], 'row', 'wavelength', 'w0')}, {interp_sql('i1', 'i0', 'y1', 'cb', ['spectrograph', 'fiberId'], 'row', 'wavelength', 'w1')},
  calibrated AS (SELECT *, w0 - w1 AS difference FROM i1)"""


@case("overlap_wavelengths", "Q12 A1", "overlap_lines calibration", f"WITH {CAL} SELECT * FROM calibrated", "wavelength y0 y1 w0 w1 difference")
def _(v):
    return O.wavelength_at_row(O.overlap_pairs(v.overlap_lines, ARMS), v.calibration, ARMS)


@case(
    "overlap_stats", "Q12 G34", "overlap_lines calibration",
    f"WITH {CAL} SELECT visit, spectrograph, wavelength, count(DISTINCT fiberId) AS fibers, count(*) AS pairs, median(difference) AS median, (quantile_cont(difference, 0.75) - quantile_cont(difference, 0.25)) / 1.349 AS sigma FROM calibrated GROUP BY visit, spectrograph, wavelength",
    "wavelength median sigma",
)
def _(v):
    return O.overlap_stats(O.wavelength_at_row(O.overlap_pairs(v.overlap_lines, ARMS), v.calibration, ARMS))


@case(
    "interpolated_calibration", "A1 P29", "lines calibration",
    f"WITH g AS (SELECT arm, spectrograph, fiberId, y AS row, count(*) AS n FROM lines GROUP BY ALL), kn AS (SELECT * FROM calibration), {interp_sql('i', 'g', 'row', 'kn', ['arm', 'spectrograph', 'fiberId'], 'row', 'wavelength', 'wavelength')} SELECT * FROM i",
    "row wavelength",
)
def _(v):
    keys = ["arm", "spectrograph", "fiberId"]
    grid = v.lines.groupBy(*keys, F.col("y").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    return interpolate(grid, v.calibration.select(*keys, "row", "wavelength"), keys, "row", "wavelength")
