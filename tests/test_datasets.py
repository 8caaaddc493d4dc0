"""One job over datasets that differ in kind, dispersion and softening."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiberqa.operators.lines import dispersion_at_center, exclusion_zone, line_stages
from fiberqa.plans import detmap

LINES = "visit int, arm string, spectrograph int, fiberId int, description string, wavelength double, x double, y double, xErr double, yErr double, xModel double, yModel double, flux double, fluxErr double, flag boolean, status int"


def line(visit, arm, wavelength, description="ArI", fiber=1, x=10.0, y=50.0, status=1):
    return (visit, arm, 1, fiber, description, wavelength, x, y, 0.1, 0.1, 10.0, None if description == "Trace" else 50.0, 5.0, 1.0, False, status)


def test_zones_with_a_radius_of_each_dataset(spark):
    rng = np.random.default_rng(5)
    radius = {("b", 1): 0.3, ("r", 1): 2.0, ("n", 1): None, ("m", 1): -1.0, ("b", 2): 0.01}
    waves = [(v, a, float(np.round(w, 2))) for (a, v) in radius for w in rng.uniform(-40, 60, 80)]
    lines = spark.createDataFrame([line(v, a, w) for v, a, w in waves], LINES)
    chosen = F.lit(None).cast("double")
    for (a, v), r in radius.items():
        chosen = F.when((F.col("arm") == a) & (F.col("visit") == v), F.lit(r).cast("double")).otherwise(chosen)
    got = {(r["visit"], r["arm"], r["wavelength"]): r["excluded"] for r in exclusion_zone(lines.repartition(7), ["visit", "arm", "spectrograph"], chosen).collect()}
    assert len(got) == len(set(waves))
    for v, a, w in set(waves):
        r = radius[a, v] or 0
        assert got[v, a, w] == any(w != o and abs(w - o) < r for u, b, o in waves if (u, b) == (v, a)), (v, a, w)


def test_one_radius_is_the_same_as_a_column_of_it(spark):
    lines = spark.createDataFrame([line(1, "b", w) for w in (500.0, 500.4, 501.0, 503.0, 503.49)], LINES)
    both = [sorted(map(tuple, exclusion_zone(lines, ["arm"], r).collect())) for r in (0.5, F.lit(0.5))]
    assert both[0] == both[1] and [r[-1] for r in both[0]] == [True, True, False, True, True]
    assert exclusion_zone(lines.limit(0), ["arm"], F.lit(0.5)).count() == 0


def test_traces_stay_in_science_visits_only(spark):
    rows = [line(v, "b", 500.0 + i) for v in (1, 2, 3) for i in range(3)] + [line(v, "b", 0.0, "Trace") for v in (1, 2, 3, 4)]
    reasons = spark.createDataFrame([(1, "science"), (2, "arc"), (4, "arc")], "visit int, observationReason string")
    lines = spark.createDataFrame(rows, LINES).withColumn("observationReason", F.lit("foreign"))
    staged = line_stages(detmap.with_observation(lines, reasons), is_science=F.col("isScience"))
    assert {r["visit"] for r in staged.where("ok_zone AND description = 'Trace'").collect()} == {1, 4}  # a dataset of traces alone keeps them
    assert staged.where("ok_zone AND description = 'ArI'").count() == 9
    for v, science in ((1, True), (2, False)):
        alone = line_stages(lines.where(F.col("visit") == v), is_science=science)
        kept = lambda df: sorted(map(repr, df.where("ok_zone").select("description", "wavelength").collect()))
        assert kept(alone) == kept(staged.where(F.col("visit") == v))


def test_residual_rows_of_both_kinds(spark):
    knots = [("b", 1, f, 10.0 * k, 400.0 + 10 * k * width) for f, width in ((1, 0.5), (2, 0.25), (3, 0.1)) for k in range(11)]
    calibration = spark.createDataFrame([*knots, ("b", 1, 2, None, 7.0)], "arm string, spectrograph int, fiberId int, row double, wavelength double")
    assert [tuple(r) for r in dispersion_at_center(calibration).collect()] == [("b", 1, pytest.approx(0.25))]
    waves = (500.0, 500.4, 502.0, 505.0)  # 0.4 apart are closer than two pixels of 0.25
    rows = [line(v, arm, w, fiber=f) for v in (1, 2) for arm in ("b", "r") for w in waves for f in (1, 3)]
    rows += [line(v, "b", 0.0, "Trace", fiber=3, status=3) for v in (1, 2)]
    reasons = spark.createDataFrame([(1, "science"), (2, "arc")], "visit int, observationReason string")
    out = detmap.residual_data(
        spark.createDataFrame(rows, LINES), observations=reasons, calibration=calibration, exclusion_pixels=2.0, status_names={"USED": 1, "RESERVED": 2}
    ).collect()
    lines_left = {(v, a): {r["wavelength"] for r in out if (r["visit"], r["arm"], r["isLine"]) == (v, a, True)} for v in (1, 2) for a in ("b", "r")}
    assert lines_left == {(1, "b"): {502.0, 505.0}, (2, "b"): {502.0, 505.0}, (1, "r"): set(waves), (2, "r"): set(waves)}  # arm r has no calibration
    traces = [r for r in out if r["isTrace"]]
    assert [(r["visit"], r["observationReason"], r["status_name"], r["status_type"]) for r in traces] == [(1, "science", "USED|RESERVED", "USED")]
    for r in out:
        assert r["dispersion"] == (None if r["arm"] == "r" else pytest.approx({1: 0.5, 3: 0.1}[r["fiberId"]]))


def test_softened_statistics_and_reasons(spark):
    rows = [line(v, "b", 500.0 + i, x=10.0 + 0.01 * i, y=50.0 - 0.02 * i) for v in (1, 2) for i in range(8)]
    lines = detmap.residual_data(spark.createDataFrame(rows, LINES), is_science=True)
    reasons = spark.createDataFrame([(1, "science")], "visit int, observationReason string")
    out = detmap.with_detector(detmap.fit_stats(lines, x_soften=0.3, y_soften=0.4), reasons).collect()
    assert {r["visit"]: r["observationReason"] for r in out} == {1: "science", 2: None}
    x, y = 0.01 * np.arange(8), -0.02 * np.arange(8)
    for r in out:
        assert r["chi2X"] == pytest.approx((x**2).sum() / (0.01 + 0.09)) and r["chi2Y"] == pytest.approx((y**2).sum() / (0.01 + 0.16))
        assert r["spatial"]["weightedRms"] == pytest.approx(np.sqrt((x**2).mean()))
