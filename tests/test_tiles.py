"""Windows cut out of image rows against a lookup of every pixel."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiberqa.operators.tiles import image_tiles, trace_windows
from fiberqa.plans import extraction


def test_windows_are_the_looked_up_pixels(spark):
    rng = np.random.default_rng(3)
    known = {(k, int(x), int(y)): float(v) for k in ("a", "b") for x, y, v in zip(rng.integers(-2, 30, 300), rng.integers(0, 12, 300), rng.random(300))}
    image = spark.createDataFrame([(*p, v) for p, v in known.items()], "k string, x int, y int, image double").repartition(5)
    traces = [(k, f, y, float(rng.uniform(-6, 36))) for k in ("a", "b", "none") for f in range(9) for y in range(14)]
    trace = spark.createDataFrame(traces, "k string, fiberId int, y int, xCenter double")
    got = extraction.trace_window(trace, image, ["k"], half=2).collect()
    assert len(got) == 5 * len(traces)
    for r in got:
        assert r["x"] == int(np.rint(r["xCenter"])) + r["dx"]
        assert (r["image"], r["inImage"]) == (known.get((r["k"], r["x"], r["y"])), (r["k"], r["x"], r["y"]) in known)


def test_stored_tiles_give_the_same_windows(spark, tmp_path):
    image = spark.range(400).select((F.col("id") % 40).cast("int").alias("x"), F.floor(F.col("id") / 40).cast("int").alias("y"), F.col("id").cast("double").alias("image"), F.lit(0).alias("mask"))
    trace = spark.createDataFrame([(f, y, f * 7.5) for f in range(6) for y in range(10)], "fiberId int, y int, xCenter double")
    image_tiles(image, []).write.parquet(str(tmp_path / "tiles"))
    stored = spark.read.parquet(str(tmp_path / "tiles"))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(extraction.trace_window(trace, stored, [])) == rows(extraction.trace_window(trace, image, []))


def test_gaps_repeats_nulls_and_clashing_columns(spark):
    image = spark.createDataFrame([(5, 0, 2.0, "p"), (5, 0, 1.0, "q"), (9, 0, 3.0, "r"), (None, 0, 4.0, "s"), (1, None, 5.0, "t")], "x int, y int, image double, tile_name string")
    (row,) = image_tiles(image, [], ["image"]).collect()
    assert (row["first"], [p and p["image"] for p in row["tile"]]) == (5, [1.0, None, None, None, 3.0])
    trace = spark.createDataFrame([(1, 0, 8.0), (1, 0, 8.0), (2, 3, 8.0), (3, None, 8.0), (4, 0, None)], "fiberId int, y int, xCenter double")
    got = trace_windows(trace, image_tiles(image, [], ["image"]), [], 1).collect()
    seen = sorted((r["fiberId"], tuple(p and p["image"] for p in r["window"])) for r in got)
    assert seen == [(1, (None, None, 3.0)), (1, (None, None, 3.0)), *[(f, (None,) * 3) for f in (2, 3, 4)]]
    assert trace_windows(trace.limit(0), image_tiles(image.limit(0), []), [], 1).count() == 0


def test_no_join_on_columns_of_the_image(spark):
    trace = spark.createDataFrame([(1, 0, 8.0)], "fiberId int, y int, xCenter double")
    image = spark.createDataFrame([(8, 0, 1.0)], "x int, y int, image double")
    plan = extraction.trace_window(trace, image, [])._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "Join " in line]
    assert "x#" not in join and "y#" in join


def test_fiber_statistics_take_center_flux_and_type(spark):
    ds = "visit int, arm string, spectrograph int"
    trace = spark.createDataFrame([(v, "b", 1, f, y, 10.0 * f + 0.2 * y) for v in (1, 2) for f in (1, 2, 3, 4) for y in range(6)], f"{ds}, fiberId int, y int, xCenter double")
    image = spark.createDataFrame([(v, "b", 1, x, y, 100.0 + x, 90.0, 4.0, int((x, y) == (10, 0))) for v in (1, 2) for x in range(50) for y in range(6)], f"{ds}, x int, y int, image double, model double, variance double, mask int")
    spectra = spark.createDataFrame([(v, "b", 1, f, p, flux) for v in (1, 2) for f in (1, 2) for p, flux in enumerate((1.0 * v, 2.0 * f, None))], f"{ds}, fiberId int, pix int, flux double")
    kinds = [(1, 1, "SCIENCE", "GOOD"), (1, 2, "ENGINEERING", "GOOD"), (1, 3, "SKY", "GOOD"), (1, 4, "SKY", "BROKENFIBER"), (2, 2, "FLUXSTD", "GOOD")]
    fibers = spark.createDataFrame([(v, 1, f, t, s) for v, f, t, s in kinds], "visit int, spectrograph int, fiberId int, targetType string, fiberStatus string")
    got = {(r["visit"], r["fiberId"]): r for r in extraction.fiber_window_stats(trace, image, spectra, fibers).collect()}
    assert {k: (r["targetType"], r["pfsArmAve"]) for k, r in got.items()} == {(1, 1): ("SCIENCE", 1.5), (1, 3): ("SKY", None), (2, 2): ("FLUXSTD", 3.0)}
    assert got[1, 1]["xa"] == pytest.approx(10.5)
    pixels = [(x, y) for y in range(6) for x in range(int(np.rint(10 + 0.2 * y)) - 3, int(np.rint(10 + 0.2 * y)) + 4) if (x, y) != (10, 0)]
    assert got[1, 1]["imAve"] == pytest.approx(np.mean([100.0 + x for x, _ in pixels]))
    assert got[1, 1]["chiSquare"] == pytest.approx(np.mean([((10.0 + x) / 2) ** 2 for x, _ in pixels]))
