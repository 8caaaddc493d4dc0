"""Edge cases of the other operators."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fiberqa.functions import scalars as S
from fiberqa.functions import stats as T
from fiberqa.operators import binning as B
from fiberqa.operators import reshape as R
from fiberqa.operators.interpolation import interpolate
from fiberqa.operators.lines import exclusion_zone, good_lines
from fiberqa.operators.normalization import normalize_2d
from fiberqa.operators.photometry import choose_filters, synth_flux
from fiberqa.operators.sampling import sample_fibers, split_fibers
from fiberqa.operators.windows import mean_of_others, median_filter, median_of_others
from fiberqa.plans import detmap, extraction, norms
from fiberqa.sources import catalog, sinks
from fiberqa.sources.frames import cut, finite, load


def one(df):
    return df.first().asDict()


def test_nan_and_infinity_become_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (-float("inf"), 3), (2.0, 4)], "x double, i int")
    assert [r["x"] for r in finite(df).orderBy("i").collect()] == [None, None, None, 2.0]


def test_weighted_rms_counts_weight_of_missing_residuals(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (2.0, 0.0)], "r double, e double")
    out = one(df.agg(T.weighted_rms("r", "e").alias("w"), T.chi2("r", "e").alias("c")))
    assert out["w"] == pytest.approx(math.sqrt(0.5)) and out["c"] == 1.0
    assert one(df.where("false").agg(T.weighted_rms("r", "e").alias("w"), T.chi2("r", "e").alias("c"))) == {"w": None, "c": 0.0}


def test_class_limits(spark):
    df = spark.createDataFrame([(2.9,), (3.0,), (-10.0,), (10.1,), (None,)], "x double")
    out = [r[0] for r in df.select(S.threshold_class("x")).collect()]
    assert out == ["< 3", "3 < x < 10", "3 < x < 10", "> 10", None]
    classes = [r[0] for r in df.select(S.range_class("x", 3.0, 10.0)).collect()]
    assert classes == ["under", "inside", "under", "over", None]
    assert [r[0] for r in df.select(S.clamp("x", 3.0, 10.0)).collect()] == [3.0, 3.0, 3.0, 10.0, None]


def test_hawaii_time_over_midnight_and_month(spark):
    df = spark.createDataFrame([("2024-03-01T05:00:00.987",), ("2024-03-01T23:59:59.949Z",)], "t string")
    out = [r[0] for r in df.select(S.utc_to_hawaii("t")).collect()]
    assert out == ["2024-02-29T19:00:00.9", "2024-03-01T13:59:59.9"]


def test_both_status_bits_mean_used(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "s int")
    assert [r[0] for r in df.select(S.status_type("s")).collect()] == ["USED", "RESERVED", "USED", None]


def test_bins_of_constant_and_edges(spark):
    df = spark.createDataFrame([("c", 5.0), ("c", 5.0), *[("v", float(i)) for i in range(11)]], "k string, x double")
    out = B.equal_width_bin(df, ["k"], "x", 10, "b")
    assert [r["b"] for r in out.where("k = 'c'").collect()] == [1, 1]
    got = [r["b"] for r in out.where("k = 'v'").orderBy("x").collect()]
    assert got == [int(c) + 1 for c in pd.cut(np.arange(11.0), 10, labels=False)]


@pytest.mark.parametrize("step", [0.1, 1.0, 4.0])
def test_step_bins_are_pandas(spark, step):
    x = np.array([1.0, 1.05, 2.5, 3.0, 7.2, 9.9, 10.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = [r["b"] for r in B.step_bin(df, [], "x", step, "b").orderBy("x").collect()]
    want = pd.cut(x, bins=np.arange(x.min() - 1, x.max() + 1, step), labels=False)
    assert got == [None if np.isnan(w) else int(w) for w in want]


def test_histogram_is_numpys(spark):
    rng = np.random.default_rng(1)
    x = np.append(rng.normal(0, 2, 500), [5.0, -5.0, 5.1])
    df = spark.createDataFrame([("a", float(v)) for v in x], "k string, x double")
    out = B.with_normal(B.histogram(df, ["k"], "x", 30, -5, 5, density=True)).orderBy("bin").toPandas()
    assert list(out["count"]) == list(np.histogram(x, 30, (-5, 5))[0])
    assert np.allclose(out["density"], np.histogram(x, 30, (-5, 5), density=True)[0])
    assert out["normal"].max() < 0.4


def test_interpolation_is_numpys(spark, size):
    rng = np.random.default_rng(2)
    knots = np.sort(rng.uniform(400, 1000, 80))
    values = rng.normal(size=80)
    grid = np.concatenate([rng.uniform(300, 1100, 200), knots[:5], [100.0, 5000.0]])
    k = spark.createDataFrame([("a", float(x), float(y)) for x, y in zip(knots, values)], "k string, x double, y double")
    g = spark.createDataFrame([("a", float(x)) for x in grid] + [("none", 1.0)], "k string, x double")
    out = {(r["k"], r["x"]): r["y"] for r in interpolate(g, k, ["k"], "x", "y").collect()}
    assert out.pop(("none", 1.0)) is None
    assert all(y == pytest.approx(np.interp(x, knots, values)) for (_, x), y in out.items()) and len(out) == len(set(grid))


@pytest.mark.parametrize("chunk", [16, 512])
def test_median_filter_pads_with_zeros(spark, chunk):
    rng = np.random.default_rng(4)
    x = rng.uniform(1, 9, 100)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "k string, p int, x double")
    got = [r["m"] for r in median_filter(df, ["k"], "p", "x", "m", 15, chunk).orderBy("p").collect()]
    padded = np.concatenate([np.zeros(7), x, np.zeros(7)])
    assert got == [float(np.median(padded[i : i + 15])) for i in range(100)]


def test_others(spark, size):
    rng = np.random.default_rng(6)
    rows = [("n%d" % n, i, float(v)) for n in range(1, 9) for i, v in enumerate(rng.integers(0, 4, n))]
    rows += [("null", 0, None), ("null", 1, 1.0), ("null", 2, 5.0)]
    df = spark.createDataFrame(rows, "k string, i int, x double")
    out = mean_of_others(median_of_others(df, ["k"], "x", "med"), ["k"], "x", "mean")
    for r in out.collect():
        rest = [x for k, i, x in rows if k == r["k"] and i != r["i"] and x is not None]
        assert r["med"] == (np.median(rest) if rest else None)
        assert r["mean"] == (pytest.approx(np.mean(rest)) if rest else None)


def test_normalized_columns_have_median_near_one(spark, size):
    rng = np.random.default_rng(8)
    rows = [("a", i, j, float((1 + i / 100) * (5 + j / 100) * rng.normal(1, 0.01))) for i in range(21) for j in range(31)]
    df = spark.createDataFrame(rows, "g string, i int, j int, v double")
    out = normalize_2d(df, ["g"], "i", "j", "v", "r").toPandas()
    wide = out.pivot(index="i", columns="j", values="v")
    m = wide.to_numpy()
    want = m / (np.median(m, 0, keepdims=True) * np.median(m, 1, keepdims=True) / np.median(m))
    assert np.allclose(out.pivot(index="i", columns="j", values="r").to_numpy(), want)
    assert np.allclose(out.groupby("j").r.median(), 1, atol=0.02)


def test_exclusion_zone_is_the_pair_rule(spark):
    rng = np.random.default_rng(9)
    w = np.unique(np.round(rng.uniform(600, 640, 60), 2))
    df = spark.createDataFrame([("v", "ArI", float(x), 1) for x in w] + [("v", "Trace", 601.0, 4)], "k string, description string, wavelength double, status int")
    got = {r["wavelength"]: r["excluded"] for r in exclusion_zone(df, ["k"], 0.5).collect()}
    assert got == {x: bool(np.any((np.abs(w - x) < 0.5) & (w != x))) for x in w}


def line_rows(spark, rows):
    schema = ("visit int, arm string, spectrograph int, fiberId int, wavelength double, description string, x double, y double, "
              "xErr double, yErr double, flux double, fluxErr double, flag boolean, status int, slope double")
    return spark.createDataFrame(rows, schema)


def test_traces_stay_where_there_are_only_traces(spark):
    base = (1.0, 1.0, 0.1, 0.1, 10.0, 1.0, False, 1)
    rows = [(1, "b", 1, 1, 600.0, "Trace", *base, 0.1), (1, "b", 1, 1, 600.0, "Trace", *base, None),
            (2, "b", 1, 1, 600.0, "Trace", *base, 0.1), (2, "b", 1, 1, 600.0, "ArI", *base, None)]
    good = good_lines(line_rows(spark, rows)).collect()
    assert sorted((r["visit"], r["description"]) for r in good) == [(1, "Trace"), (2, "ArI")]
    assert good_lines(line_rows(spark, rows), is_science=True).count() == 3


def test_split_is_disjoint_complete_and_never_empty(spark, size):
    rows = [(g, f, p) for g, n in (("a", 40), ("b", 3), ("c", 1)) for f in range(n) for p in range(2)]
    df = spark.createDataFrame(rows, "g string, fiberId int, p int")
    out = split_fibers(df, ["g"]).toPandas()
    assert len(out) == len(rows)
    assert (out.groupby(["g", "fiberId"]).isReference.nunique() == 1).all()
    assert out[out.isReference].groupby("g").fiberId.nunique().to_dict() == {"a": 4, "b": 1, "c": 1}
    with pytest.raises(ValueError):
        split_fibers(df, ["g"], fraction=1.0)


def test_samples_repeat(spark):
    df = spark.range(100).select(F.lit("a").alias("g"), F.col("id").cast("int").alias("fiberId"))
    first = sample_fibers(df, ["g"], 10, seed=1).toPandas().fiberId
    assert sorted(first) == sorted(sample_fibers(df, ["g"], 10, seed=1).toPandas().fiberId) and len(set(first)) == 10
    assert sorted(first) != sorted(sample_fibers(df, ["g"], 10, seed=2).toPandas().fiberId)


def test_different_block_size_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, 20), ("a", 2, 20), ("b", 1, 20)], "v string, arm int, blockSize int")
    assert R.same_value_or_error(df, ["v"], "blockSize").count() == 3
    bad = df.union(spark.createDataFrame([("b", 2, 10)], df.schema))
    with pytest.raises(Exception, match="blockSize"):
        R.same_value_or_error(bad, ["v"], "blockSize").count()


def test_arrays_there_and_back(spark):
    df = spark.createDataFrame([("a", p, float(p * p)) for p in range(5)], "k string, p int, f double")
    packed = R.arrays_of_rows(df, ["k"], "p", ["f"])
    assert packed.first()["f"] == [0.0, 1.0, 4.0, 9.0, 16.0]
    assert R.rows_of_arrays(packed, ["f"], "p").count() == 5


def test_groups_are_checked(spark):
    rows = [("spectra", "m", 1, "b", 1), ("spectra", "m", 1, "b", 2), ("config", "m", 1, None, None), ("norms", "m", 1, "b", None),
            ("spectra", "m", 2, "b", 1), ("norms", "m", 2, "b", None)]
    df = spark.createDataFrame(rows, "dataset_type string, instrument string, visit int, arm string, spectrograph int")
    types = {"config": ["instrument", "visit"], "spectra": ["instrument", "visit", "arm", "spectrograph"], "norms": ["instrument", "visit", "arm"]}
    by = ["instrument", "visit", "arm"]
    groups = catalog.require_groups(catalog.dataset_groups(df, types, by, ["spectra"])).collect()
    assert [(r["visit"], r["n_spectra"]) for r in groups] == [(1, 2)]
    with pytest.raises(RuntimeError, match="spectra"):
        catalog.require_groups(catalog.dataset_groups(df, types, by))
    with pytest.raises(RuntimeError, match="no dataset"):
        catalog.require_groups(catalog.dataset_groups(df.where("visit = 2"), types, by, ["spectra"]))


def test_broken_jobs_are_reported(spark):
    ok = [(1, r, "m", v, "b", s) for r, v in (("target", 5), ("reference", 4)) for s in (1, 2)] + [(1, "config", "m", 5, None, None), (1, "norms", "m", 5, "b", None)]
    bad = [(2, "target", "m", 5, "b", 1), (2, "target", "m", 6, "b", 1), (2, "reference", "m", 4, "r", 2)]
    df = spark.createDataFrame(ok + bad, "job int, role string, instrument string, visit int, arm string, spectrograph int")
    got = {(r["job"], r["violation"]) for r in catalog.validate_groups(df).collect()}
    assert got == {(2, "visit"), (2, "arm"), (2, "duplicate spectrograph"), (2, "spectrograph set")}


def test_filter_choice(spark):
    ps1 = ["g_ps1", "r_ps1", "i_ps1", "z_ps1", "y_ps1"]
    rows = [(1, 1, "FLUXSTD", ps1), (1, 2, "FLUXSTD", ["i_ps1"]), (2, 1, "FLUXSTD", ["g_gaia", "bp_gaia", "rp_gaia"]),
            (3, 1, "FLUXSTD", ["i_ps1", "g_ps1", "z_ps1"]), (4, 1, "FLUXSTD", ["i_ps1"]), (5, 1, "FLUXSTD", ["g_ps1"]), (6, 1, "SKY", ps1)]
    df = spark.createDataFrame(rows, "visit int, fiberId int, targetType string, filterNames array<string>")
    got = {r["visit"]: (r["fluxFilter"], r["colorFilter1"], r["colorFilter2"], r["noColor"]) for r in choose_filters(df).collect()}
    assert got == {1: ("i_ps1", "g_ps1", "i_ps1", False), 2: ("g_gaia", "bp_gaia", "rp_gaia", False), 3: ("i_ps1", "g_ps1", "z_ps1", False),
                   4: ("i_ps1", "i_ps1", "i_ps1", True), 5: (None, None, None, False)}


def test_flat_spectrum_has_its_own_flux(spark):
    spectra = spark.createDataFrame([(1, 400.0 + i * 0.7, 3.0) for i in range(300)], "fiberId int, wavelength double, flux double")
    curve = spark.createDataFrame([("g", 450.0, 0.0), ("g", 470.0, 0.9), ("g", 520.0, 0.0), ("far", 9000.0, 0.0), ("far", 9100.0, 1.0)], "filter_name string, wavelength double, transmission double")
    out = synth_flux(spectra, curve, ["fiberId"]).collect()
    assert [(r["filter_name"], pytest.approx(r["synthFlux"])) for r in out] == [("g", 3.0)]


def test_window_at_the_image_edge(spark):
    trace = spark.createDataFrame([(7, 0, 0.5)], "fiberId int, y int, xCenter double")
    image = spark.createDataFrame([(x, 0, 1.0) for x in range(10)], "x int, y int, image double")
    out = extraction.trace_window(trace, image, []).orderBy("dx").collect()
    assert [(r["x"], r["inImage"]) for r in out] == [(-3, False), (-2, False), (-1, False), (0, True), (1, True), (2, True), (3, True)]


def test_report_needs_no_fiber_to_be_observed(spark):
    sigma = spark.createDataFrame([(1, "b", 1, 10, 0.02, 0.02)], "visit int, arm string, spectrograph int, fiberId int, sigma double, sigma_std double")
    fibers = spark.createDataFrame([(10, "U1-2-3-4"), (11, "D1-2-3-4")], "fiberId int, mtp_A string")
    table = norms.fiber_table(sigma, fibers)
    assert {(r["fiberId"], r["SM"], r["mtpGroup"]) for r in table.collect()} == {(10, 1, "U1-2-3"), (11, 0, "D1-2-3")}
    assert norms.odd_fibers(table).count() == 1


def test_detector_order(spark):
    df = spark.createDataFrame([("n1",), ("b2",), ("r4",), ("b1",), ("m3",)], "ccd string")
    assert [r["ccd"] for r in df.orderBy(detmap.ccd_position()).collect()] == ["b1", "b2", "r4", "m3", "n1"]


def test_tables_are_partitioned_and_pruned(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 4).alias("visit"), F.lit("b").alias("arm"), (F.col("id") * 1.5).alias("v"))
    path = str(tmp_path / "t")
    sinks.write_table(df, path)
    read = load(spark, path, "visit in (1, 2)")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 50 and "PartitionFilters: [" in plan and "visit" in plan.split("PartitionFilters: [")[1].split("]")[0]
    sinks.write_csv(df, str(tmp_path / "c"))
    sinks.write_json(df, str(tmp_path / "j"), drop=("v",))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 100
    assert spark.read.json(str(tmp_path / "j")).columns == ["arm", "visit"]


def test_cut_is_readable_and_small(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    again = cut(df)
    assert again.schema.names == ["i", "s"] and again.collect() == df.collect()
