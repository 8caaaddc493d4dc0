"""Spectra as arrays, and aggregates that a caller hands in, on small tables against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiberqa.operators.spectra import running_median, spectrum_stats
from fiberqa.operators.summaries import summarise
from fiberqa.plans import fluxcal, sky

ROWS = [
    (1, [3.0, None, 1.0, float("nan"), 2.0]),
    (2, []),
    (3, None),
    (4, [5.0]),
    (5, [None, None]),
    (6, [1.0, 1.0, 4.0, float("inf")]),
]


def test_statistics_of_arrays(spark):
    rows = spark.createDataFrame(ROWS, "k int, v array<double>")
    out = {r["k"]: r for r in spectrum_stats(rows, "v", {"q": 0.25, "m": 0.5}, "mean", "sd").collect()}
    assert rows.columns == ["k", "v"] and set(out) == {1, 2, 3, 4, 5, 6}
    for k, values in ((1, [1, 2, 3]), (4, [5]), (6, [1, 1, 4])):
        assert (out[k]["q"], out[k]["m"], out[k]["mean"]) == (np.percentile(values, 25), np.median(values), np.mean(values))
    assert out[1]["sd"] == 1.0 and out[4]["sd"] is None and out[6]["sd"] == pytest.approx(np.std([1, 1, 4], ddof=1))
    for k in (2, 3, 5):
        assert (out[k]["q"], out[k]["m"], out[k]["mean"], out[k]["sd"]) == (None, None, None, None)


def test_running_median_over_gaps_in_any_order(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(20):
        p = rng.choice(400, 60, replace=False) - 100
        rows.append((k, [int(x) for x in p], [None if rng.random() < 0.1 else float(x) for x in rng.normal(size=60)]))
    rows += [(20, [], []), (21, None, None), (22, [10**12, 5], [1.0, 2.0])]
    df = spark.createDataFrame(rows, "k int, p array<bigint>, v array<double>").repartition(3)
    got = {r["k"]: r["m"] for r in df.select("k", running_median("p", "v", 5).alias("m")).collect()}
    for k, p, v in rows[:20]:
        at = dict(zip(p, v))
        assert got[k] == [float(np.median([at.get(x + d) or 0.0 for d in range(-2, 3)])) for x in p]
    assert got[20] == [] and got[21] is None and got[22] == [0.0, 0.0]
    with pytest.raises(ValueError):
        running_median("p", "v", 4)


def test_no_shuffle_over_stored_arrays(spark, tmp_path):
    one = spark.range(4).selectExpr(
        "id AS fiberId", "1 AS visit", "array(850D, 860D, 900D) AS wavelength", "array(4D, 6D, 1D) AS flux", "array(1D, 1D, 1D) AS sky",
        "array(4D, 4D, 4D) AS covar0", "array(4D, 4D, 0D) AS variance", "array(0, 0, 0) AS mask", "array(1, 2, 3) AS pix",
    )
    one.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for df in (fluxcal.fiber_sn_of_arrays(stored), sky.chi_stats_of_arrays(stored), stored.select(running_median("pix", "flux"))):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r["SN"] for r in fluxcal.fiber_sn_of_arrays(stored).collect()} == {2.5}
    assert {r["fiberChiMean"] for r in sky.chi_stats_of_arrays(stored).collect()} == {2.5}


@pytest.mark.parametrize("bounded", [True, False])
def test_given_aggregates(spark, bounded):
    values = {"a": [1.0, 2.0, 10.0, None], "b": [None], "c": [7.0, 7.0]}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [(None, 3.0)], "k string, v double")
    out = summarise(df, ["k"], "v", {"high": 0.9, "n": F.count, "span": lambda c: F.max(c) - F.min(c), "mid": 0.5}, bounded)
    assert out.columns == ["k", "high", "n", "span", "mid"]
    got = {r["k"]: tuple(r)[1:] for r in out.collect()}
    assert set(got) == {"a", "b", "c"} and got["b"] == (None, 0, None, None)
    assert got["a"] == (pytest.approx(np.percentile([1, 2, 10], 90)), 3, 9.0, 2.0) and got["c"] == (7.0, 2, 0.0, 7.0)


def test_wrong_aggregates(spark):
    df = spark.range(1).selectExpr("1 AS k", "1D AS v")
    with pytest.raises(ValueError, match="probability"):
        summarise(df, ["k"], "v", {"q": 90.0})
    with pytest.raises(ValueError, match="no aggregate"):
        summarise(df, ["k"], "v", {})
