"""Quantiles, ranks and order statistics against numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fiberqa.operators.ordering import (
    average_rank,
    first_come_rank,
    group_stats,
    order_statistics,
    percent_rank_of,
    ranked,
    value_bin,
)
from fiberqa.operators.placement import sorted_ranges

ROWS = (
    [("a", float(x)) for x in (3, 1, 2, 2, 2, -7, 0)]
    + [("b", 5.5)]
    + [("c", None), ("c", None)]
    + [("d", x) for x in (1e-300, -1e-300, 1e300, -1e300, 0.0, 1e-9)]
    + [("e", 700.0 + i * 1e-9) for i in range(50)]
    + [("f", None), ("f", 1.0), ("f", 2.0)]
)


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "k string, x double")


def groups():
    out = {}
    for k, x in ROWS:
        out.setdefault(k, []).append(np.nan if x is None else x)
    return {k: np.array(v) for k, v in out.items()}


@pytest.mark.parametrize("p", [0.0, 0.05, 0.25, 0.5, 0.84, 1.0])
def test_quantile_is_numpys(df, size, p):
    got = {r["k"]: r["q"] for r in group_stats(df, ["k"], [F.count(F.lit(1)).alias("n")], {"q": ("x", p)}).collect()}
    for k, v in groups().items():
        v = v[~np.isnan(v)]
        if len(v) == 0:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(np.percentile(v, p * 100), rel=1e-12, abs=1e-15)


def test_no_keys_and_no_rows(df, size):
    whole = group_stats(df, [], [F.count("x").alias("n")], {"m": ("x", 0.5)}).collect()
    assert len(whole) == 1 and whole[0]["n"] == sum(x is not None for _, x in ROWS)
    nothing = group_stats(df.where("false"), [], [F.count("x").alias("n")], {"m": ("x", 0.5)}).collect()
    assert len(nothing) == 1 and nothing[0]["n"] == 0 and nothing[0]["m"] is None
    assert group_stats(df.where("false"), ["k"], quantiles={"m": ("x", 0.5)}).count() == 0


def test_missing_key_is_no_group(spark, size):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, x double")
    assert [r["k"] for r in group_stats(df, ["k"], quantiles={"m": ("x", 0.5)}).collect()] == ["a"]


def test_percent_rank_is_pandas(df, size):
    got = {(r["k"], r["x"]): r["p"] for r in percent_rank_of(df, ["k"], "x", "p").collect()}
    frame = pd.DataFrame(ROWS, columns=["k", "x"])
    want = frame.groupby("k").x.rank(pct=True) * 100
    for (k, x), w in zip(ROWS, want):
        assert got[(k, x)] == (None if np.isnan(w) else pytest.approx(w))


def test_ranks_keep_every_row(df, size):
    out = ranked(df, ["k"], "x").withColumn("r", average_rank())
    assert out.count() == len(ROWS)
    assert out.where("k = 'a'").agg(F.sum("r")).first()[0] == 28


def test_first_come_rank(spark, size):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("a", 2, "x"), ("b", 7, "q")], "k string, v int, t string")
    got = {(r["k"], r["v"], r["t"]): r["i"] for r in first_come_rank(df, ["k"], "v", ["t"], "i").collect()}
    assert got == {("a", 1, "z"): 1, ("a", 2, "x"): 2, ("a", 2, "y"): 3, ("b", 7, "q"): 1}


def test_order_statistics(df, size):
    out = order_statistics(df, ["k"], "x", {"first": lambda n: F.lit(0), "last": lambda n: n - 1, "none": lambda n: n})
    got = {r["k"]: r for r in out.collect()}
    for k, v in groups().items():
        v = np.sort(v[~np.isnan(v)])
        if len(v):
            assert (got[k]["first"], got[k]["last"], got[k]["none"], got[k]["n"]) == (v[0], v[-1], None, len(v))
        else:
            assert k not in got


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=60))
def test_bins_keep_the_order(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", value_bin(F.col("x")).alias("b")).collect()
    rows = sorted((r["x"], r["b"]) for r in rows)
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:]) if a[0] < b[0])


def test_hot_group_is_spread(spark):
    """A third of all rows in one group that no exposure bounds."""
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), F.rand(7).alias("x")
    )
    got = group_stats(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": ("x", 0.5)})
    hot = got.where("k = 0").first()
    want = df.where("k = 0").agg(F.percentile("x", F.lit(0.5)), F.count("x")).first()
    assert (hot["m"], hot["n"]) == (pytest.approx(want[0]), want[1])


@pytest.fixture
def small_ranges(spark):
    """Ranges as with large tables: adaptive execution would put these few rows together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_value_is_spread_over_ranges(spark, small_ranges):
    """Two thirds of all rows are one value of one group: no range of the sort holds them all, and ranks are pandas'."""
    df = spark.range(60_000).selectExpr("cast(id % 7 = 0 AS int) AS k", "IF(id % 3 = 0, double(id), 5.0D) AS x", "id")
    largest = sorted_ranges(df, [F.col("k").asc(), F.col("x").asc()]).groupBy(F.shiftright("__at", 33)).count().agg(F.max("count")).first()[0]
    assert largest < 20_000
    frame = df.toPandas()
    got = ranked(df, ["k"], "x").toPandas().set_index("id").sort_index()
    group = frame.groupby("k").x
    assert (got["below"].to_numpy() + 1 == group.rank(method="min").to_numpy()).all()
    assert (got["ties"].to_numpy() == frame.groupby(["k", "x"]).id.transform("size").to_numpy()).all()
    assert (got["n"].to_numpy() == group.transform("size").to_numpy()).all()
    places = first_come_rank(df, ["k"], "x", ["id"], "place").toPandas().set_index("id").sort_index()["place"]
    want = frame.sort_values(["k", "x", "id"]).groupby("k").cumcount() + 1
    assert (places.to_numpy() == want.sort_index().to_numpy()).all()


def test_missing_infinite_and_large_values(spark, size):
    nan, inf = float("nan"), float("inf")
    rows = [(1, v) for v in (1.0, 2.0, 3.0, 4.0, nan, inf, -inf, None)]
    frame = spark.createDataFrame(rows, "g int, x double")
    assert group_stats(frame, ["g"], quantiles={"m": ("x", 0.5)}).first()["m"] == 2.5
    below = {r["x"]: r["below"] for r in ranked(frame, ["g"], "x").collect()}
    assert {k: v for k, v in below.items() if k is not None} == {1.0: 0, 2.0: 1, 3.0: 2, 4.0: 3}
    big = spark.createDataFrame([(1, 2**53), (1, 2**53 + 1), (1, 2**53 + 1)], "g int, x long")
    assert sorted((r["x"], r["below"], r["ties"]) for r in ranked(big, ["g"], "x").collect()) == [(2**53, 0, 1), (2**53 + 1, 1, 2), (2**53 + 1, 1, 2)]
    text = spark.createDataFrame([(1, "pear"), (1, "apple"), (1, "applet"), (1, "apple")], "g int, x string")
    assert sorted((r["x"], r["below"]) for r in ranked(text, ["g"], "x").collect()) == [("apple", 0), ("apple", 0), ("applet", 2), ("pear", 3)]


def test_ranks_of_an_exposure_move_no_rows(spark):
    """Few values in a large group: the values are ranked, the rows stay where they are."""
    rows = [(1000, "b", i, float(i % 7)) for i in range(500)] + [(None, "b", -1, 2.0), (1000, "b", -2, None)]
    df = spark.createDataFrame(rows, "visit int, arm string, i int, x double")
    out = percent_rank_of(df, ["visit", "arm"], "x", "pct")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    got = {r["i"]: r["pct"] for r in out.collect()}
    want = pd.Series([x for _, _, _, x in rows[:500]]).rank(pct=True) * 100
    assert len(got) == 502 and got[-1] == 100.0 and got[-2] is None
    assert [got[i] for i in range(500)] == pytest.approx(list(want), rel=1e-12)
