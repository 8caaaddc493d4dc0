"""Clipping and softening against short numpy versions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiberqa.operators import ranges
from fiberqa.operators.clipping import clip_limits, sigma_clip, soften_fit
from fiberqa.operators.ordering import LARGEST_EXPONENT


def numpy_clip(x, sigma=3.0, rounds=5):
    out = np.isnan(x)
    for _ in range(rounds):
        kept = x[~out]
        if len(kept) == 0:
            break
        mid, sd = np.median(kept), np.std(kept)
        out = out | (x < mid - sigma * sd) | (x > mid + sigma * sd)
    return out


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    rows = []
    for k in ("a", "b", "c"):
        x = rng.normal(0, 1, 300)
        x[::20] *= 15
        rows += [(k, i, float(v)) for i, v in enumerate(x)]
    rows += [("missing", 0, None), ("missing", 1, None), ("one", 0, 4.0), ("same", 0, 2.0), ("same", 1, 2.0), ("b", 999, None)]
    return rows


def test_flags_are_numpys(spark, size, sample):
    df = spark.createDataFrame(sample, "k string, i int, x double")
    got = {(r["k"], r["i"]): r["o"] for r in sigma_clip(df, ["k"], {"x": "o"}).collect()}
    assert len(got) == len(sample)
    for k in {r[0] for r in sample}:
        own = [(i, x) for kk, i, x in sample if kk == k]
        want = numpy_clip(np.array([np.nan if x is None else x for _, x in own]))
        assert [got[(k, i)] for i, _ in own] == list(want)


def test_clipping_again_changes_nothing(spark, size, sample):
    df = spark.createDataFrame(sample, "k string, i int, x double")
    once = sigma_clip(df, ["k"], {"x": "o"}, rounds=20).where("not o").drop("o")
    assert sigma_clip(once, ["k"], {"x": "o"}).where("o").count() == 0


def test_value_on_the_limit_stays(spark, size):
    # Median 0 and deviation 1 after the first round, so 3 lies exactly on the limit.
    values = [0.0] * 16 + [3.0, -3.0]
    assert np.std(values) == 1.0
    df = spark.createDataFrame([("a", v) for v in values], "k string, x double")
    limits = clip_limits(df, ["k"], ["x"], rounds=1).first()
    assert (limits["x_lo"], limits["x_hi"]) == (-3.0, 3.0)
    assert sigma_clip(df, ["k"], {"x": "o"}, rounds=1).where("o").count() == 0


@pytest.mark.parametrize("tasks", [1, 7])
def test_limit_does_not_depend_on_tasks(spark, size, tasks):
    """Outer values that lie on the limit, in 200 groups: the same flags in every order and number of tasks."""
    rng = np.random.default_rng(8)
    rows = [(k, i, float(c + d)) for k, (c, v) in enumerate(zip(rng.normal(0, 3, 200), rng.uniform(0.1, 2, 200))) for i, d in enumerate([0.0] * 16 + [v, -v])]
    df = spark.createDataFrame(rows, "k int, i int, x double")
    flags = [
        {(r["k"], r["i"]): r["o"] for r in sigma_clip(d, ["k"], {"x": "o"}, rounds=1).collect()}
        for d in (df.repartition(tasks, "i"), df.orderBy(F.col("i").desc()).coalesce(1))
    ]
    assert flags[0] == flags[1] and len(flags[0]) == 3600


@pytest.mark.parametrize("kind", range(6))
def test_limits_from_ranges_are_exact(kind):
    """The rounds on tables of ranges against rounds on all values with exact sums."""
    rng = np.random.default_rng(kind)
    for n in (1, 2, 3, 40, 300):
        x = [rng.normal(0, 1, n), rng.standard_t(1.5, n), 700 + rng.normal(0, 1e-9, n), rng.integers(-3, 4, n).astype(float),
             rng.normal(0, 1, n) * 1e-5 + 3, rng.choice([0, 1e300, -1e-300, 5.0], n)][kind]
        found: dict = {}
        for v in x.tolist():
            power = math.frexp(v)[1] - 1
            places = int((Fraction(abs(v)) / Fraction(2) ** power - 1) * 2**52)
            number = 0 if v == 0 else int(math.copysign((power + LARGEST_EXPONENT) * ranges.PER_OCTAVE + (places >> 52 - ranges.BITS), v))
            m = 0 if v == 0 else places % (1 << 52 - ranges.BITS)
            entry = found.setdefault(number, [0, 0, 0, {}])
            entry[0], entry[1], entry[2] = entry[0] + 1, entry[1] + m, entry[2] + m * m
            entry[3][v] = entry[3].get(v, 0) + 1
        group = ranges._Group(list(found), *[[e[k] for e in found.values()] for k in range(3)])
        values = {group.bins[i]: sorted(found[group.bins[i]][3].items()) for i in ranges._wanted(group, 3.0, 5)}
        lo, hi = -math.inf, math.inf
        for _ in range(5):
            kept = np.sort(x[(x >= lo) & (x <= hi)])
            if not len(kept):
                break
            exact = [Fraction(v) for v in kept.tolist()]
            variance = (len(exact) * sum(v * v for v in exact) - sum(exact) ** 2) / len(exact) ** 2
            width = 3.0 * float(np.std(kept / 1e200) * 1e200 if variance > 10**300 else math.sqrt(variance))
            mid = (kept[(len(kept) - 1) // 2] + kept[len(kept) // 2]) / 2
            lo, hi = max(lo, mid - width), min(hi, mid + width)
        assert ranges._clipped(group, values, 3.0, 5) == pytest.approx((lo, hi), rel=1e-13)


def test_softening_root(spark, size):
    rng = np.random.default_rng(5)
    rows = [("root", float(v), 0.1) for v in rng.normal(0, 0.5, 200)]
    rows += [("small", float(v), 5.0) for v in rng.normal(0, 0.5, 50)]
    rows += [("large", float(v), 0.1) for v in rng.normal(0, 9.0, 50)]
    rows += [("empty", None, 0.1)] + [("zero", 0.5, 0.0)] * 4
    df = spark.createDataFrame(rows, "k string, r double, e double")
    got = {r["k"]: r["s"] for r in soften_fit(df, ["k"], {"s": ("r", "e")}).collect()}
    assert got["small"] == 0 and got["empty"] == 0 and got["large"] is None
    assert got["zero"] == pytest.approx(0.5, abs=1e-8)
    r = np.array([x for k, x, _ in rows if k == "root"])
    assert np.sum(r**2 / (0.01 + got["root"] ** 2)) / len(r) == pytest.approx(1.0, abs=1e-6)


def test_parameters_lower_the_degrees_of_freedom(spark, size):
    df = spark.createDataFrame([("a", 1.0, 0.5)] * 10, "k string, r double, e double")
    got = soften_fit(df, ["k"], {"s": ("r", "e")}, num_params=4).first()["s"]
    assert 10 / (0.25 + got**2) / 8 == pytest.approx(1.0, abs=1e-6) if got is not None else True
    assert soften_fit(df.where(F.lit(False)), ["k"], {"s": ("r", "e")}).count() == 0
