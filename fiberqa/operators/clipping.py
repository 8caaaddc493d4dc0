"""Iterative sigma clipping and the softening root, per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.frames import cut, finite, join_per_group, one_exposure
from .ranges import clipped_intervals

# Clipping width and rounds.
CLIP_SIGMA = 3.0
CLIP_ROUNDS = 5

_SOFTEN_STEPS = 36
_SOFTEN_PASSES = 7
_SOFTEN_CUTS = 32


def _limits_of_sorted(values: str, sigma: float, rounds: int) -> str:
    """SQL for struct(lo, hi): the interval left after clipping one sorted array."""
    return f"""
    aggregate(sequence(1, {rounds}),
      named_struct('lo', double('-Infinity'), 'hi', double('Infinity')),
      (s, i) -> transform(array(filter({values}, x -> x >= s.lo AND x <= s.hi)), k ->
        transform(array(named_struct(
            'mid', (get(k, int((size(k) - 1) / 2)) + get(k, int(size(k) / 2))) / 2D,
            'mean', try_divide(aggregate(k, 0D, (a, x) -> a + x), size(k)))), m ->
          transform(array(sqrt(try_divide(aggregate(k, 0D, (a, x) -> a + (x - m.mean) * (x - m.mean)), size(k)))), sd ->
            named_struct('lo', greatest(s.lo, m.mid - {sigma}D * sd),
                         'hi', least(s.hi, m.mid + {sigma}D * sd)))[0])[0])[0])
    """


def clip_limits(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    sigma: float = CLIP_SIGMA,
    rounds: int = CLIP_ROUNDS,
) -> DataFrame:
    """Interval ``<column>_lo … <column>_hi`` that clipping leaves, one row per group.

    Each round takes median and population deviation of the values still inside and keeps
    those within ``sigma`` deviations, the limits included. What survives is always an
    interval. The values of a group of one exposure are sorted in a task and clipped there;
    those of other groups never meet (:mod:`fiberqa.operators.ranges`). The same values give
    the same limits however they are spread over tasks.
    """
    keys = list(keys)
    df = finite(df, list(columns))
    if one_exposure(keys):
        # Inside the aggregation, so that the optimizer does not copy the expression around.
        found = df.groupBy(*keys).agg(
            *[
                F.expr(_limits_of_sorted(f"sort_array(collect_list(double(`{c}`)))", sigma, rounds)).alias(f"__s_{c}")
                for c in columns
            ]
        )
        return found.select(
            *keys,
            *[F.col(f"__s_{c}.{end}").alias(f"{c}_{end}") for c in columns for end in ("lo", "hi")],
        )

    values = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    rows = values.unpivot(keys, list(columns), "__series", "__value").where(F.col("__value").isNotNull())
    limits = clipped_intervals(rows, [*keys, "__series"], sigma, rounds)
    ends = [
        F.max(F.when(F.col("__series") == c, F.col(f"__{end}"))).alias(f"{c}_{end}")
        for c in columns
        for end in ("lo", "hi")
    ]
    return limits.groupBy(*keys).agg(*ends)


def sigma_clip(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    sigma: float = CLIP_SIGMA,
    rounds: int = CLIP_ROUNDS,
) -> DataFrame:
    """Flag clipped rows. ``columns`` maps a value column to its flag; a missing value is
    flagged. Rows with a missing key belong to no group and are dropped.
    """
    df = df.na.drop(subset=list(keys))
    if not one_exposure(keys):
        df = cut(df)  # read three times
    limits = clip_limits(df, keys, list(columns), sigma, rounds)
    flags = {
        flag: ~F.coalesce(
            (F.col(c) >= F.col(f"{c}_lo")) & (F.col(c) <= F.col(f"{c}_hi")), F.lit(False)
        )
        for c, flag in columns.items()
    }
    drop = [f"{c}_{end}" for c in columns for end in ("lo", "hi")]
    return join_per_group(df, limits, keys, "left").withColumns(flags).drop(*drop)


def _soften_sql(pairs: str, dof: str, top: float) -> str:
    """SQL for the root of chi2(s)/dof = 1 over one array of (r2, e2)."""

    def excess(s: str) -> str:
        term = f"p.r2 / (p.e2 + {s} * {s})"
        if s == "0D":
            term = "CASE WHEN p.e2 > 0 THEN p.r2 / p.e2 WHEN p.r2 > 0 THEN double('Infinity') ELSE 0D END"
        return f"(aggregate({pairs}, 0D, (a, p) -> a + {term}) / {dof} - 1D)"

    steps = f"""
    transform(array(aggregate(sequence(1, {_SOFTEN_STEPS}), named_struct('a', 0D, 'b', {top}D),
      (s, i) -> transform(array((s.a + s.b) / 2D), m ->
        CASE WHEN {excess('m')} > 0 THEN named_struct('a', m, 'b', s.b)
             ELSE named_struct('a', s.a, 'b', m) END)[0])), s -> (s.a + s.b) / 2D)[0]
    """
    return (
        f"CASE WHEN size({pairs}) = 0 OR {dof} <= 0 THEN 0D WHEN {excess('0D')} <= 0 THEN 0D "
        f"WHEN {excess(f'{top}D')} > 0 THEN NULL ELSE {steps} END"
    )


def soften_fit(
    df: DataFrame,
    keys: Sequence[str],
    pairs: dict[str, tuple[str, str]],
    num_params: int = 0,
    max_soften: float = 1.0,
) -> DataFrame:
    """Softening s in [0, max] that makes chi2 per degree of freedom one, per group.

    ``pairs`` maps an output name to (residual, error). Zero when chi2 is already small or
    there are no rows, NULL when even the largest softening is too little.
    """
    keys = list(keys)
    if one_exposure(keys):
        fits = []
        for name, (r, e) in pairs.items():
            both = f"`{r}` IS NOT NULL AND `{e}` IS NOT NULL"
            squares = f"named_struct('r2', `{r}` * `{r}`, 'e2', `{e}` * `{e}`)"
            group = (
                f"named_struct('pairs', collect_list(CASE WHEN {both} THEN {squares} END), "
                f"'dof', count(`{r}`) - {num_params / 2.0}D)"
            )
            solved = _soften_sql("g.pairs", "g.dof", max_soften)
            fits.append(F.expr(f"transform(array({group}), g -> {solved})[0]").alias(name))
        return df.groupBy(*keys).agg(*fits)

    # Every pass evaluates chi2 at a row of trial values inside the bracket, so that each
    # pass over the data narrows the bracket by that many times.
    long = None
    for name, (r, e) in pairs.items():
        one = df.select(
            *keys,
            F.lit(name).alias("__metric"),
            (F.col(r) * F.col(r)).alias("__r2"),
            (F.col(e) * F.col(e)).alias("__e2"),
            F.col(r).isNotNull().alias("__counted"),
        )
        long = one if long is None else long.unionByName(one)
    grouping = [*keys, "__metric"]
    bracket = cut(long.groupBy(*grouping).agg(F.lit(0.0).alias("__a"), F.lit(float(max_soften)).alias("__b")))
    for step in range(_SOFTEN_PASSES):
        trial = [
            F.col("__a") + (F.col("__b") - F.col("__a")) * F.lit(j / _SOFTEN_CUTS) for j in range(_SOFTEN_CUTS + 1)
        ]
        terms = [
            F.when(F.col("__e2") + s * s > 0, F.col("__r2") / (F.col("__e2") + s * s)).when(
                F.col("__r2") > 0, F.lit(float("inf"))
            )
            for s in trial
        ]
        dof = F.count(F.when(F.col("__counted"), F.lit(1))) - num_params / 2.0
        sums = join_per_group(long, bracket, grouping).groupBy(*grouping, "__a", "__b").agg(
            dof.alias("__dof"), *[F.coalesce(F.sum(t), F.lit(0.0)).alias(f"__f{j}") for j, t in enumerate(terms)]
        )
        # The last trial value that is still too small starts the next bracket.
        at = F.lit(0)
        for j in range(1, _SOFTEN_CUTS):
            at = F.when(F.col(f"__f{j}") > F.col("__dof"), F.lit(j)).otherwise(at)
        width = (F.col("__b") - F.col("__a")) / _SOFTEN_CUTS
        low = F.col("__a") + width * F.col("__at")
        next_bracket = sums.withColumn("__at", at)
        if step == 0:
            verdict = (
                F.when((F.col("__dof") <= 0) | (F.col("__f0") <= F.col("__dof")), F.lit("zero"))
                .when(F.col(f"__f{_SOFTEN_CUTS}") > F.col("__dof"), F.lit("none"))
                .otherwise(F.lit("root"))
            )
            verdicts = cut(next_bracket.select(*grouping, verdict.alias("__verdict"), low.alias("__a"), (low + width).alias("__b")))
            bracket = verdicts.select(*grouping, "__a", "__b")
        else:
            bracket = cut(next_bracket.select(*grouping, low.alias("__a"), (low + width).alias("__b")))
    root = (F.col("__r.__a") + F.col("__r.__b")) / 2.0
    solved = (
        verdicts.select(*grouping, "__verdict")
        .join(bracket.select(*grouping, F.struct("__a", "__b").alias("__r")), grouping)
        .withColumn("__s", F.when(F.col("__verdict") == "root", root).when(F.col("__verdict") == "zero", F.lit(0.0)))
    )
    return solved.groupBy(*keys).agg(*[F.max(F.when(F.col("__metric") == n, F.col("__s"))).alias(n) for n in pairs])
