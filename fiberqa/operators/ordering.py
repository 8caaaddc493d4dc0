"""Exact order statistics, quantiles and ranks of groups of any size.

Spark's ``percentile`` gathers the distinct values of a group in one task, and a ranking
window gathers all rows of it. Both are used here only for groups of one exposure, which the
instrument bounds (:func:`fiberqa.sources.frames.one_exposure`). In any other group a wanted
rank is closed in on:

1. rows are counted per group and coarse range of values; each task sends only its counts.
   A running sum over the ranges of a group says which range holds the rank;
2. only rows in such a range go on. They are counted per value, and in the same way per
   fine range of values;
3. only the values in the fine range that holds the rank are put in order.

A group thus never has to be in one place, and most rows are never shuffled. Ranks of all rows
come from a sort that is cut into ranges (:mod:`fiberqa.operators.placement`). Results are
exact either way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.frames import cut, finite, join_per_group, one_exposure, small
from .placement import PARTITION_BITS, null_safe, placed, sorted_ranges

FINE = 1 << 20
COARSE = 1 << 7
LARGEST_EXPONENT = 1100


def value_bin(x: Column, per_octave: int = FINE) -> Column:
    """Number of the range that holds ``x``; never falls as ``x`` grows.

    Each power of two is cut into ranges of equal ratio. Fine ones are about six digits apart, so
    measurements that came from 32-bit floats have at most eight different values in one.
    """
    # One logarithm, which never falls either.
    number = F.floor(F.log(F.abs(x)) * (per_octave / math.log(2.0))) + LARGEST_EXPONENT * per_octave
    return F.when(x > 0, number).when(x < 0, -number).otherwise(F.lit(0)).cast("long")


def _long(df: DataFrame, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """Rows (keys, __metric, __x); ``__metric`` names the column that held ``__x``."""
    values = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return values.unpivot(keys, list(columns), "__metric", "__x").where(F.col("__x").isNotNull())


def _running(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _holding(below: str, count: str):
    """The wanted ranks that fall among ``count`` values after the first ``below``."""
    return F.expr(f"filter(__wants, w -> w.rank >= {below} AND w.rank < {below} + {count})")


def _pick(df: DataFrame, keys: list[str], wanted: dict[str, dict[str, Callable[[Column], Column]]]) -> DataFrame:
    """One row per group: for each name the value at its rank, with ``n_<column>``.

    ``wanted`` maps a column to {name: function of the group size giving a 0-based rank}.
    """
    series = [*keys, "__metric"]
    rows = _long(df, keys, list(wanted)).withColumn("__range", value_bin(F.col("__x"), COARSE))

    wants = F.lit(None)
    for column, ranks in wanted.items():
        entries = [
            F.struct(F.lit(name).alias("name"), rank(F.col("__n")).cast("long").alias("rank"))
            for name, rank in ranks.items()
        ]
        wants = F.when(F.col("__metric") == column, F.array(*entries)).otherwise(wants)
    place = [*series, "__range"]
    ranges = (
        rows.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__below", F.sum("__c").over(_running(Window.partitionBy(*series).orderBy("__range"))) - F.col("__c"))
        .withColumn("__n", F.sum("__c").over(Window.partitionBy(*series)))
        .withColumn("__wants", wants)
        .withColumn("__wants", _holding("__below", "__c"))
        .where(F.size("__wants") > 0)
        .drop("__c")
    )
    ranges = cut(ranges)  # a few rows per group, read twice below

    counts = (
        join_per_group(rows, ranges.select(*place), place)
        .groupBy(*place, "__x")
        .agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__bin", value_bin(F.col("__x")))
    )
    counts = cut(counts)  # read twice, and a scan of all rows away
    bins = (
        counts.groupBy(*place, "__bin")
        .agg(F.sum("__c").alias("__b"))
        .join(ranges, place)
        .withColumn(
            "__below",
            F.col("__below") + F.sum("__b").over(_running(Window.partitionBy(*place).orderBy("__bin"))) - F.col("__b"),
        )
        .withColumn("__wants", _holding("__below", "__b"))
        .where(F.size("__wants") > 0)
        .drop("__b")
    )
    found = (
        counts.join(bins, [*place, "__bin"])
        .withColumn(
            "__below",
            F.col("__below")
            + F.sum("__c").over(_running(Window.partitionBy(*place, "__bin").orderBy("__x")))
            - F.col("__c"),
        )
        .withColumn("__want", F.explode(_holding("__below", "__c")))
    )
    picks = [
        F.max(F.when(F.col("__want.name") == name, F.col("__x"))).alias(name)
        for ranks in wanted.values()
        for name in ranks
    ]
    sizes = [F.max(F.when(F.col("__metric") == c, F.col("__n"))).alias(f"n_{c}") for c in wanted]
    return found.groupBy(*keys).agg(*picks, *sizes)


def order_statistics(
    df: DataFrame, keys: list[str], column: str, ranks: dict[str, Callable[[Column], Column]]
) -> DataFrame:
    """Values at 0-based ranks that may depend on the group size; also the size as ``n``.
    NaN and infinities are missing values here and in all functions below.
    """
    df = finite(df, [column])
    if one_exposure(keys):
        sorted_values = (
            df.where(F.col(column).isNotNull())
            .groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.col(column).cast("double"))).alias("__v"))
            .withColumn("n", F.size("__v").cast("long"))
        )
        picks = [
            F.when((rank(F.col("n")) >= 0) & (rank(F.col("n")) < F.col("n")), F.get("__v", rank(F.col("n")).cast("int"))).alias(name)
            for name, rank in ranks.items()
        ]
        return sorted_values.select(*keys, *picks, "n")
    picked = _pick(df, keys, {column: ranks})
    return picked.withColumnRenamed(f"n_{column}", "n")


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column] = (),
    quantiles: dict[str, tuple[str, float]] | None = None,
    bounded: bool | None = None,
) -> DataFrame:
    """Ordinary aggregates and exact interpolated quantiles per group, in one table.

    ``quantiles`` maps an output name to (column, probability). A row with a missing key
    belongs to no group. No keys: one row for the whole table. ``bounded`` says whether a task
    may hold the values of a group; without it, whether the keys name one exposure.
    """
    keys, quantiles = list(keys), quantiles or {}
    if keys:
        df = df.na.drop(subset=keys)
    df = finite(df, [c for c, _ in quantiles.values()])
    if not quantiles or (one_exposure(keys) if bounded is None else bounded):
        packed: dict[str, list[tuple[str, float]]] = {}
        for name, (column, p) in quantiles.items():
            packed.setdefault(column, []).append((name, float(p)))
        extra = [F.percentile(c, [p for _, p in ps]).alias(f"__q_{c}") for c, ps in packed.items()]
        out = df.groupBy(*keys).agg(*aggs, *extra)
        kept = [c for c in out.columns if not c.startswith("__q_")]
        flat = [F.get(f"__q_{c}", F.lit(i)).alias(name) for c, ps in packed.items() for i, (name, _) in enumerate(ps)]
        return out.select(*kept, *flat)

    grouping = keys
    if not keys:
        df, grouping = df.withColumn("__all", F.lit(1)), ["__all"]
    wanted: dict[str, dict[str, Callable[[Column], Column]]] = {}
    for name, (column, p) in quantiles.items():
        ranks = wanted.setdefault(column, {})
        ranks[f"{name}__lo"] = lambda n, p=p: F.floor((n - 1) * F.lit(float(p)))
        ranks[f"{name}__hi"] = lambda n, p=p: F.ceil((n - 1) * F.lit(float(p)))
    picked = _pick(df, grouping, wanted)
    values = []
    for name, (column, p) in quantiles.items():
        position = (F.col(f"n_{column}") - 1) * F.lit(float(p))
        lo, hi = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        values.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    picked = picked.select(*grouping, *values)
    base = df.groupBy(*grouping).agg(*aggs) if aggs else df.select(*grouping).distinct()
    if not keys:
        # No rows at all still give the one row of a table without keys.
        base = df.agg(*aggs, F.lit(1).alias("__all")) if aggs else df.agg(F.lit(1).alias("__all"))
    return base.join(picked, grouping, "left").drop("__all")


def grouped_quantiles(df: DataFrame, groupings: Sequence[Sequence[str]], column: str, *wanted: dict[str, float]) -> list[DataFrame]:
    """Exact quantiles of one column for several groupings of the same rows, in one scan of them.

    ``wanted`` has {name: probability} for each grouping. Returns one table per grouping, with its
    keys and names. Every row is handed to all groupings (an ``Expand``), and one aggregation or
    one search for ranks serves them all. Rows with a missing key belong to no group of a grouping
    that has the key.
    """
    keys = list(dict.fromkeys(k for g in groupings for k in g))
    rows = finite(df.select(*keys, column), [column])
    sets = [
        F.struct(F.lit(i).alias("__set"), *[(F.col(k) if k in g else F.lit(None).cast(rows.schema[k].dataType)).alias(k) for k in keys])
        for i, g in enumerate(groupings)
    ]
    whole = [F.when(F.array_contains(F.array(*[F.col(k).isNull() for k in g]), True), None).otherwise(s) if g else s for g, s in zip(groupings, sets)]
    expanded = rows.select(F.explode(F.array_compact(F.array(*whole))).alias("__g"), F.col(column).alias("__v"))
    probabilities = {f"q{i}": p for i, p in enumerate(dict.fromkeys(p for w in wanted for p in w.values()))}
    at = {p: n for n, p in probabilities.items()}
    # One key: a struct is never null, so that a grouping without some of the keys is no missing group.
    every = all(one_exposure(g) for g in groupings)
    found = cut(group_stats(expanded, ["__g"], quantiles={n: ("__v", p) for n, p in probabilities.items()}, bounded=every))
    return [
        found.where(F.col("__g.__set") == i).select(*[F.col(f"__g.{k}").alias(k) for k in g], *[F.col(at[p]).alias(n) for n, p in w.items()])
        for i, (g, w) in enumerate(zip(groupings, wanted))
    ]


def medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str = "") -> DataFrame:
    return group_stats(df, keys, quantiles={f"{c}{suffix}": (c, 0.5) for c in columns})


def quartiles(column: str, prefix: str) -> dict[str, tuple[str, float]]:
    return {f"{prefix}25": (column, 0.25), f"{prefix}50": (column, 0.5), f"{prefix}75": (column, 0.75)}


def ranked(df: DataFrame, keys: Sequence[str], column: str, bounded: bool | None = None) -> DataFrame:
    """Add ``below`` (rows of the group with a smaller value), ``ties`` (rows with the same
    value, itself included) and ``n`` (rows with a value). NULL values get NULL.

    ``bounded`` says whether a task may hold the rows of a group; without it, whether the keys
    name one spectrum. In other groups equal values are counted before anything is put in order,
    and few distinct values are ranked without moving the rows.
    """
    keys = list(keys)
    df = finite(df, [column])
    if (one_exposure(keys) and "fiberId" in keys) if bounded is None else bounded:
        group = Window.partitionBy(*keys)
        return (
            df.withColumn("n", F.when(F.col(column).isNotNull(), F.count(column).over(group)))
            .withColumn("ties", F.when(F.col(column).isNotNull(), F.count(F.lit(1)).over(Window.partitionBy(*keys, column))))
            .withColumn(
                "below",
                F.when(F.col(column).isNotNull(), F.rank().over(group.orderBy(F.col(column).asc_nulls_last())) - 1).cast("long"),
            )
        )
    # Read again below: the values must be the same each time.
    df = cut(df)
    counts = cut(df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("__x")).agg(F.count(F.lit(1)).alias("ties")))
    if small(counts):
        group = Window.partitionBy(*keys)
        table = counts.withColumn("n", F.sum("ties").over(group)).withColumn("below", F.sum("ties").over(_running(group.orderBy("__x"))) - F.col("ties"))
        table = _renamed(cut(table.select(*keys, "__x", "n", "ties", "below")), [*keys, "__x"])
        same = null_safe(df, table, keys, "__k_") & (df[column] == table["__k___x"])
        return df.join(F.broadcast(table), same, "left").drop(*[f"__k_{k}" for k in [*keys, "__x"]])
    rows = sorted_ranges(df, [*[F.col(k).asc_nulls_first() for k in keys], F.col(column).asc_nulls_last()])
    return _ranks(rows, keys, column).drop("__at", "__range")


def _ranks(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``below``, ``ties`` and ``n`` of rows with ``__at``, sorted by keys and value in ranges.

    Equal values stand together. In a range they are counted there; a value that goes on in
    further ranges is among the first or last values of each, and those are added up. What crosses
    the borders is a few rows for each range and group.
    """
    rows = rows.withColumn("__range", F.shiftright("__at", PARTITION_BITS)).withColumn("__x", F.col(column))
    place = [*keys, "__range"]
    runs = cut(
        rows.where(F.col(column).isNotNull())
        .groupBy(*place, "__x")
        .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__here"))
    )
    ranges = runs.groupBy(*place).agg(F.min("__x").alias("__least"), F.max("__x").alias("__most"), F.min("__first").alias("__start"), F.sum("__here").alias("__rows"))
    group = Window.partitionBy(*keys)
    ranges = cut(
        ranges.withColumn("__before", F.sum("__rows").over(_running(group.orderBy("__range"))) - F.col("__rows"))
        .withColumn("n", F.sum("__rows").over(group))
        .drop("__rows")
    )
    # Values that end one range and begin the next.
    at_edge = (F.col("__x") == F.col("__least")) | (F.col("__x") == F.col("__most"))
    ranges = _renamed(ranges, place)
    known = runs.join(ranges, null_safe(runs, ranges, place, "__k_")).drop(*[f"__k_{k}" for k in place])
    known = cut(known.withColumn("below", F.col("__before") + F.col("__first") - F.col("__start")).withColumn("__edge", at_edge))
    over = known.where("__edge").groupBy(*keys, "__x").agg(F.min("below").alias("__below"), F.sum("__here").alias("__ties"), F.count(F.lit(1)).alias("__ranges"))
    over = cut(over.where("__ranges > 1").drop("__ranges"))
    spread = _renamed(over, [*keys, "__x"])
    whole = known.join(spread, null_safe(known, spread, [*keys, "__x"], "__k_"), "left")
    table = whole.select(
        *[F.col(k).alias(f"__k_{k}") for k in place],
        F.col("__x").alias("__k___x"),
        "n",
        F.coalesce("__ties", "__here").alias("ties"),
        F.coalesce("__below", "below").alias("below"),
    )
    # A hot value has one row for each of its ranges, so that it meets its rows range by range.
    joined = rows.join(table, null_safe(rows, table, [*place, "__x"], "__k_"), "left")
    return joined.drop("__x", *[f"__k_{k}" for k in [*place, "__x"]])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__k_{k}" for k in keys})


def average_rank(below: Column | str = "below", ties: Column | str = "ties") -> Column:
    """1-based rank where equal values share their mean rank."""
    b = F.col(below) if isinstance(below, str) else below
    t = F.col(ties) if isinstance(ties, str) else ties
    return b + (t + 1) / 2.0


def percent_rank_of(df: DataFrame, keys: Sequence[str], column: str, out: str, bounded: bool | None = None) -> DataFrame:
    """Average rank over the number of values, in percent; ``bounded`` as in :func:`ranked`."""
    value = average_rank() * 100.0 / F.col("n")
    return ranked(df, keys, column, bounded).withColumn(out, value).drop("n", "ties", "below")


def first_come_rank(df: DataFrame, keys: Sequence[str], column: str, ties_by: Sequence[str], out: str) -> DataFrame:
    """1, 2, … in order of ``column``; equal values in order of ``ties_by``."""
    df = finite(df, [column])
    if one_exposure(keys):
        order = Window.partitionBy(*keys).orderBy(column, *ties_by)
        return df.withColumn(out, F.row_number().over(order).cast("long"))
    return placed(df, keys, [F.col(c).asc() for c in (column, *ties_by)], "__place", "__size").withColumn(out, F.col("__place") + 1).drop("__place", "__size")
