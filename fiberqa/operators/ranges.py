"""A table of ranges of values per group, and sigma clipping on it.

One scan counts the values of each group and range, with the exact sum and sum of squares of
what they lie above the start of their range, in units of the last place. These are whole
numbers, so that the order in which tasks are added up changes nothing. The table is as small as
the number of ranges that hold values, whatever the number of rows.

From the table follow bounds of median, deviation and limits for every round of clipping, and
with them the few ranges in which a median or a limit can lie. A second scan counts the distinct
values of those ranges alone. All rounds then run on both tables, in exact arithmetic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.frames import cut, join_per_group
from .ordering import LARGEST_EXPONENT

#: Ranges of equal width in each power of two, as a power of two.
BITS = 7
PER_OCTAVE = 1 << BITS
_PLACES = 52
_REST = _PLACES - BITS
#: Places above the start of a range are added up in parts of so many bits, so that their
#: products stay whole for some thousand million rows of one range.
_PART = 15


def _with_range(rows: DataFrame) -> DataFrame:
    """Rows with ``__bin``, the number of the range of ``__value``, and ``__m``, its places above the start."""
    size = F.abs("__value")
    guess = F.floor(F.log2(size))
    scaled = size / F.pow(F.lit(2.0), guess.cast("double"))
    # The logarithm may be rounded over a power of two.
    over = F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0)
    fraction = F.when(scaled >= 2, scaled / 2).when(scaled < 1, scaled * 2).otherwise(scaled) - 1.0
    rows = rows.withColumns({"__power": guess + over, "__places": (fraction * float(1 << _PLACES)).cast("long")})
    number = (F.col("__power") + LARGEST_EXPONENT) * PER_OCTAVE + F.shiftright("__places", _REST)
    number = F.when(F.col("__value") > 0, number).when(F.col("__value") < 0, -number).otherwise(F.lit(0)).cast("long")
    above = F.when(F.col("__value") == 0, F.lit(0)).otherwise(F.col("__places").bitwiseAND(F.lit((1 << _REST) - 1)))
    return rows.withColumns({"__bin": number, "__m": above.cast("long")}).drop("__power", "__places")


def _parts() -> list:
    """Sums of the parts of ``__m`` and of their products."""
    m, mask = F.col("__m"), F.lit((1 << _PART) - 1)
    part = [F.shiftright(m, _PART * k).bitwiseAND(mask) for k in range(3)]
    one = [F.sum(part[i]).alias(f"__p{i}") for i in range(3)]
    return one + [F.sum(part[i] * part[j]).alias(f"__p{i}{j}") for i in range(3) for j in range(i, 3)]


class _Group:
    """The ranges of one group in ascending order."""

    def __init__(self, bins: list[int], counts: list[int], sums: list[int], squares: list[int]):
        order = sorted(range(len(bins)), key=bins.__getitem__)
        self.bins = [bins[i] for i in order]
        self.counts = np.array([counts[i] for i in order], np.int64)
        powers = [abs(b) // PER_OCTAVE - LARGEST_EXPONENT for b in self.bins]
        scales = [p - _PLACES for p in powers]
        self.scale = min(scales, default=0)  # the unit of all sums, as a power of two
        low, high, first, second = [], [], [], []
        for i, b, p, s in zip(order, self.bins, powers, scales):
            if b == 0:
                low.append(0.0), high.append(0.0), first.append(0), second.append(0)
                continue
            within = PER_OCTAVE + abs(b) % PER_OCTAVE
            a, z = math.ldexp(within, p - BITS), _ldexp(within + 1, p - BITS)
            low.append(a if b > 0 else -z), high.append(z if b > 0 else -a)
            start = within << _REST  # in the unit of the last place
            n, one, two = counts[i], sums[i], squares[i]
            shift = s - self.scale
            first.append(((n * start + one) << shift) * (1 if b > 0 else -1))
            second.append((n * start * start + 2 * start * one + two) << 2 * shift)
        self.low, self.high = np.array(low), np.array(high)
        self.before = np.concatenate([[0], np.cumsum(self.counts)])
        self.first, self.second = _running(first), _running(second)

    def moments(self, a: int, b: int, values: list[tuple[float, int]] = ()) -> tuple[int, int, int]:
        """Number, sum and sum of squares of ranges ``a`` to ``b - 1`` and of values with their counts."""
        n, one, two = int(self.before[b] - self.before[a]), self.first[b] - self.first[a], self.second[b] - self.second[a]
        for x, c in values:
            m = self.whole(x)
            n, one, two = n + c, one + c * m, two + c * m * m
        return n, one, two

    def whole(self, x: float) -> int:
        """A value in the unit of all sums."""
        top, bottom = x.as_integer_ratio()
        return (top << -self.scale) // bottom if self.scale < 0 else (top >> self.scale) // bottom

    def deviation(self, n: int, one: int, two: int) -> float:
        """Population deviation; exact up to the last rounding."""
        spread = max(n * two - one * one, 0)
        cut_bits = max(0, spread.bit_length() - 128) & ~1
        return _ldexp(math.sqrt(spread >> cut_bits) / n, cut_bits // 2 + self.scale)


def _ldexp(x: float, power: int) -> float:
    try:
        return math.ldexp(x, power)
    except OverflowError:
        return math.inf


def _running(values: list[int]) -> list[int]:
    out, total = [0], 0
    for v in values:
        total += v
        out.append(total)
    return out


def _wanted(g: _Group, sigma: float, rounds: int) -> set[int]:
    """Numbers of the ranges in which a median or a limit of any round can lie."""
    wanted: set[int] = set()
    total = int(g.before[-1])
    lo1 = lo2 = -math.inf
    hi1 = hi2 = math.inf
    for _ in range(rounds):
        # Ranges a to b are inside whatever the limits are; maybe_a to maybe_b can be.
        maybe_a, maybe_b = int(np.searchsorted(g.high, lo1)), int(np.searchsorted(g.low, hi2, "right"))
        a, b = int(np.searchsorted(g.low, lo2)), int(np.searchsorted(g.high, hi1, "right"))
        a, b = max(a, maybe_a), min(b, maybe_b)
        if maybe_a >= maybe_b:
            break
        b = max(a, b)
        below, upto = (int(g.before[maybe_a]), int(g.before[a])), (int(g.before[b]), int(g.before[maybe_b]))
        ranks = [(below[0] + upto[0] - 1) // 2, -(-(below[1] + upto[1] - 1) // 2)]
        at = [int(np.searchsorted(g.before, min(max(r, 0), total - 1), "right")) - 1 for r in ranks]
        at = [min(at), max(at)]
        wanted.update(range(at[0], at[1] + 1))
        mid1, mid2 = g.low[at[0]], g.high[at[1]]
        n, one, two = g.moments(a, b)
        edges = [*range(maybe_a, min(a, maybe_b)), *range(max(b, maybe_a), maybe_b)]
        if n:
            cut_bits, sd = max(0, one.bit_length() - 900), g.deviation(n, one, two)
            mean, ss = _ldexp((one >> cut_bits) / n, cut_bits + g.scale), n * sd * sd
            far = np.maximum(abs(g.low[edges] - mean), abs(g.high[edges] - mean))
            more = float(np.sum(g.counts[edges] * far * far))
            all_n = int(g.before[maybe_b] - g.before[maybe_a])
            sd1, sd2 = math.sqrt(ss / all_n), math.sqrt((ss + more) / n)
        else:
            sd1, sd2 = 0.0, float(g.high[maybe_b - 1] - g.low[maybe_a])
        if not math.isfinite(sd2):
            return set(range(len(g.bins)))
        slack = 1e-9 * (abs(mid1) + abs(mid2) + sigma * sd2) + 5e-324
        lo1, lo2 = max(lo1, mid1 - sigma * sd2 - slack), max(lo2, mid2 - sigma * sd1 + slack)
        hi1, hi2 = min(hi1, mid1 + sigma * sd1 - slack), min(hi2, mid2 + sigma * sd2 + slack)
        for x1, x2 in ((lo1, lo2), (hi1, hi2)):
            wanted.update(range(int(np.searchsorted(g.high, x1)), int(np.searchsorted(g.low, x2, "right"))))
    return wanted


def _clipped(g: _Group, values: dict[int, list[tuple[float, int]]], sigma: float, rounds: int) -> tuple[float, float]:
    """Limits after all rounds. ``values`` has the distinct values of the wanted ranges, in order."""
    lo, hi = -math.inf, math.inf

    def at_rank(rank: int) -> float:
        i = int(np.searchsorted(g.before, rank, "right")) - 1
        rank -= int(g.before[i])
        for x, c in values[g.bins[i]]:
            if rank < c:
                return x
            rank -= c
        raise AssertionError("a range lacks values")

    for _ in range(rounds):
        # Ranges a to b - 1 lie inside; the values of those around them are looked at one by one.
        a, b = int(np.searchsorted(g.low, lo)), int(np.searchsorted(g.high, hi, "right"))
        left, right = int(np.searchsorted(g.high, lo)), int(np.searchsorted(g.low, hi, "right"))
        edges = sorted({*range(left, min(a, right)), *range(max(b, left), right)})
        b = max(a, b)
        near = [(x, c) for i in edges for x, c in values[g.bins[i]]]
        kept = [(x, c) for x, c in near if lo <= x <= hi]
        n, one, two = g.moments(a, b, kept)
        if not n:
            break
        below = int(g.before[left]) + sum(c for x, c in near if x < lo)
        mid = (at_rank(below + (n - 1) // 2) + at_rank(below + n // 2)) / 2.0
        width = sigma * g.deviation(n, one, two)
        lo, hi = max(lo, mid - width), min(hi, mid + width)
    return lo, hi


def _group(table: pa.Table) -> _Group:
    of = {c: table.column(c).to_pylist() for c in table.column_names if c.startswith("__")}
    parts = zip(*(of[f"__p{i}"] for i in range(3)))
    one = [sum(x << _PART * i for i, x in enumerate(p)) for p in parts]
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    products = zip(*(of[f"__p{i}{j}"] for i, j in pairs))
    two = [sum(x << _PART * (i + j) + (i != j) for x, (i, j) in zip(p, pairs)) for p in products]
    return _Group(of["__bin"], of["__c"], one, two)


def clipped_intervals(rows: DataFrame, series: Sequence[str], sigma: float, rounds: int) -> DataFrame:
    """(series…, __lo, __hi) for ``rows(series…, __value)``, values neither missing nor infinite."""
    series = list(series)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*series).schema.fields]
    rows = _with_range(rows)
    counted = rows.groupBy(*series, "__bin").agg(F.count(F.lit(1)).alias("__c"), *_parts())
    # By number: few small rows per group, but work for a whole task.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = cut(counted)
    keys = [f for f in table.select(*series).schema.fields]

    def repeated(key: tuple, n: int) -> list[pa.Array]:
        return [pa.array([k.as_py()] * n, k.type) for k in key]

    def wanted(key: tuple, part: pa.Table) -> pa.Table:
        g = _group(part)
        bins = [g.bins[i] for i in sorted(_wanted(g, sigma, rounds))]
        return pa.Table.from_arrays([*repeated(key, len(bins)), pa.array(bins, pa.int64())], names=[*[f.name for f in keys], "__bin"])

    places = cut(table.repartition(tasks, *series).groupBy(*series).applyInArrow(wanted, ", ".join([*kinds, "__bin bigint"])))
    values = (
        join_per_group(rows.select(*series, "__bin", "__value"), places, [*series, "__bin"])
        .groupBy(*series, "__bin", "__value")
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    # New names: both sides of the grouping come from the same table.
    names = [*series, "__bin", "__value", "__n"]
    values = values.select(*[F.col(c).alias(f"__v_{c}") for c in names])

    def limits(key: tuple, part: pa.Table, found: pa.Table) -> pa.Table:
        of: dict[int, list[tuple[float, int]]] = {}
        for b, x, n in sorted(zip(*(found.column(f"__v_{c}").to_pylist() for c in names[-3:]))):
            of.setdefault(b, []).append((x, n))
        lo, hi = _clipped(_group(part), of, sigma, rounds)
        ends = [pa.array([lo]), pa.array([hi])]
        return pa.Table.from_arrays([*repeated(key, 1), *ends], names=[*[f.name for f in keys], "__lo", "__hi"])

    by_group = values.repartition(tasks, *[f"__v_{c}" for c in series]).groupBy(*[f"__v_{c}" for c in series])
    grouped = table.repartition(tasks, *series).groupBy(*series).cogroup(by_group)
    return grouped.applyInArrow(limits, ", ".join([*kinds, "__lo double", "__hi double"]))
