"""Repeatable random choice of fibers by an ordered hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import order_statistics
from .windows import top_per_group


def lot(*columns: str, seed: int = 0) -> Column:
    """A pseudo-random number that depends on the columns and the seed only."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))
    # 52 bits, which a double holds exactly.
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")


def split_fibers(
    df: DataFrame, keys: Sequence[str], fiber: str = "fiberId", fraction: float = 0.1, seed: int = 0
) -> DataFrame:
    """Add ``isReference`` for a random ``fraction`` of the fibers of each group, one at least."""
    if not 0 < fraction < 1:
        raise ValueError("fraction must be between 0 and 1")
    keys = list(keys)
    fibers = df.select(*keys, fiber).distinct().withColumn("__lot", lot(fiber, seed=seed))
    last = order_statistics(
        fibers, keys, "__lot", {"__last": lambda n: F.greatest(F.floor(n * fraction), F.lit(1)) - 1}
    )
    # The lot depends on the fiber alone, so the rows can be compared directly.
    return (
        df.join(last.drop("n"), keys)
        .withColumn("isReference", lot(fiber, seed=seed) <= F.col("__last"))
        .drop("__last")
    )


def sample_fibers(df: DataFrame, keys: Sequence[str], k: int, fiber: str = "fiberId", seed: int = 0) -> DataFrame:
    """``k`` fibers of each group without replacement."""
    fibers = df.select(*keys, fiber).distinct().withColumn("__lot", lot(fiber, seed=seed))
    return top_per_group(fibers, keys, ["__lot", fiber], k).drop("__lot")
