"""Writers for result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = ("visit", "arm"), mode: str = "overwrite") -> None:
    """Parquet, partitioned by the coordinates that later jobs select on.

    The rebalance hint gathers the rows of a coordinate into few files and splits a
    coordinate that holds far more rows than the others. Overwriting replaces the
    coordinates that ``df`` has and leaves all others.
    """
    present = [c for c in by if c in df.columns]
    if not present:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *present).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*present).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, drop: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """JSON lines of the scalar record, without the nested table columns named in ``drop``."""
    df.drop(*drop).write.mode(mode).json(path)
