"""Loading tables, mapping NaN to NULL, and sizing or cutting a plan."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = "fiberqa.broadcastBytes"
DEFAULT_BROADCAST_BYTES = 8 * 1024 * 1024
COPIES = 32


def finite(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NaN and infinities into NULL, so that the built-in aggregates skip them."""
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    chosen = fractional if columns is None else fractional & set(columns)
    bad = {c: F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf"))) for c in chosen}
    return df.select(*[F.when(~bad[c], F.col(c)).alias(c) if c in bad else F.col(c) for c in df.columns])


def load(spark: SparkSession, path: str, where: str | None = None) -> DataFrame:
    """Read one dataset type. ``where`` selects coordinates (visit, arm, spectrograph);
    on a table written by :func:`fiberqa.sources.sinks.write_table` it prunes partitions.
    """
    df = spark.read.parquet(path)
    if where:
        df = df.where(F.expr(where))
    return finite(df)


def fiber_keys(fibers: DataFrame, *keys: str) -> list[str]:
    """Keys that rows share with a fiber configuration: with ``visit`` if it has one row per visit."""
    return ["visit", *keys] if "visit" in fibers.columns else list(keys)


def load_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Read one relational table (exposure, telescope, guide camera)."""
    return finite(spark.read.format("jdbc").options(url=url, dbtable=table, **options).load())


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, which needs no job. Of a table that was read from files it
    is the size of the files; behind an ``explode`` or an aggregation it can be too small, so
    what is broadcast by it is written first where its size is in doubt.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _limit(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def small(df: DataFrame) -> bool:
    """Whether ``df`` may be broadcast, by :func:`estimated_bytes`."""
    return estimated_bytes(df) <= _limit(df, BROADCAST_BYTES, DEFAULT_BROADCAST_BYTES)


def one_exposure(keys: Sequence[str]) -> bool:
    """Whether a group of these keys lies in one exposure.

    Such a group is bounded by the instrument, which has so many fibers, lines and pixels: its
    values may be gathered in a task, however many exposures there are. Any other group grows
    with the data, and no task may hold it.
    """
    return "visit" in keys


def join_per_group(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows with a table that has one row per group, whatever the size of a group.

    A table of a checked small size is broadcast. A larger one is repeated a few times, and
    each task's rows of a group meet one of the copies, so that a group spreads over tasks.
    An estimate that grows with the input of an aggregation is no size: such a table is written
    first.
    """
    keys = list(keys)
    if not small(table):
        table = cut(table)
    if small(table):
        return rows.join(F.broadcast(table), keys, how)
    copies = table.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    salted = rows.withColumn("__copy", F.pmod(F.spark_partition_id(), F.lit(COPIES)))
    return salted.join(copies, [*keys, "__copy"], how).drop("__copy")


def shared_folder(spark: SparkSession) -> str:
    """The folder for cut lineage: ``spark.checkpoint.dir``, or one in the warehouse in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/cuts"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result has a short lineage, survives lost executors and has a real size. All cuts of
    an application lie in one folder, named after it, that can go when the application ends.
    """
    application = df.sparkSession.sparkContext.applicationId
    path = f"{shared_folder(df.sparkSession)}/{application}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
