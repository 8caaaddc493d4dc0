"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

Every stage works on all that its predecessor kept. The first four return the columns of
``documents``, the last one the encoded texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiberqa.llm import decontaminate, minhash, pieces, secrets, toxicity
from fiberqa.llm.queries import piece_model, table
from fiberqa.llm.ship import ship
from fiberqa.sources.frames import cut

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def row() -> list[Column]:
    """What a row is known by: its doc_id, which may be null or shared, and a hash of its text."""
    return [F.col("doc_id").cast("long").alias("__id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("__hash")]


def joined(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` with ``rows(__id, __hash, …)``, null ids being equal."""
    keyed = docs.withColumns(dict(zip(("__own_id", "__own_hash"), row())))
    same = F.col("__own_id").eqNullSafe(F.col("__id")) & (F.col("__own_hash") == F.col("__hash"))
    return keyed.join(rows, same, how).drop("__own_id", "__own_hash")


def not_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score below 0.5. The network learns from the labels of the training fold."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, folder, "labels"), learn=toxicity.training_fold())
    return toxicity.score_toxicity(docs, model, tuple(docs.columns), "__score").where("__score < 0.5").drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8, smallest doc_id.

    Documents without doc_id are no duplicates of anything and stay. Of rows that share a doc_id
    and the set of shingles one stays. Rows that share only the doc_id are decided one by one,
    unless it is the smallest of several sets: these are one node of a component.
    """
    ship(spark)
    found = cut(minhash.near_duplicates(docs, k=5, percent=80, marks=True).withColumnsRenamed({"doc_id": "__id", "text_hash": "__hash"}))
    equal = ["__id", "n_shingles", "h1", "h2"]
    several = found.where("kept AND __id IS NOT NULL").groupBy(*equal).count().where("count > 1").drop("count")
    names = {"n_shingles": "__n", "h1": "__h1", "h2": "__h2"}
    repeated = cut(found.join(several, equal).select(*equal, "__hash").distinct().withColumnsRenamed(names))
    gone = found.where(~F.col("kept")).select("__id", "__hash").distinct()
    single = joined(docs, gone.union(repeated.select("__id", "__hash")), "left_anti")
    first = joined(docs, repeated, "inner").dropDuplicates(["__id", *names.values()])
    return single.unionByName(first.select(*docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that no item of ``benchmark`` is found in, with or without doc_id."""
    ship(spark)
    rows = docs.select(F.struct(*row()).alias("__row"), "text")
    found = decontaminate.contamination(rows, table(spark, folder, "benchmark"), key="__row").select("__row.*").distinct()
    return joined(docs, found, "left_anti")


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets that only one owner has replaced by a mark."""
    return secrets.redacted(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids, n_tokens, and whether the decoded text is the given one."""
    ship(spark)
    return pieces.encode(docs, piece_model(spark), keep_text=False)


STAGES: list[tuple[str, Stage]] = [
    ("not_toxic", not_toxic),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("without_secrets", without_secrets),
    ("encoded", encoded),
]

#: Training, matching and encoding are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, folder))
    return docs
