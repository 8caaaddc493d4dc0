"""Run a query on Spark and its SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from .registry import ORACLES, QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _ordered(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """None when both answers are equal, else what differs."""
    df = QUERIES[name](spark, folder)
    got = _ordered(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = _ordered(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w or list(map(type, g)) != list(map(type, w))]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ ({sorted(columns)}), such as {wrong[0][0]} != {wrong[0][1]}"
    return None if got else "no rows"
