"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Views, ctes, duckdb_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ROWS: dict[str, str] = {}
DIGITS = 6


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to a fixed number of digits, without negative zero."""
    return df.select(
        *[
            (F.round(c, DIGITS) + F.lit(0.0)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def case(name: str, rows: str, views: str = "", sql: str | None = None, doubles: str = ""):
    """Register ``fn(v)`` as a query. ``rows`` are the inventory rows it covers, ``doubles``
    the double columns of the SQL, which both sides round alike.
    """

    def register(fn: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: _rounded(fn(Views(spark, folder)))
        ROWS[name] = rows
        if sql is not None:
            replaced = ", ".join(f'round("{c}", {DIGITS}) + 0.0 AS "{c}"' for c in doubles.split())
            body = duckdb_text(sql).strip()
            extra = ""
            if body.upper().startswith("WITH "):
                # Further CTEs of the query follow those of the views.
                extra, body = _split_with(body)
            replace = f" REPLACE ({replaced})" if replaced else ""
            head = ctes(*views.split()) if views else "WITH RECURSIVE " + extra.removeprefix(",\n")
            head = head if views or extra else ""
            extra = extra if views else ""
            ORACLES[name] = f"{head}{extra}\nSELECT *{replace} FROM (\n{body}\n) AS answer"
        return fn

    return register


def _split_with(body: str) -> tuple[str, str]:
    """Cut ``WITH a AS (…), b AS (…) SELECT …`` into its CTEs and its SELECT."""
    depth, i = 0, len("WITH ")
    while i < len(body):
        ch = body[i]
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif depth == 0 and body[i : i + 6].upper() == "SELECT":
            return ",\n" + body[len("WITH ") : i].rstrip(), body[i:]
        i += 1
    raise ValueError("no SELECT after WITH")
