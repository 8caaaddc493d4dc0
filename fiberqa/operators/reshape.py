"""Between wide, long and nested tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt_status(df: DataFrame) -> DataFrame:
    """One row per status flag that is set; a row with both appears twice."""
    names = ("isUsed", "isReserved")
    ids = [c for c in df.columns if c not in names]
    return df.unpivot(ids, list(names), "status", "value").where("value").drop("value")


def flatten(df: DataFrame, structs: Sequence[str]) -> DataFrame:
    """Fields of struct columns as ``<struct>_<field>`` columns."""
    out = [F.col(c) for c in df.columns if c not in structs]
    for s in structs:
        out += [F.col(f"{s}.{f}").alias(f"{s}_{f}") for f in df.schema[s].dataType.fieldNames()]
    return df.select(*out)


def spread(df: DataFrame, row: Sequence[str], name: str, value: str, names: Sequence[str], prefix: str = "") -> DataFrame:
    """Long to wide for a known list of names; names that are absent become NULL columns."""
    wide = df.groupBy(*row).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))
    return wide.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


def rows_of_arrays(df: DataFrame, arrays: Sequence[str], position: str = "pix") -> DataFrame:
    """One row per element of parallel array columns."""
    rest = [c for c in df.columns if c not in arrays]
    exploded = df.select(*rest, F.posexplode(F.arrays_zip(*arrays)).alias(position, "__v"))
    return exploded.select(*rest, position, *[F.col(f"__v.{a}").alias(a) for a in arrays])


def arrays_of_rows(df: DataFrame, keys: Sequence[str], position: str, values: Sequence[str]) -> DataFrame:
    """Storage form: one row per spectrum, arrays ordered by position. A spectrum has no more
    pixels than the detector has rows.
    """
    packed = F.sort_array(F.collect_list(F.struct(position, *values))).alias("__v")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"__v.{v}").alias(v) for v in values])


def dense_rows(
    df: DataFrame, group: Sequence[str], row: str, column: str, value: str, how: Column, out: str
) -> DataFrame:
    """Cells (row, column) aggregated by ``how``, for every integer column between the
    extremes of the group; cells without data are NULL.
    """
    group = list(group)
    cells = df.groupBy(*group, row, column).agg(how.alias(out))
    ends = cells.groupBy(*group).agg(F.min(column).alias("__a"), F.max(column).alias("__b"))
    full = (
        cells.select(*group, row)
        .distinct()
        .join(ends, group)
        .select(*group, row, F.explode(F.sequence("__a", "__b")).alias(column))
    )
    return full.join(cells, [*group, row, column], "left")


def flag_per_value(df: DataFrame, column: str, values: Sequence[str], prefix: str = "is_") -> DataFrame:
    return df.withColumns({f"{prefix}{v.lower()}": F.col(column) == v for v in values})


def concat_tables(*tables: DataFrame) -> DataFrame:
    """All rows; columns that a table lacks are NULL."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def same_value_or_error(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Pass the rows on, but fail if ``column`` differs within the keys."""
    spread_of = df.groupBy(*keys).agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    message = F.concat(F.lit(f"different {column} in one group: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    checked = spread_of.withColumn("__bad", F.when(F.col("__lo") != F.col("__hi"), F.raise_error(message).cast("boolean")))
    return df.join(checked, list(keys)).where(F.col("__bad").isNull()).select(*df.columns)
