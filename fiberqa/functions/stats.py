"""Aggregate expressions for residual statistics. Missing values are NULL and skipped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factors that turn an interquartile range into a robust sigma.
IQR_ROBUST = 0.741
IQR_PER_SIGMA = 1.349
IQR_PER_SIGMA_SHORT = 1.35


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, NULL where ``b`` is zero."""
    return F.try_divide(_col(a), _col(b))


def weight(err: Column | str, soften: float | Column = 0.0) -> Column:
    e, s = _col(err), soften if isinstance(soften, Column) else F.lit(float(soften))
    return F.try_divide(F.lit(1.0), e * e + s * s)


def weighted_rms(resid: Column | str, err: Column | str, soften: float = 0.0, where: Column | None = None) -> Column:
    """sqrt(sum(w r^2) / sum(w)); a row without a residual still adds to the denominator."""
    r, w = _col(resid), weight(err, soften)
    if where is not None:
        w = F.when(where, w)
    return F.sqrt(F.try_divide(F.sum(w * r * r), F.sum(w)))


def chi2(resid: Column | str, err: Column | str, soften: float | Column = 0.0, where: Column | None = None) -> Column:
    """sum(r^2 / (err^2 + soften^2)), zero for no rows."""
    r = _col(resid)
    term = r * r * weight(err, soften)
    if where is not None:
        term = F.when(where, term)
    return F.coalesce(F.sum(term), F.lit(0.0))


def strict(value: Column, over: Column | str) -> Column:
    """``value``, but NULL as soon as one input of the group is missing."""
    return F.when(F.count(_col(over)) == F.count(F.lit(1)), value)


def quadrature_sum(c: Column | str) -> Column:
    return F.sqrt(F.sum(_col(c) * _col(c)))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))
