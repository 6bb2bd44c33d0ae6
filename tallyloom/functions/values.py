"""Arithmetic and conditional expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_zero(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(0))


def first_known(*cols: Column | str) -> Column:
    return F.coalesce(*cols)


def is_null(c: Column | str) -> Column:
    return _col(c).isNull()


def round2(c: Column | str) -> Column:
    """Two decimals, halves away from zero, as a double."""
    return F.round(c, 2).cast("double")


def pct(delta: Column | str, base: Column | str) -> Column:
    """``delta`` in percent of ``base``; null when the base is 0 or null."""
    return _col(delta).cast("double") * 100.0 / null_if_zero(_col(base).cast("double"))


def growth_pct(cur: Column | str, prev: Column | str) -> Column:
    """Change from ``prev`` to ``cur`` in percent.

    The difference is taken in the columns' own type, so that of two decimals is exact.
    """
    return round2(pct(_col(cur) - _col(prev), prev))


def mean(c: Column | str) -> Column:
    """Aggregate: mean of the non-null values as a double, from an exact sum."""
    return F.sum(c).cast("double") / null_if_zero(F.count(c))


def case(branches: Sequence[tuple[Column, object]], else_: object) -> Column:
    """First branch whose condition is true; a null condition is not true."""
    (condition, value), *rest = branches
    expr = F.when(condition, value)
    for condition, value in rest:
        expr = expr.when(condition, value)
    return expr.otherwise(else_)


def bucket(c: Column | str, lower_bounds: Sequence[tuple[int, str]], else_: str) -> Column:
    """Label of the first lower bound (given in descending order) that the value reaches."""
    return case([(_col(c) >= bound, label) for bound, label in lower_bounds], else_)


def concat_key(*cols: Column | str) -> Column:
    """The key columns as one string; null when any of them is.

    Ambiguous in general (1 || 23 is 12 || 3), so the sinks match on separate columns.
    """
    return F.concat(*[_col(c).cast("string") for c in cols])
