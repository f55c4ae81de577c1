"""Predicate and aggregate helpers."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(columns: list[str]) -> Column:
    """``c1 IS NULL OR c2 IS NULL OR ...``"""
    return functools.reduce(operator.or_, [F.col(c).isNull() for c in columns])


def not_in(c: str, members: list) -> Column:
    """Negated membership; like SQL, a NULL operand is never flagged (NULLs are
    the null profile's job)."""
    return ~F.col(c).isin(members)


def exact_mean(c: str | Column, scale: int | None) -> Column:
    """Mean of a column.

    With ``scale`` set the sum is taken in ``DECIMAL(18, scale)`` and divided in
    double at the end: independent of summation order, hence identical across
    partitionings and engines.  With ``scale=None`` it is plain ``avg``.
    """
    col = F.col(c) if isinstance(c, str) else c
    if scale is None:
        return F.avg(col)
    return (F.sum(col.cast(f"decimal(18,{scale})")).cast("double")
            / F.count(col).cast("double"))


def first_non_null_by(value: str, order: str) -> Column:
    """Value at the smallest ``order`` among rows where ``value`` is not NULL.

    Deterministic (unlike ``first``) as long as ``order`` is unique in the
    group; ``min_by`` skips rows whose ordering is NULL.
    """
    v = F.col(value)
    return F.min_by(v, F.when(v.isNotNull(), F.col(order)))


def count_nulls(c: str) -> Column:
    """Number of NULLs; 0 (not NULL) over no rows."""
    return F.count_if(F.col(c).isNull())
