"""Parallel arrays -> rows.

A feed that returns one object of equally long arrays (``time[]``,
``temperature[]``, ...) becomes one row per position with
``inline(arrays_zip(...))``: a generator inside the scan's task, no shuffle.
A shorter array is padded with NULL; ``length_mismatch`` reports such rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zip_explode(df: DataFrame, keep: list[str | Column], arrays: dict[str, str | Column],
                index: str | None = None) -> DataFrame:
    """One row per array position: the ``keep`` columns, an optional 1-based
    ``index`` and one column per entry of ``arrays`` (output name -> array)."""
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in arrays.items()]
    if index:
        longest = F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in cols]) if len(cols) > 1 \
            else F.coalesce(F.size(cols[0]), F.lit(0))
        # sequence(1, 0) would count down; empty arrays yield no index.
        idx = F.when(longest > 0, F.sequence(F.lit(1), longest)) \
               .otherwise(F.array().cast("array<int>")).cast("array<bigint>").alias(index)
        cols = [idx] + cols
    return df.select(*keep, F.inline(F.arrays_zip(*cols)))


def length_mismatch(df: DataFrame, keep: list[str], arrays: list[str],
                    reference: str) -> DataFrame:
    """Rows whose arrays are not all as long as ``reference``."""
    ref = F.size(reference)
    bad = None
    for a in arrays:
        cond = F.size(a) != ref
        bad = cond if bad is None else (bad | cond)
    def name(a: str) -> str:
        return a.replace(".", "_") + "_len"
    return df.filter(bad).select(*keep, ref.alias(name(reference)),
                                 *[F.size(a).alias(name(a)) for a in arrays])
