"""Key alignment, range overlap, equi-joins, anti/semi joins.

Join strategy is left to Spark: with AQE on, a side that turns out small at
run time becomes a broadcast hash join (AQE checks the real size against
``spark.sql.adaptive.autoBroadcastJoinThreshold``); anything larger stays a
sort-merge join on the shuffled keys.  No hint is placed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.timecols import between_closed

def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns (``{old: new}``), keeping the column order."""
    return df.select([F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str],
               how: str = "inner") -> DataFrame:
    """Equi-join on identically named keys (USING join: one copy of each key).

    Both sides must carry the same key types; otherwise Spark inserts a cast
    and can no longer reuse the sides' hash partitioning.
    """
    return left.join(right, on=keys, how=how)


def missing_on_right(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``left`` with no match in ``right`` (left-anti).  Only the key
    columns of ``right`` are read."""
    return left.join(right.select(*keys), on=keys, how="left_anti")


def present_on_right(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key exists in ``right`` (left-semi).  Counts a
    left row once even if ``right`` repeats the key."""
    return left.join(right.select(*keys), on=keys, how="left_semi")


def overlap_bounds(left: DataFrame, left_col: str, right: DataFrame, right_col: str):
    """(max of the two minima, min of the two maxima) in one Spark job.

    Returns ``(None, None)`` if either side is empty or the ranges do not
    overlap.  Two scalars reach the driver, so the caller can filter with
    literals that are pushed into both scans.
    """
    lo = (left.agg(F.min(left_col).alias("lo"), F.max(left_col).alias("hi"))
          .unionByName(right.agg(F.min(right_col).alias("lo"), F.max(right_col).alias("hi"))))
    row = lo.agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"),
                 F.count_if(F.col("lo").isNull()).alias("empty_sides")).first()
    if row["empty_sides"] or row["lo"] is None or row["hi"] is None or row["lo"] > row["hi"]:
        return None, None
    return row["lo"], row["hi"]


def within(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Closed range filter on literal bounds of the column's own type; an
    empty range gives no rows."""
    if lo is None or hi is None:
        return df.filter(F.lit(False))
    ntz = isinstance(df.schema[col].dataType, T.TimestampNTZType)
    return df.filter(between_closed(col, lo, hi, ntz))
