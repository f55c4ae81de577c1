"""Hourly continuity: previous present hour per series and the gaps.

Three equal forms:

* ``lag_gaps``      -- ``lag`` over ``Window.partitionBy(key).orderBy(hour)``.
  Readable, but a window partitioned by the series key runs one task per key:
  with four regions only four tasks do the sort, whatever the cluster size.
* ``segmented_gaps`` -- the default.  The hour axis is cut into fixed segments;
  ``lag`` runs per (key, segment), so the sort is spread over
  keys x segments tasks.  The first row of a segment takes the last hour of
  the nearest earlier non-empty segment, found by a second, tiny window over
  one row per (key, segment).  Same result as ``lag_gaps``.
* ``gap_starts``    -- hash-parallel count form: hours whose successor hour is
  absent (an anti-join on (key, hour + 1)), minus each key's last hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions.timecols import epoch_hour

# One week of hours per segment.
DEFAULT_SEGMENT_HOURS = 24 * 7


def lag_gaps(keys: DataFrame, key: str, hour_col: str) -> DataFrame:
    """Rows whose previous row (same key, hour order) is not exactly one hour
    earlier.  Columns: key, hour, previous_hour, gap_hours (BIGINT).  A
    repeated hour shows as gap 0, as in the original check."""
    w = Window.partitionBy(key).orderBy(hour_col)
    prev = F.lag(hour_col).over(w)
    return (keys.select(key, hour_col, prev.alias("previous_hour"))
                .filter(F.col("previous_hour").isNotNull())
                .withColumn("gap_hours", epoch_hour(hour_col) - epoch_hour("previous_hour"))
                .filter(F.col("gap_hours") != 1))


def previous_in_order(keys: DataFrame, key: str, hour_col: str,
                      segment_hours: int = DEFAULT_SEGMENT_HOURS) -> DataFrame:
    """Adds ``previous_hour``: the previous row's hour within ``key`` (NULL for
    the first row), computed per (key, segment) plus a per-segment carry."""
    base = keys.select(key, hour_col).withColumn("_h", epoch_hour(hour_col))
    base = base.withColumn("_seg", F.floor(F.col("_h") / F.lit(segment_hours)).cast("long"))
    in_seg = base.withColumn(
        "_prev_in_seg",
        F.lag(hour_col).over(Window.partitionBy(key, "_seg").orderBy("_h")))
    # One row per (key, segment): its last hour, and the last hour of the
    # nearest earlier non-empty segment.  Spans x keys rows: small.
    carry = (base.groupBy(key, "_seg").agg(F.max_by(hour_col, "_h").alias("_last"))
                 .withColumn("_carry", F.lag("_last").over(Window.partitionBy(key).orderBy("_seg")))
                 .select(key, "_seg", "_carry"))
    # in_seg is already hash-partitioned on (key, _seg) by its window, so only
    # the small carry side is shuffled for this join.
    return (in_seg.join(carry, [key, "_seg"], "left")
                  .select(key, hour_col,
                          F.coalesce("_prev_in_seg", "_carry").alias("previous_hour")))


def segmented_gaps(keys: DataFrame, key: str, hour_col: str,
                   segment_hours: int = DEFAULT_SEGMENT_HOURS) -> DataFrame:
    """Same rows as ``lag_gaps``, computed with parallel segments."""
    return (previous_in_order(keys, key, hour_col, segment_hours)
            .filter(F.col("previous_hour").isNotNull())
            .withColumn("gap_hours", epoch_hour(hour_col) - epoch_hour("previous_hour"))
            .filter(F.col("gap_hours") != 1))


def gap_starts(keys: DataFrame, key: str, hour_col: str) -> DataFrame:
    """Distinct (key, hour) whose next hour is absent, excluding each key's
    last hour: one row per interior gap (repeated hours are not gaps here)."""
    k = keys.select(key, epoch_hour(hour_col).alias("_h")).distinct()
    nxt = k.select(key, (F.col("_h") - 1).alias("_h"))     # hours that have a successor
    last = k.groupBy(key).agg(F.max("_h").alias("_h"))
    return (k.join(nxt, [key, "_h"], "left_anti")
             .join(last, [key, "_h"], "left_anti")
             .select(key, "_h"))


def worst_gaps(gaps: DataFrame, k: int, key: str, hour_col: str) -> DataFrame:
    """Top-k gaps by length (ties by key, hour): a top-k sort, each task keeps
    only its k best rows before the single final merge."""
    return gaps.orderBy(F.col("gap_hours").desc(), F.col(key), F.col(hour_col)).limit(k)
