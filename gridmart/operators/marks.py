"""Planning of incremental work: high-water marks, missing dates, the
increment filter.

The reference keeps one global mark and takes rows strictly after it.  That
loses a region that lags behind and any correction to an already loaded
day.  Here marks are per key, and a lookback re-reads a window before the
mark (the upsert downstream makes re-reading idempotent).  A key without a
mark takes everything.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.timecols import feed_local_date, utc_literal
from gridmart.operators.grids import absent_from, member_day_grid


def high_water_marks(df: DataFrame, key: str, time_col: str, out: str = "mark") -> DataFrame:
    """Latest time per key: one row per key (partial aggregation)."""
    return df.groupBy(key).agg(F.max(time_col).alias(out))


def global_mark(df: DataFrame, time_col: str):
    """One latest time over all keys (the reference's form), collected."""
    return df.agg(F.max(time_col).alias("m")).first()["m"]


def latest_date(df: DataFrame, text_col: str, out: str = "latest_date") -> DataFrame:
    """Latest feed date, read as the leading ``yyyy-MM-dd`` of raw text."""
    return df.agg(F.max(feed_local_date(text_col)).alias(out))


def missing_dates(loaded: DataFrame, key: str, date_col: str, members: DataFrame,
                  start, end, out: str = "day") -> DataFrame:
    """(member, day) in [start, end] with no loaded row.

    Finds holes anywhere in the span, not only days after the latest loaded
    date, so a missing landing file in the middle is re-requested.
    """
    grid = member_day_grid(members.select(key).distinct(), key, start, end, out=out)
    present = loaded.select(F.col(key), F.col(date_col).alias(out)).distinct()
    return absent_from(grid, present, [key, out])


# Days of one segment of the calendar.
SEGMENT_DAYS = 28


def missing_ranges(loaded: DataFrame, key: str, date_col: str, members: DataFrame, start, end,
                   segment_days: int = SEGMENT_DAYS) -> DataFrame:
    """``missing_dates`` as ranges: (member, first_day, last_day, days), one row
    for each hole, as a request takes a start and an end.

    No day grid is made.  The present days of a member are ordered within
    segments of the calendar, so that one member's days spread over many tasks;
    a segment's first day looks back to the last day of the nearest earlier
    segment, found among one row for each (member, segment), so a hole that
    crosses segments, or spans empty ones, is still one row."""
    first, last = (F.unix_date(F.lit(d).cast("date")).cast("long") for d in (start, end))
    wanted = members.select(key).distinct()
    present = loaded.select(F.col(key), F.unix_date(F.col(date_col).cast("date")).cast("long").alias("_d")) \
        .filter(F.col("_d").between(first, last)).distinct().join(wanted, key, "left_semi") \
        .withColumn("_seg", F.floor(F.col("_d") / F.lit(segment_days)).cast("long"))
    inside = present.withColumn("_prev", F.lag("_d").over(Window.partitionBy(key, "_seg").orderBy("_d")))
    ends = present.groupBy(key, "_seg").agg(F.max("_d").alias("_last"))
    carry = ends.select(key, "_seg", F.lag("_last").over(Window.partitionBy(key).orderBy("_seg")).alias("_carry"))
    before = inside.join(carry, [key, "_seg"]).select(
        key, (F.coalesce("_prev", "_carry", first - 1) + 1).alias("_from"), (F.col("_d") - 1).alias("_to"))
    after = ends.groupBy(key).agg(F.max("_last").alias("_last")).select(
        key, (F.col("_last") + 1).alias("_from"), last.alias("_to"))
    never = wanted.join(ends.select(key), key, "left_anti").select(key, first.alias("_from"), last.alias("_to"))
    holes = before.unionByName(after).unionByName(never).filter(F.col("_from") <= F.col("_to"))
    return holes.select(key, F.date_from_unix_date(F.col("_from").cast("int")).alias("first_day"),
                        F.date_from_unix_date(F.col("_to").cast("int")).alias("last_day"),
                        (F.col("_to") - F.col("_from") + 1).alias("days"))


def increment(source: DataFrame, marks: DataFrame, key: str, time_col: str, *,
              mark_col: str = "mark", lookback: _dt.timedelta | None = None,
              keep_null_time: bool = False) -> DataFrame:
    """Rows of ``source`` after their key's mark (strict), or after
    ``mark - lookback``.  Keys without a mark keep all rows; rows without a
    time are kept on demand.

    ``marks`` has one row per key; whether it is broadcast is the planner's to
    judge by its size.
    """
    m = marks.select(key, F.col(mark_col).alias("_mark"))
    threshold = F.col("_mark")
    if lookback is not None:
        secs = int(lookback.total_seconds())
        threshold = F.col("_mark") - F.make_dt_interval(secs=F.lit(secs))
    wanted = F.col("_mark").isNull() | (F.col(time_col) > threshold)
    if keep_null_time:
        wanted = wanted | F.col(time_col).isNull()
    return source.join(m, key, "left").filter(wanted).drop("_mark").select(*source.columns)


def global_increment(source: DataFrame, time_col: str, mark) -> DataFrame:
    """The reference's rule: strictly after one global mark; no mark -> all.
    ``mark`` is a UTC wall clock; it does not depend on any zone."""
    if mark is None:
        return source
    ntz = isinstance(source.schema[time_col].dataType, T.TimestampNTZType)
    return source.filter(F.col(time_col) > utc_literal(mark, ntz=ntz))


#: Up to so many keys are broadcast (a few dozen bytes each), so that the rows of
#: the other side are not dealt out by key; more are joined by a shuffle.
MAX_BROADCAST_MEMBERS = 100_000


def kept(members: DataFrame) -> DataFrame:
    """Marks or keys computed once, in the shared folder, and broadcast in joins
    if their count allows."""
    m = members.checkpoint(eager=True)
    return F.broadcast(m) if m.count() <= MAX_BROADCAST_MEMBERS else m


def unmarked_members(source: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Keys of ``source`` (the NULL key included) that have no mark, as a table
    kept in the shared folder.  Reads one column of the source."""
    m = marks.select(F.col(key).alias("_marked"))
    return kept(source.select(key).distinct().join(m, F.col(key).eqNullSafe(F.col("_marked")), "left_anti"))


def since_floor(source: DataFrame, key: str, recent: Column, unmarked: DataFrame) -> DataFrame:
    """Rows that can lie after their key's mark: those ``recent`` by a literal
    floor under all marks, which the scan prunes by, and every row of a key
    without a mark.  Where no key lacks one, only the pruned scan remains."""
    pruned = source.filter(recent)
    if unmarked.isEmpty():
        return pruned
    new = unmarked.select(F.col(key).alias("_new"))
    is_new = F.col(key).eqNullSafe(F.col("_new"))
    return pruned.join(new, is_new, "left_anti").unionByName(source.join(new, is_new, "left_semi"))
