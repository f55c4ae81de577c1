"""Calendars and expected (member x time) grids.

Grids are generated with ``explode(sequence(...))`` from one row per member:
no cross join, and the number of rows a member generates is the number of
days/hours in the requested span, which is bounded by the calendar and not by
the data volume.  Bounds are either literals or columns of the member rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.timecols import utc_literal



def _day() -> Column:
    return F.make_interval(days=F.lit(1))


def _hour() -> Column:
    return F.make_dt_interval(hours=F.lit(1))


def _date_lit(d) -> Column:
    return F.lit(d.isoformat() if isinstance(d, (_dt.date, _dt.datetime)) else d).cast("date")


def date_spine(spark: SparkSession, start, end, out: str = "day") -> DataFrame:
    """Every date from ``start`` to ``end`` inclusive (literal bounds)."""
    return spark.range(1).select(
        F.explode(F.sequence(_date_lit(start), _date_lit(end), _day())).alias(out))


def date_spine_of(df: DataFrame, date_expr: Column, out: str = "day") -> DataFrame:
    """Every date between the min and max of ``date_expr`` over ``df``; lazy,
    one aggregate and one generator."""
    return (df.agg(F.min(date_expr).alias("_lo"), F.max(date_expr).alias("_hi"))
              .filter(F.col("_lo").isNotNull())
              .select(F.explode(F.sequence("_lo", "_hi", _day())).alias(out)))


def hour_spine_of(df: DataFrame, lo_expr: Column, hi_expr: Column, out: str = "hour_utc") -> DataFrame:
    """Every hour between aggregate bounds of ``df`` (e.g. min/max of a time)."""
    return (df.agg(lo_expr.alias("_lo"), hi_expr.alias("_hi"))
              .filter(F.col("_lo").isNotNull())
              .select(F.explode(F.sequence("_lo", "_hi", _hour())).alias(out)))


def member_day_grid(members: DataFrame, key: str, start, end, out: str = "day") -> DataFrame:
    """(member, day) for every member row and every date in [start, end]."""
    return members.select(key, F.explode(F.sequence(_date_lit(start), _date_lit(end), _day())).alias(out))


def member_hour_grid(members: DataFrame, key: str, start, end, *, ntz: bool,
                     out: str = "hour_utc") -> DataFrame:
    """(member, hour) for every member row and every hour in [start, end]
    (UTC wall clocks given as text or naive datetimes)."""
    lo, hi = utc_literal(start, ntz), utc_literal(end, ntz)
    return members.select(key, F.explode(F.sequence(lo, hi, _hour())).alias(out))


def absent_from(grid: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Grid cells with no row in ``present`` (left-anti on the keys)."""
    return grid.join(present.select(*keys), keys, "left_anti")


def whole_day_bounds(df: DataFrame, time_col: str):
    """First hour of the first UTC day and last hour of the last UTC day of
    ``time_col``, as two collected UTC wall clocks (one small job).

    ``date_trunc`` returns TIMESTAMP even for NTZ input, and PySpark turns a
    collected TIMESTAMP into a wall clock of the Python process zone; the
    cast to NTZ (UTC under the pin) keeps the bounds zone-independent.
    """
    r = df.agg(F.date_trunc("day", F.min(time_col)).cast("timestamp_ntz").alias("lo"),
               F.date_trunc("day", F.max(time_col)).cast("timestamp_ntz").alias("hi")).first()
    if r["lo"] is None:
        return None, None
    return r["lo"], r["hi"] + _dt.timedelta(hours=23)
