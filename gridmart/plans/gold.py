"""Silver x 2 -> gold: hourly price joined with hourly weather per region.

Both sides carry the same key types -- ``region`` string and ``hour_utc``
instant -- so the join needs no cast, and the price roll-up's hash
partitioning on (region, hour) can be reused by the join.  Silver tables that are
bucketed by these keys bring that partitioning from storage: then neither the
roll-up nor the join exchanges a row.  The common range
of the two feeds is found with one small aggregate job; its two bounds are
applied as literals on the raw time columns and on the partition columns, so
the silver scans prune files and row groups.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.timecols import (as_instant, hour_key, period,
                                         period_of, utc_literal, utc_wall)
from gridmart.operators import marks as marks_op
from gridmart.operators.joins import keyed_join, overlap_bounds
from gridmart.operators.rollup import hourly_rollup
from gridmart.schemas import GOLD, GOLD_KEYS, WEATHER_MEASURES

GOLD_COLUMNS = GOLD.fieldNames()
HOUR = _dt.timedelta(hours=1)


def _stored_hour(silver: DataFrame) -> str | None:
    """The hour column of a bucketed silver table (see ``sources.bucketed``)."""
    return "hour_utc" if "hour_utc" in silver.columns else None


def price_hourly(silver_prices: DataFrame, mean_scale: int | None = None) -> DataFrame:
    """Sub-hourly prices -> hourly: mean prices, first non-NULL exchange rate
    in time order.  ``mean_scale``: exact decimal means (see ``exact_mean``)."""
    return hourly_rollup(silver_prices, "region", "time_start", ntz=False,
                         means={"SEK_per_kWh": "SEK_per_kWh", "EUR_per_kWh": "EUR_per_kWh"},
                         firsts={"EXR": "EXR"}, mean_scale=mean_scale, stored_hour=_stored_hour(silver_prices))


def weather_hourly(silver_weather: DataFrame) -> DataFrame:
    """Hourly weather keyed like the price side (instant hour)."""
    hour = F.col("hour_utc") if _stored_hour(silver_weather) else hour_key(as_instant("weather_time_utc"), ntz=False)
    return silver_weather.select(
        "region", hour.alias("hour_utc"),
        "location", "latitude", "longitude", *WEATHER_MEASURES, "weather_code")


def join_hourly(ph: DataFrame, wh: DataFrame, granularity: str = "day") -> DataFrame:
    g = keyed_join(ph, wh, GOLD_KEYS)
    hour_date = period(F.to_date(utc_wall("hour_utc")), granularity)
    return g.withColumn("hour_date", hour_date).select(*GOLD_COLUMNS)


def _parts_from(lo: _dt.datetime, granularity: str):
    """Partition filter: periods at or after the one holding ``lo``."""
    return F.col("utc_date") >= F.lit(period_of(lo.date(), granularity))


def _price_window(silver_prices: DataFrame, lo: _dt.datetime, hi_excl: _dt.datetime,
                  granularity: str) -> DataFrame:
    """Price rows with ``lo <= time_start < hi_excl`` (UTC walls), pruned on
    the partition column too."""
    return silver_prices.filter(
        (F.col("time_start") >= utc_literal(lo, ntz=False))
        & (F.col("time_start") < utc_literal(hi_excl, ntz=False))
        & _parts_from(lo, granularity)
        & (F.col("utc_date") <= F.lit(period_of(hi_excl.date(), granularity))))


def _weather_window(silver_weather: DataFrame, lo: _dt.datetime, hi_excl: _dt.datetime,
                    granularity: str) -> DataFrame:
    return silver_weather.filter(
        (F.col("weather_time_utc") >= utc_literal(lo, ntz=True))
        & (F.col("weather_time_utc") < utc_literal(hi_excl, ntz=True))
        & _parts_from(lo, granularity)
        & (F.col("utc_date") <= F.lit(period_of(hi_excl.date(), granularity))))


def common_range(silver_prices: DataFrame, silver_weather: DataFrame):
    """First and last common hour of the two feeds, as UTC walls (or None)."""
    # the raw columns' minimum and maximum, truncated after: the order of
    # hours is that of times, and the scans read the column's own statistics
    p = silver_prices.agg(F.min("time_start").alias("lo"), F.max("time_start").alias("hi")) \
        .select(F.explode(F.array("lo", "hi")).alias("t")) \
        .select(utc_wall(hour_key("t", ntz=False)).alias("h"))
    w = silver_weather.agg(F.min("weather_time_utc").alias("lo"), F.max("weather_time_utc").alias("hi")) \
        .select(F.explode(F.array("lo", "hi")).alias("t")).select(hour_key("t", ntz=True).alias("h"))
    return overlap_bounds(p, "h", w, "h")


def common_range_of_walls(price: tuple, weather: tuple):
    """``common_range`` from the feeds' first and last times (UTC walls, None for
    an empty feed), as the footers of stored layers give them."""
    if None in (*price, *weather):
        return None, None
    hours = [[t.replace(minute=0, second=0, microsecond=0) for t in feed] for feed in (price, weather)]
    lo, hi = max(h[0] for h in hours), min(h[1] for h in hours)
    return (lo, hi) if lo <= hi else (None, None)


def build(spark: SparkSession, silver_prices: DataFrame, silver_weather: DataFrame,
          granularity: str = "day", mean_scale: int | None = None, bounds: tuple | None = None) -> DataFrame:
    """Full gold over the common hour range of the two feeds (``bounds``, where
    the caller knows it: see ``common_range_of_walls``)."""
    lo, hi = bounds or common_range(silver_prices, silver_weather)
    if lo is None:
        return spark.createDataFrame([], GOLD)
    ph = price_hourly(_price_window(silver_prices, lo, hi + HOUR, granularity), mean_scale)
    wh = weather_hourly(_weather_window(silver_weather, lo, hi + HOUR, granularity))
    return join_hourly(ph, wh, granularity)


def increment(spark: SparkSession, silver_prices: DataFrame, silver_weather: DataFrame,
              gold_target: DataFrame, *, lookback: _dt.timedelta | None = None,
              mark_scope: str = "region", granularity: str = "day", mean_scale: int | None = None,
              latest: _dt.datetime | None = None) -> DataFrame:
    """Gold rows for the hours after each region's high-water mark.

    mark_scope "region": one mark per region (a lagging region is caught up);
    "global": one mark over all regions (the original rule).  ``lookback``
    re-derives that much history before the mark, so late corrections reach
    gold through the upsert.  No target / no mark -> everything.
    """
    back = lookback or _dt.timedelta(0)
    marked = gold_target.filter(F.col("hour_utc").isNotNull())
    if mark_scope == "global":
        mark = latest or marked.agg(F.max(utc_wall("hour_utc")).alias("m")).first()["m"]
        if mark is None:
            return build(spark, silver_prices, silver_weather, granularity, mean_scale)
        lo = mark - back + HOUR           # hours strictly after the mark
        ph = price_hourly(silver_prices.filter(
            (F.col("time_start") >= utc_literal(lo, ntz=False)) & _parts_from(lo, granularity)), mean_scale)
        wh = weather_hourly(silver_weather.filter(
            (F.col("weather_time_utc") >= utc_literal(lo, ntz=True)) & _parts_from(lo, granularity)))
        return join_hourly(ph, wh, granularity)
    marks = marks_op.kept(marks_op.high_water_marks(marked, "region", "hour_utc"))
    lo = marks.agg(F.min(utc_wall("mark")).alias("lo")).first()["lo"]
    sp, sw = silver_prices, silver_weather
    if lo is not None:
        # A literal lower bound on the raw time and the partition column lets
        # the scans skip partitions, files and row groups.  It holds for the
        # regions that have a mark; a region without one takes all its history.
        floor = lo - back
        unmarked = marks_op.unmarked_members(sp, marks, "region")
        sp = marks_op.since_floor(sp, "region", (F.col("time_start") > utc_literal(floor, ntz=False))
                                  & _parts_from(floor, granularity), unmarked)
        sw = marks_op.since_floor(sw, "region", (F.col("weather_time_utc") > utc_literal(floor, ntz=True))
                                  & _parts_from(floor, granularity), unmarked)
    sp = sp.withColumn("_hour", hour_key("time_start", ntz=False))
    sw = sw.withColumn("_hour", hour_key(as_instant("weather_time_utc"), ntz=False))
    new_p = marks_op.increment(sp, marks, "region", "_hour", lookback=lookback)
    new_w = marks_op.increment(sw, marks, "region", "_hour", lookback=lookback)
    return join_hourly(price_hourly(new_p.drop("_hour"), mean_scale), weather_hourly(new_w.drop("_hour")),
                       granularity)
