"""Bronze -> silver: typed instants, UTC and local calendar parts.

Local date and hour are computed explicitly from the instant and a zone, so
they do not depend on the session zone (which is pinned to UTC).  The UTC
date is added as the partition column: it is derived from the key's time, so
a key never moves between partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.timecols import (as_instant, hour_key, parse_offset_instant, parse_wall_ntz,
                                         period, to_local_wall, utc_wall)
from gridmart.schemas import LOCAL_ZONE, SILVER_PRICE, SILVER_WEATHER


def time_parts(df: DataFrame, time_col: str, zone: str = LOCAL_ZONE, *, ntz: bool,
               prefix: str = "") -> DataFrame:
    """Adds UTC date/hour and local wall time/date/hour of a time column.

    ``ntz``: the column is a UTC wall clock (TIMESTAMP_NTZ) rather than an
    instant.
    """
    wall = F.col(time_col) if ntz else utc_wall(time_col)
    local = to_local_wall(wall, zone)
    return df.withColumns({
        f"{prefix}utc_date": F.to_date(wall),
        f"{prefix}utc_hour": F.hour(wall),
        f"{prefix}local_time": local,
        f"{prefix}local_date": F.to_date(local),
        f"{prefix}local_hour": F.hour(local),
    })


def prices(bronze: DataFrame, zone: str = LOCAL_ZONE, granularity: str = "day") -> DataFrame:
    """Price bronze -> price silver (interval instants, local date/hour)."""
    typed = bronze.withColumns({
        "time_start": parse_offset_instant("time_start"),
        "time_end": parse_offset_instant("time_end"),
    })
    local = to_local_wall(utc_wall("time_start"), zone)
    out = typed.withColumns({
        "price_date": F.to_date(local),
        "price_hour": F.hour(local),
        "utc_date": period(F.to_date(utc_wall("time_start")), granularity),
    })
    return out.select(*SILVER_PRICE.fieldNames())


def weather(bronze: DataFrame, zone: str = LOCAL_ZONE, granularity: str = "day") -> DataFrame:
    """Weather bronze -> weather silver (UTC and local wall clocks, NTZ)."""
    typed = bronze.withColumn("weather_time_utc", parse_wall_ntz("weather_time_utc"))
    local = to_local_wall("weather_time_utc", zone)
    out = typed.withColumns({
        "weather_time_local": local,
        "weather_date": F.to_date(local),
        "weather_hour": F.hour(local),
        "utc_date": period(F.to_date("weather_time_utc"), granularity),
    })
    return out.select(*SILVER_WEATHER.fieldNames())


def with_hour(silver: DataFrame) -> DataFrame:
    """Adds ``hour_utc``, the hour of a silver row's time as an instant: the key
    that bucketed silver tables are laid out by."""
    price = "time_start" in silver.columns
    time = F.col("time_start") if price else as_instant("weather_time_utc")
    return silver.withColumn("hour_utc", hour_key(time, ntz=False))


def local_day_counts(silver_weather: DataFrame, days: list[str]) -> DataFrame:
    """Rows per (local date, region) for the given local dates: 23 on the
    spring DST change, 25 in autumn, 24 otherwise."""
    return (silver_weather.filter(F.col("weather_date").isin([F.lit(d).cast("date") for d in days]))
            .groupBy("weather_date", "region").agg(F.count(F.lit(1)).alias("rows")))

