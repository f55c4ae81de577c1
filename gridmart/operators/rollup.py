"""Hourly roll-up of sub-hourly observations (a one-hour tumbling window).

``groupBy(key, hour)`` compiles to partial aggregation -> exchange on the
group keys -> final aggregation, so a hot region is combined map-side before
the shuffle and at most one row per (partition, region, hour) crosses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.predicates import exact_mean, first_non_null_by
from gridmart.functions.timecols import hour_key


def hourly_rollup(df: DataFrame, key: str, time_col: str, *, ntz: bool,
                  means: dict[str, str] | None = None,
                  firsts: dict[str, str] | None = None,
                  key_out: str | None = None, hour_col: str = "hour_utc",
                  count_col: str | None = None,
                  mean_scale: int | None = None, stored_hour: str | None = None) -> DataFrame:
    """Average ``means`` and take the first non-NULL value (in time order) of
    ``firsts`` per (key, hour).

    ``stored_hour`` names a column that holds the hour already.  Grouping by it
    needs no exchange where the input is bucketed by (key, that column).

    means / firsts map output column -> input column.  ``mean_scale`` switches
    the averages to an order-independent decimal sum (see ``exact_mean``).
    """
    aggs = [exact_mean(src, mean_scale).alias(out) for out, src in (means or {}).items()]
    aggs += [first_non_null_by(src, time_col).alias(out) for out, src in (firsts or {}).items()]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return (df.groupBy(F.col(key).alias(key_out or key),
                       (F.col(stored_hour) if stored_hour else hour_key(time_col, ntz)).alias(hour_col))
              .agg(*aggs))


def hour_keys(df: DataFrame, key: str, time_col: str, *, ntz: bool,
              key_out: str | None = None, hour_col: str = "hour_utc") -> DataFrame:
    """Distinct (key, hour) pairs of a series (the key set of its roll-up)."""
    return (df.select(F.col(key).alias(key_out or key),
                      hour_key(time_col, ntz).alias(hour_col))
              .distinct())
