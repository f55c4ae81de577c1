"""Analytical read queries on the gold table (monthly trends, daily
observations, correlations, regional spreads, volatility, hour-of-day
profile).  All are single ``groupBy`` aggregations with partial aggregation;
the spread is a conditional aggregate (a two-column pivot) rather than a
self-join, so the gold table is scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions.predicates import exact_mean


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def monthly_trend(df: DataFrame, key: str, time_col: str, value: str, *,
                  mean_scale: int | None = None, prefix: str = "price") -> DataFrame:
    """Per (key, calendar month): average, minimum and maximum of ``value``."""
    month = F.trunc(F.to_date(time_col), "month")
    return df.groupBy(F.col(key), month.alias("month")).agg(
        exact_mean(value, mean_scale).alias(f"avg_{prefix}"),
        F.min(value).alias(f"min_{prefix}"),
        F.max(value).alias(f"max_{prefix}"))


def daily_observations(gold: DataFrame, key: str, hour_col: str, measures: list[str],
                       digits: int | None = None) -> DataFrame:
    """Per (key, UTC day): hours present and the daily mean of each measure."""
    return gold.groupBy(F.col(key), F.to_date(hour_col).alias("day")).agg(
        F.count(F.lit(1)).alias("hours"),
        *[_r(F.avg(m), digits).alias(f"avg_{m}") for m in measures])


def correlation(gold: DataFrame, key: str, a: str, b: str, digits: int | None = None,
                out: str | None = None) -> DataFrame:
    """Pearson correlation of two measures per key (NULL for fewer than two
    pairs)."""
    return gold.groupBy(key).agg(
        F.count(F.lit(1)).alias("pairs"),
        _r(F.corr(a, b), digits).alias(out or f"corr_{a}_{b}"))


def pair_spread(gold: DataFrame, key: str, hour_col: str, measure: str,
                left: str, right: str, digits: int | None = None) -> DataFrame:
    """Per UTC day: mean of ``measure`` for member ``left`` minus the mean for
    member ``right`` (NULL when either is absent that day)."""
    day = F.to_date(hour_col)
    lhs = _r(F.avg(F.when(F.col(key) == left, F.col(measure))), digits)
    rhs = _r(F.avg(F.when(F.col(key) == right, F.col(measure))), digits)
    # With ``digits`` the spread is that of the rounded means it is shown with.
    return (gold.filter(F.col(key).isin(left, right))
                .groupBy(day.alias("day"))
                .agg(lhs.alias(f"avg_{left}"), rhs.alias(f"avg_{right}"))
                .withColumn("spread", _r(F.col(f"avg_{left}") - F.col(f"avg_{right}"), digits)))


def level_vs_overall(gold: DataFrame, key: str, measure: str, digits: int | None = None) -> DataFrame:
    """Per key: its mean, the overall mean and the difference."""
    # The window spans the aggregated frame: one row per key, not the data.
    per = gold.groupBy(key).agg(F.sum(measure).alias("_s"), F.count(measure).alias("_n"))
    everything = Window.partitionBy()
    tot = F.sum("_s").over(everything)
    cnt = F.sum("_n").over(everything)
    return per.select(key, _r(F.col("_s") / F.col("_n"), digits).alias("mean"),
                      _r(tot / cnt, digits).alias("overall_mean"),
                      _r(F.col("_s") / F.col("_n") - tot / cnt, digits).alias("difference"))


def volatility(df: DataFrame, key: str, measure: str, digits: int | None = None) -> DataFrame:
    """Sample standard deviation of a measure per key."""
    return df.groupBy(key).agg(_r(F.stddev_samp(measure), digits).alias(f"stddev_{measure}"))


def hour_of_day_profile(df: DataFrame, time_col: str, measure: str, *,
                        mean_scale: int | None = None) -> DataFrame:
    """Mean of a measure per hour of day (0-23)."""
    return df.groupBy(F.hour(time_col).alias("hour_of_day")).agg(
        exact_mean(measure, mean_scale).alias(f"avg_{measure}"),
        F.count(measure).alias("observations"))
