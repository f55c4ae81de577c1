"""Stored aggregates of gold that merge, one row for each region and day.

A row holds what the analytics and the post-merge check need of a day: its rows,
for each measure the count, mean, sum of squared deviations, least and greatest
value, for each pair of measures the sum of products of deviations, and a sketch
of its distinct keys.  All of them merge, so a trend over years reads days, not
hours, and a load replaces the rows of the days it changed and no others.

The analytics here give what ``plans.analytics`` and ``operators.profiles`` give
of gold itself.  Distinct keys are an estimate within ``KEY_ERROR``; the exact
check (``profiles.key_stats``) stays beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators.upsert import Touched
from gridmart.schemas import GOLD, GOLD_KEYS, WEATHER_MEASURES
from gridmart.sources import tables
from gridmart.sources.tables import Layout, PathTable

GOLD_MEASURES = ["SEK_per_kWh", "EUR_per_kWh", *WEATHER_MEASURES]
GOLD_PAIRS = [("EUR_per_kWh", m) for m in WEATHER_MEASURES]

#: Log2 of a sketch's registers, and three standard errors of its estimate.
SKETCH_K = 14
KEY_ERROR = 3 * 1.04 / 2 ** (SKETCH_K / 2)


def _pair(a: str, b: str) -> str:
    return f"{a}__{b}"


def moments(df: DataFrame, by: list[Column | str], measures: list[str], pairs: list[tuple[str, str]] = (),
            keys: list[str] = ()) -> DataFrame:
    """One row for each group of ``by``: ``rows``, the moments of ``measures`` and
    of ``pairs`` (of rows that have both), and a sketch of the distinct ``keys``."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for m in measures:
        v = F.col(m).cast("double")
        aggs += [F.count(v).alias(f"{m}_n"), F.avg(v).alias(f"{m}_mean"),
                 (F.var_pop(v) * F.count(v)).alias(f"{m}_m2"), F.min(v).alias(f"{m}_min"), F.max(v).alias(f"{m}_max")]
    for a, b in pairs:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        p = _pair(a, b)
        aggs += [F.count(x).alias(f"{p}_n"), F.avg(x).alias(f"{p}_mean_a"), F.avg(y).alias(f"{p}_mean_b"),
                 (F.var_pop(x) * F.count(x)).alias(f"{p}_m2_a"), (F.var_pop(y) * F.count(y)).alias(f"{p}_m2_b"),
                 (F.covar_pop(x, y) * F.count(x)).alias(f"{p}_c")]
    if keys:
        whole = F.when(F.greatest(*[F.col(k).isNull().cast("int") for k in keys], F.lit(0)) == 0, F.xxhash64(*keys))
        aggs.append(F.hll_sketch_agg(whole, F.lit(SKETCH_K)).alias("keys_sketch"))
    return df.groupBy(*by).agg(*aggs)


def _total(m: str) -> Column:
    return F.sum(f"{m}_n")


def mean_of(m: str) -> Column:
    """The mean over merged rows (NULL without values)."""
    return F.try_divide(F.sum(F.col(f"{m}_n") * F.col(f"{m}_mean")), _total(m))


def _spread(n: str, mean_a: str, mean_b: str, own: str) -> Column:
    """Sum of products of deviations over merged rows: within them and between."""
    weighted_a, weighted_b = (F.sum(F.col(n) * F.col(c)) for c in (mean_a, mean_b))
    between = F.sum(F.col(n) * F.col(mean_a) * F.col(mean_b)) - F.try_divide(weighted_a * weighted_b, F.sum(n))
    return F.sum(own) + between


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def trend(state: DataFrame, key: str, day: str, m: str, digits: int | None = None,
          prefix: str = "price") -> DataFrame:
    """``analytics.monthly_trend``."""
    return state.groupBy(key, F.trunc(day, "month").alias("month")).agg(
        _r(mean_of(m), digits).alias(f"avg_{prefix}"), F.min(f"{m}_min").alias(f"min_{prefix}"),
        F.max(f"{m}_max").alias(f"max_{prefix}"))


def daily(state: DataFrame, key: str, day: str, measures: list[str], digits: int | None = None) -> DataFrame:
    """``analytics.daily_observations``: nothing is left to aggregate."""
    return state.select(key, F.col(day).alias("day"), F.col("rows").alias("hours"),
                        *[_r(F.col(f"{m}_mean"), digits).alias(f"avg_{m}") for m in measures])


def level(state: DataFrame, key: str, m: str, digits: int | None = None) -> DataFrame:
    """``analytics.level_vs_overall``."""
    per = state.groupBy(key).agg(F.sum(F.col(f"{m}_n") * F.col(f"{m}_mean")).alias("_s"), _total(m).alias("_n"))
    everything = Window.partitionBy()                      # of one row for each key
    mean, overall = F.try_divide("_s", "_n"), F.try_divide(F.sum("_s").over(everything), F.sum("_n").over(everything))
    return per.select(key, _r(mean, digits).alias("mean"), _r(overall, digits).alias("overall_mean"),
                      _r(mean - overall, digits).alias("difference"))


def correlation(state: DataFrame, key: str, a: str, b: str, digits: int | None = None) -> DataFrame:
    """``analytics.correlation`` (``pairs`` are the rows, as there)."""
    p = _pair(a, b)
    c = _spread(f"{p}_n", f"{p}_mean_a", f"{p}_mean_b", f"{p}_c")
    m2a = _spread(f"{p}_n", f"{p}_mean_a", f"{p}_mean_a", f"{p}_m2_a")
    m2b = _spread(f"{p}_n", f"{p}_mean_b", f"{p}_mean_b", f"{p}_m2_b")
    return state.groupBy(key).agg(F.sum("rows").alias("pairs"),
                                  _r(F.try_divide(c, F.sqrt(m2a * m2b)), digits).alias(f"corr_{a}_{b}"))


def volatility(state: DataFrame, key: str, m: str, digits: int | None = None) -> DataFrame:
    """``analytics.volatility``: the sample standard deviation."""
    m2 = _spread(f"{m}_n", f"{m}_mean", f"{m}_mean", f"{m}_m2")
    variance = F.when(_total(m) > 1, F.greatest(m2, F.lit(0.0)) / (_total(m) - 1))
    return state.groupBy(key).agg(_r(F.sqrt(variance), digits).alias(f"stddev_{m}"))


def null_profile(state: DataFrame, measures: list[str], suffix: str = "_nulls") -> DataFrame:
    """``profiles.null_profile`` of the measures."""
    return state.agg(*[F.coalesce(F.sum(F.col("rows") - F.col(f"{m}_n")), F.lit(0)).alias(f"{m}{suffix}")
                       for m in measures])


def value_profile(state: DataFrame, measures: list[str]) -> DataFrame:
    """``profiles.value_profile`` of the measures."""
    return state.agg(*[c for m in measures for c in (F.min(f"{m}_min").alias(f"min_{m}"),
                                                     F.max(f"{m}_max").alias(f"max_{m}"))])


def key_check(state: DataFrame) -> DataFrame:
    """One row: ``rows``, the estimate of distinct keys, and ``duplicates``: whether
    there are more rows than the estimate and its error allow.

    No duplicates found does not prove that there are none; ``profiles.key_stats``
    does."""
    estimate = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("keys_sketch")), F.lit(0))
    return state.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), estimate.alias("distinct_keys_estimate")) \
        .withColumn("duplicates", F.col("rows") > F.col("distinct_keys_estimate") * F.lit(1 + KEY_ERROR))


# The stored state of a layout's gold

def _gold_state(gold: DataFrame) -> DataFrame:
    day = F.to_date("hour_utc").alias("day")
    return moments(gold, ["region", day, "hour_date"], GOLD_MEASURES, GOLD_PAIRS, GOLD_KEYS)


def _table(spark: SparkSession, layout: Layout) -> PathTable:
    schema = _gold_state(spark.createDataFrame([], GOLD)).schema
    return PathTable(layout.path("_daily_state/gold"), T.StructType([T.StructField(f.name, f.dataType, True)
                                                                    for f in schema]), "hour_date")


def read(spark: SparkSession, layout: Layout) -> DataFrame:
    return _table(spark, layout).read(spark)


def refresh(spark: SparkSession, layout: Layout, touched: Touched | None = None) -> None:
    """The state of gold again: of the ``touched`` partitions, or of all of it
    where it was never kept or nothing is named.  A partition's rows are replaced
    as a whole, so repeating a refresh changes nothing."""
    table, gold = _table(spark, layout), tables.read(spark, layout.gold, GOLD)
    if touched is None or not table.exists(spark):
        table.overwrite(_gold_state(gold))
    else:
        table.replace(_gold_state(touched.rows_of(gold)), staged=False)
