"""Profiles and counts used by the data-quality checks.

Each returns a DataFrame; nothing is printed or collected here.  Counts are
BIGINT.  Where several numbers come from the same input they are computed in
one aggregation so the input is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.predicates import any_null, count_nulls, not_in


def null_profile(df: DataFrame, columns: list[str], suffix: str = "_nulls") -> DataFrame:
    """One row: number of NULLs per column (0, never NULL, on empty input)."""
    return df.agg(*[count_nulls(c).alias(f"{c}{suffix}") for c in columns])


def value_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: min and max per column."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


def time_range(df: DataFrame, col: str, lo: str = "min_hour", hi: str = "max_hour") -> DataFrame:
    return df.agg(F.min(col).alias(lo), F.max(col).alias(hi))


def row_count(df: DataFrame, out: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def counts_by(df: DataFrame, by: list[str | Column], out: str = "rows") -> DataFrame:
    """Rows per group (partial aggregation; a hot group is combined map-side)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))


def hour_coverage(df: DataFrame, by: list[str | Column], hour_expr: Column) -> DataFrame:
    """Per group: rows, first and last hour of day, distinct hours of day."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(hour_expr).alias("min_hour"),
        F.max(hour_expr).alias("max_hour"),
        F.count_distinct(hour_expr).alias("distinct_hours"))


def duplicate_keys(df: DataFrame, keys: list[str], out: str = "rows") -> DataFrame:
    """Keys present more than once, with their row count."""
    return counts_by(df, keys, out).filter(F.col(out) > 1)


def duplicate_histogram(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur exactly n times, for every n > 1."""
    return (duplicate_keys(df, keys, "copies")
            .groupBy("copies").agg(F.count(F.lit(1)).alias("keys")))


def key_stats(df: DataFrame, keys: list[str], time_col: str | None = None) -> DataFrame:
    """One row: rows, distinct keys, keys with duplicates (and the latest
    ``time_col`` if given) -- one shuffle over per-key partial counts."""
    extra = [F.max(time_col).alias("_t")] if time_col else []
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *extra)
    out = [F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
           F.count(F.lit(1)).alias("distinct_keys"),
           F.count_if(F.col("_n") > 1).alias("duplicate_keys")]
    if time_col:
        out.append(F.max("_t").alias(f"max_{time_col}"))
    return per_key.agg(*out)


def distinct_members(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def invalid_members(df: DataFrame, col: str, allowed: list) -> DataFrame:
    """Distinct values not in ``allowed`` (NULL is not listed: see null_profile)."""
    return df.select(col).filter(not_in(col, allowed)).distinct()


def invalid_interval(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose end is not after their start."""
    return df.filter(F.col(end) <= F.col(start))


def rows_with_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(any_null(columns))


def member_sets(present: DataFrame, col: str, expected: DataFrame, out: str = "member") -> DataFrame:
    """Expected members that are absent (``missing``) and present members that
    are not expected (``unexpected``): two anti-joins over distinct values."""
    p = present.select(F.col(col).alias(out)).filter(F.col(out).isNotNull()).distinct()
    e = expected.select(F.col(expected.columns[0]).alias(out)).distinct()
    missing = e.join(p, out, "left_anti").withColumn("status", F.lit("missing"))
    unexpected = p.join(e, out, "left_anti").withColumn("status", F.lit("unexpected"))
    return missing.unionByName(unexpected)
