"""Data-quality checks and the PASS/FAIL gate.

Each ``check_*`` returns a small DataFrame ``(check, status, detail)`` whose
numbers are aggregated by Spark; ``report`` unions them and ``enforce``
collects only that report (a handful of rows) and raises when any check
failed.  ``status`` is PASS, FAIL or INFO (informational, never fails).

Compared with the original gate, two vacuous passes are closed: hourly
continuity and day completeness are also checked against an expected
(member x time) grid, so a missing head, tail or whole day is reported.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.predicates import any_null
from gridmart.functions.timecols import day_range
from gridmart.operators import gaps, grids, profiles
from gridmart.operators.joins import missing_on_right

# Names of the checks as published, but those that the label and
# source names complete ("Duplicate Gold keys", "Gold rows = distinct keys",
# "Gold keys mapped to Electricity", "Gold keys mapped to Weather").
REGION_COMPLETENESS = "Region completeness"
HOURLY_CONTINUITY = "Hourly continuity"
REQUIRED_NOT_NULL = "Required Gold fields not null"
DST_DAYS_COMPLETE = "DST UTC day completeness"


class QualityGateError(RuntimeError):
    """At least one enforced check failed."""

    def __init__(self, failed: list[str], rows: list):
        self.failed = failed
        self.rows = rows
        super().__init__("quality gate FAILED: " + ", ".join(failed))


def _status(passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _one(df_one_row: DataFrame, name: str, status: Column, detail: Column) -> DataFrame:
    return df_one_row.select(F.lit(name).alias("check"), status.alias("status"),
                             detail.alias("detail"))


def _is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def check_keys(df: DataFrame, keys: list[str], label: str = "Gold") -> DataFrame:
    """Rows equal distinct keys, and no key is duplicated: two rows from one
    aggregation over the per-key counts."""
    s = profiles.key_stats(df, keys)
    r1 = F.struct(F.lit(f"{label} rows = distinct keys").alias("check"),
                  _status(F.col("rows") == F.col("distinct_keys")).alias("status"),
                  F.format_string("rows=%d, distinct_keys=%d", "rows", "distinct_keys").alias("detail"))
    r2 = F.struct(F.lit(f"Duplicate {label} keys").alias("check"),
                  _status(F.col("duplicate_keys") == 0).alias("status"),
                  F.format_string("repeated=%d", "duplicate_keys").alias("detail"))
    return s.select(F.inline(F.array(r1, r2)))


def per_key_counts(df: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """One row per key: its rows (``_n``) and those with a NULL in a required
    column (``_nulls``).  Every check that needs keys, hours or day counts can
    read this instead of the table."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                 F.count_if(any_null(required)).alias("_nulls"))


def check_basics(df: DataFrame, keys: list[str], required: list[str], hour_col: str,
                 label: str = "Gold", not_null_name: str = "Required fields not null",
                 range_name: str = "Time range") -> DataFrame:
    """``check_keys`` + ``check_not_null`` + ``info_time_range`` from one
    aggregation over per-key partial counts (one scan, one shuffle)."""
    return check_basics_of(per_key_counts(df, keys, required), hour_col, label, not_null_name, range_name)


def check_basics_of(per_key: DataFrame, hour_col: str, label: str = "Gold",
                    not_null_name: str = "Required fields not null",
                    range_name: str = "Time range") -> DataFrame:
    """``check_basics`` of stored ``per_key_counts``."""
    a = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("long").alias("nulls"),
        F.min(hour_col).cast("string").alias("lo"), F.max(hour_col).cast("string").alias("hi"))
    rows = [
        F.struct(F.lit(f"{label} rows = distinct keys").alias("check"),
                 _status(F.col("rows") == F.col("distinct_keys")).alias("status"),
                 F.format_string("rows=%d, distinct_keys=%d", "rows", "distinct_keys").alias("detail")),
        F.struct(F.lit(f"Duplicate {label} keys").alias("check"),
                 _status(F.col("duplicate_keys") == 0).alias("status"),
                 F.format_string("repeated=%d", "duplicate_keys").alias("detail")),
        F.struct(F.lit(not_null_name).alias("check"), _status(F.col("nulls") == 0).alias("status"),
                 F.format_string("rows_lacking_a_value=%d", "nulls").alias("detail")),
        F.struct(F.lit(range_name).alias("check"), F.lit("INFO").alias("status"),
                 F.format_string("min=%s, max=%s", F.coalesce("lo", F.lit("-")),
                                 F.coalesce("hi", F.lit("-"))).alias("detail")),
    ]
    return a.select(F.inline(F.array(*rows)))


def check_no_rows(df: DataFrame, name: str, what: str) -> DataFrame:
    """A list of faults is empty."""
    return _one(df.agg(F.count(F.lit(1)).alias("n")), name, _status(F.col("n") == 0),
                F.format_string(f"{what}=%d", "n"))


def check_members(df: DataFrame, col: str, expected: DataFrame, name: str) -> DataFrame:
    """Set equality of present and expected members; tells how many differ and
    the first of each kind (a corrupted column may hold any number)."""
    sets = profiles.member_sets(df, col, expected)
    missing, odd = F.col("status") == "missing", F.col("status") == "unexpected"
    agg = sets.agg(F.count_if(missing).alias("m"), F.count_if(odd).alias("u"),
                   F.min(F.when(missing, F.col("member"))).alias("m1"),
                   F.min(F.when(odd, F.col("member"))).alias("u1"),
                   F.count(F.lit(1)).alias("n"))
    return _one(agg, name, _status(F.col("n") == 0),
                F.format_string("missing=%d (first: %s), unexpected=%d (first: %s)",
                                "m", F.coalesce("m1", F.lit("-")), "u", F.coalesce("u1", F.lit("-"))))


def check_continuity(df: DataFrame, key: str, hour_col: str, name: str = HOURLY_CONTINUITY) -> DataFrame:
    """Interior gaps between consecutive present hours of a key."""
    g = gaps.segmented_gaps(df.select(key, hour_col), key, hour_col)
    agg = g.agg(F.count(F.lit(1)).alias("n"))
    return _one(agg, name, _status(F.col("n") == 0), F.format_string("unexpected_gaps=%d", "n"))


def check_mapped(df: DataFrame, other_keys: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Every key of ``df`` exists in ``other_keys``."""
    miss = missing_on_right(df.select(*keys).distinct(), other_keys, keys)
    agg = miss.agg(F.count(F.lit(1)).alias("n"))
    return _one(agg, name, _status(F.col("n") == 0), F.format_string("missing_keys=%d", "n"))


def key_presence(frames: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """One row per distinct key over all ``frames`` with one boolean column
    ``in_<name>`` per frame.

    A union of the key columns tagged by frame, grouped by key: one shuffle
    of partial aggregates (a hot key is combined map-side), instead of one
    anti-join per pair of frames.
    """
    names = list(frames)
    tagged = [f.select(*keys, F.lit(1 << i).alias("_bit")) for i, f in enumerate(frames.values())]
    u = functools.reduce(lambda a, b: a.unionByName(b), tagged)
    per_key = u.groupBy(*keys).agg(F.bit_or("_bit").alias("_mask"))
    return per_key.select(*keys, *[((F.col("_mask").bitwiseAND(F.lit(1 << i))) != 0).alias(f"in_{n}")
                                   for i, n in enumerate(names)])


def check_mappings(df: DataFrame, sources: dict[str, DataFrame], keys: list[str],
                   label: str = "Gold") -> DataFrame:
    """For every source: keys of ``df`` missing in it (enforced) and its keys
    missing in ``df`` (informational), all from one ``key_presence`` pass."""
    p = key_presence({"_target": df, **sources}, keys)
    aggs = []
    for n in sources:
        aggs.append(F.count_if(F.col("in__target") & ~F.col(f"in_{n}")).alias(f"miss_{n}"))
        aggs.append(F.count_if(F.col(f"in_{n}") & ~F.col("in__target")).alias(f"only_{n}"))
    a = p.agg(*aggs)
    rows = []
    for n in sources:
        rows.append(F.struct(F.lit(f"{label} keys mapped to {n}").alias("check"),
                             _status(F.col(f"miss_{n}") == 0).alias("status"),
                             F.format_string("missing_keys=%d", f"miss_{n}").alias("detail")))
    for n in sources:
        rows.append(F.struct(F.lit(f"{n.capitalize()}-only keys").alias("check"),
                             F.lit("INFO").alias("status"),
                             F.format_string("source_only_keys=%d", f"only_{n}").alias("detail")))
    return a.select(F.inline(F.array(*rows)))


def check_not_null(df: DataFrame, columns: list[str], name: str = "Required fields not null") -> DataFrame:
    agg = df.agg(F.count_if(any_null(columns)).alias("n"))
    return _one(agg, name, _status(F.col("n") == 0),
                F.format_string("rows_lacking_a_value=%d", "n"))


def day_exceptions(df: DataFrame, key: str, hour_col: str, members: DataFrame,
                   days: list[str] | None = None, expected: int = 24,
                   rows: str | None = None) -> DataFrame:
    """(member, UTC day, rows) of every grid cell whose row count is not
    ``expected``; an absent day shows with 0 rows.

    ``days``: the days to check (e.g. the DST change days), which are cut out
    by the raw time before anything is grouped; default every day between the
    first and last row.  ``rows``: a column that holds how many rows each row
    stands for.
    """
    day = F.to_date(hour_col)
    if days is not None:
        df = df.filter(functools.reduce(lambda a, b: a | b,
                                        [day_range(hour_col, d, ntz=_is_ntz(df, hour_col)) for d in days],
                                        F.lit(False)))
    counts = df.groupBy(F.col(key), day.alias("day")).agg(
        F.sum(F.col(rows) if rows else F.lit(1)).alias("rows"))
    m = members.select(F.col(members.columns[0]).alias(key)).distinct()
    if days is not None:
        grid = m.select(key, F.explode(F.array(*[F.lit(d).cast("date") for d in days])).alias("day"))
    else:
        bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).first()
        if bounds["lo"] is None:
            grid = m.select(key, F.lit(None).cast("date").alias("day")).filter(F.lit(False))
        else:
            grid = grids.member_day_grid(m, key, bounds["lo"], bounds["hi"])
    return (grid.join(counts, [key, "day"], "left")
                .select(key, "day", F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("rows"))
                .filter(F.col("rows") != expected))


def check_day_completeness(df: DataFrame, key: str, hour_col: str, members: DataFrame,
                           days: list[str] | None = None, expected: int = 24,
                           name: str = "UTC day completeness", rows: str | None = None) -> DataFrame:
    """Every (member, UTC day) of the grid holds exactly ``expected`` rows.  A
    day with no row counts as wrong, which a group-only check misses."""
    wrong = day_exceptions(df, key, hour_col, members, days, expected, rows)
    agg = wrong.agg(F.count(F.lit(1)).alias("n"))
    return _one(agg, name, _status(F.col("n") == 0),
                F.format_string("unexpected_day_counts=%d", "n"))


def check_expected_grid(df: DataFrame, key: str, hour_col: str, members: DataFrame,
                        start, end, name: str = "Expected hourly grid") -> DataFrame:
    """Every (member, hour) in [start, end] is present (head and tail too)."""
    m = members.select(F.col(members.columns[0]).alias(key)).distinct()
    grid = grids.member_hour_grid(m, key, start, end, ntz=_is_ntz(df, hour_col), out=hour_col)
    missing = grids.absent_from(grid, df, [key, hour_col])
    agg = missing.agg(F.count(F.lit(1)).alias("n"))
    return _one(agg, name, _status(F.col("n") == 0), F.format_string("missing_hours=%d", "n"))


def info_time_range(df: DataFrame, hour_col: str, name: str = "Time range") -> DataFrame:
    agg = df.agg(F.min(hour_col).cast("string").alias("lo"), F.max(hour_col).cast("string").alias("hi"))
    return _one(agg, name, F.lit("INFO"),
                F.format_string("min=%s, max=%s", F.coalesce("lo", F.lit("-")), F.coalesce("hi", F.lit("-"))))


def report(checks: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), checks)


def enforce(rep: DataFrame) -> list:
    """Collect the report (one row per check) and raise if any FAILed."""
    rows = rep.collect()
    failed = [r["check"] for r in rows if r["status"] == "FAIL"]
    if failed:
        raise QualityGateError(failed, rows)
    return rows
