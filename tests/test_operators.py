"""Roll-up, gaps (three forms), grids, marks, upsert, arrays."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridmart.operators import arrays, gaps, grids, marks, rollup, upsert

H0 = dt.datetime(2024, 3, 1)


def test_rollup_means_and_first_non_null(spark):
    rows = [("SE1", H0 + dt.timedelta(minutes=m), v, e)
            for m, v, e in [(0, 1.0, None), (15, 2.0, 11.0), (30, 3.0, 12.0), (45, 6.0, 13.0)]]
    df = spark.createDataFrame(rows, "region string, t timestamp, p double, exr double")
    r = rollup.hourly_rollup(df, "region", "t", ntz=False, means={"p": "p"},
                             firsts={"exr": "exr"}, count_col="n").first()
    assert (r.p, r.exr, r.n) == (3.0, 11.0, 4)          # C2, C24


def _keys(spark, hours_by_region):
    rows = [(r, H0 + dt.timedelta(hours=h)) for r, hs in hours_by_region.items() for h in hs]
    return spark.createDataFrame(rows, "region string, hour_utc timestamp_ntz")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.sampled_from(["a", "b", "c"]),
                       st.sets(st.integers(0, 200), min_size=1, max_size=40), min_size=1))
def test_gap_forms_agree(spark, hours_by_region):
    k = _keys(spark, hours_by_region)
    lag = sorted(tuple(r) for r in gaps.lag_gaps(k, "region", "hour_utc").collect())
    seg = sorted(tuple(r) for r in gaps.segmented_gaps(k, "region", "hour_utc", segment_hours=7).collect())
    assert lag == seg
    assert gaps.gap_starts(k, "region", "hour_utc").count() == len(lag)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 60)), min_size=1, max_size=40))
def test_gap_forms_agree_with_repeated_hours(spark, pairs):
    rows = [(r, H0 + dt.timedelta(hours=h)) for r, h in pairs]
    k = spark.createDataFrame(rows, "region string, hour_utc timestamp_ntz")
    lag = sorted(tuple(r) for r in gaps.lag_gaps(k, "region", "hour_utc").collect())
    seg = sorted(tuple(r) for r in gaps.segmented_gaps(k, "region", "hour_utc", segment_hours=5).collect())
    assert lag == seg                                   # repeated hours show as gap 0 in both


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.integers(0, 30), max_size=15), st.sets(st.integers(0, 30), max_size=15))
def test_upsert_twice_equals_once(spark, target_ids, source_ids):
    t = spark.createDataFrame([(i, float(i)) for i in sorted(target_ids)], "id long, v double")
    s = spark.createDataFrame([(i, -float(i)) for i in sorted(source_ids)], "id long, v double")
    once = upsert.upsert_frame(t, s, ["id"])
    twice = upsert.upsert_frame(once, s, ["id"])
    got = sorted(tuple(r) for r in once.collect())
    assert got == sorted(tuple(r) for r in twice.collect())
    expect = {i: float(i) for i in target_ids} | {i: -float(i) for i in source_ids}
    assert got == sorted(expect.items())


def test_gaps_see_interior_only_grid_sees_tail(spark):
    k = _keys(spark, {"a": [0, 1, 2, 4, 5], "b": [0, 1, 2, 3, 4, 5], "c": [0, 1, 2, 3]})
    g = gaps.segmented_gaps(k, "region", "hour_utc").collect()
    assert [(r.region, r.gap_hours) for r in g] == [("a", 2)]      # C12 interior
    members = k.select("region").distinct()
    grid = grids.member_hour_grid(members, "region", H0, H0 + dt.timedelta(hours=5), ntz=True)
    missing = grids.absent_from(grid, k, ["region", "hour_utc"]).collect()
    assert sorted((r.region, r.hour_utc.hour) for r in missing) == [("a", 3), ("c", 4), ("c", 5)]


def test_missing_dates_finds_holes_not_only_tail(spark):
    loaded = spark.createDataFrame(
        [("SE1", dt.date(2024, 1, d)) for d in (1, 2, 4)] + [("SE2", dt.date(2024, 1, d)) for d in (1, 2, 3, 4)],
        "region string, day date")
    members = spark.createDataFrame([("SE1",), ("SE2",), ("SE3",)], "region string")
    out = marks.missing_dates(loaded, "region", "day", members, dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    got = sorted((r.region, r.day.day) for r in out.collect())
    assert got == [("SE1", 3), ("SE1", 5), ("SE2", 5)] + [("SE3", d) for d in range(1, 6)]   # C25


def test_increment_marks(spark):
    src = spark.createDataFrame([("a", H0 + dt.timedelta(hours=h)) for h in range(10)] +
                                [("b", H0 + dt.timedelta(hours=h)) for h in range(10)],
                                "k string, t timestamp_ntz")
    m = spark.createDataFrame([("a", H0 + dt.timedelta(hours=6))], "k string, mark timestamp_ntz")
    strict = marks.increment(src, m, "k", "t")
    assert strict.filter("k = 'a'").count() == 3 and strict.filter("k = 'b'").count() == 10
    back = marks.increment(src, m, "k", "t", lookback=dt.timedelta(hours=2))
    assert back.filter("k = 'a'").count() == 5


def test_upsert_frame_twice_equals_once_and_refuses_duplicates(spark):
    t = spark.createDataFrame([(i, float(i)) for i in range(10)], "id long, v double")
    s = spark.createDataFrame([(i, float(i) * 10) for i in range(5, 15)], "id long, v double")
    once = upsert.upsert_frame(t, s, ["id"])
    twice = upsert.upsert_frame(once, s, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 15 and once.filter("id = 7").first().v == 70.0
    dup = s.unionByName(s.limit(1))
    with pytest.raises(upsert.DuplicateSourceKeys):       # C11 / T25
        upsert.upsert_frame(t, dup, ["id"])


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "k long, o long, v string")
    got = sorted((r.k, r.v) for r in upsert.latest_per_key(df, ["k"], "o").collect())
    assert got == [(1, "new"), (2, "only")]


def _files(path):
    out = {}
    for d, _, fs in os.walk(path):
        for f in fs:
            if f.endswith(".parquet"):
                p = os.path.join(d, f)
                out[p] = os.path.getmtime(p)
    return out


def test_upsert_path_rewrites_only_touched_partitions(spark, scratch):
    target = os.path.join(scratch, "t")
    base = spark.createDataFrame([(i, float(i), dt.date(2024, 1, 1 + i % 3)) for i in range(30)],
                                 "id long, v double, day date")
    assert upsert.upsert_path(spark, target, base, ["id"], "day")[0] == 30
    before = _files(target)
    src = spark.createDataFrame([(0, -1.0, dt.date(2024, 1, 1)), (100, 5.0, dt.date(2024, 1, 1))],
                                "id long, v double, day date")
    upsert.upsert_path(spark, target, src, ["id"], "day")
    upsert.upsert_path(spark, target, src, ["id"], "day")      # idempotent (C20)
    after = _files(target)
    untouched = [p for p in before if "day=2024-01-01" not in p]
    assert all(after.get(p) == before[p] for p in untouched)
    res = spark.read.parquet(target)
    assert res.count() == 31 and res.filter("id = 0").first().v == -1.0
    empty = src.limit(0)
    assert upsert.upsert_path(spark, target, empty, ["id"], "day") == (0, None)       # C21
    assert spark.read.parquet(target).count() == 31


def test_zip_explode_pads_and_reports(spark):
    df = spark.createDataFrame([(1, ["t1", "t2", "t3"], [1.0, 2.0])], "id int, t array<string>, v array<double>")
    rows = arrays.zip_explode(df, ["id"], {"t": "t", "v": "v"}, index="i").collect()
    assert [(r.i, r.t, r.v) for r in rows] == [(1, "t1", 1.0), (2, "t2", 2.0), (3, "t3", None)]   # C22
    bad = arrays.length_mismatch(df, ["id"], ["v"], "t").collect()
    assert len(bad) == 1


def test_date_spine_inclusive(spark):
    assert grids.date_spine(spark, "2024-02-27", "2024-03-01").count() == 4


def test_upsert_path_refuses_duplicate_source_keys(spark, scratch):
    src = spark.createDataFrame([(1, 1.0, dt.date(2024, 1, 1)), (1, 2.0, dt.date(2024, 1, 1))],
                                "id long, v double, day date")
    with pytest.raises(upsert.DuplicateSourceKeys):
        upsert.upsert_path(spark, os.path.join(scratch, "t"), src, ["id"], "day")
    assert not os.path.exists(os.path.join(scratch, "t"))
