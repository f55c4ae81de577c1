"""Touched partitions: pruned at run time, however far apart they lie."""

import datetime as dt
import os

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.operators import marks, upsert
from gridmart.plans import gold as gold_plan
from gridmart.plans import jobs
from gridmart.schemas import GOLD
from gridmart.sources import tables
from gridmart.sources.tables import Layout

FIRST = dt.date(2023, 1, 1)
SCHEMA = "id long, v double, day date"


def _days(spark, path, n=100):
    """A table of ``n`` day partitions and the NULL one, two rows each."""
    rows = spark.range(2 * n + 2).select(
        "id", F.lit(1.0).alias("v"),
        F.when(F.col("id") < 2 * n, F.date_add(F.lit(FIRST), (F.col("id") % n).cast("int"))).alias("day"))
    rows.repartition(1).write.partitionBy("day").parquet(path)


def _source(spark, days, first_id=10_000):
    return spark.createDataFrame([(first_id + i, 2.0, d) for i, d in enumerate(days)], SCHEMA)


def _of(found, path, kind="Scan parquet"):
    return [s for s in found if s.kind.startswith(kind) and path in s.location]


@pytest.mark.parametrize("null_day", [False, True])
def test_scattered_days_read_only_their_partitions(spark, scratch, scans, null_day):
    path = os.path.join(scratch, "t")
    _days(spark, path)
    days = [FIRST, FIRST + dt.timedelta(days=50), FIRST + dt.timedelta(days=99)] + [None] * null_day
    touched = upsert.Touched.of(_source(spark, days), "day")
    df = touched.rows_of(spark.read.schema(SCHEMA).parquet(path))
    rows = df.collect()
    assert sorted({r.day for r in rows}, key=str) == sorted(days, key=str) and len(rows) == 2 * len(days)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    own = _of(scans(), path)
    assert sum(s.partitions for s in own) == sum(s.files for s in own) == len(days)
    assert sum(s.rows for s in own) == 2 * len(days)


def test_an_upsert_of_scattered_days_reads_and_writes_only_them(spark, scratch, scans):
    path = os.path.join(scratch, "t")
    _days(spark, path)
    before = {d: os.listdir(os.path.join(path, d)) for d in os.listdir(path) if d.startswith("day=")}
    days = [FIRST, FIRST + dt.timedelta(days=99), None]
    changed = spark.createDataFrame([(0, 5.0, days[0]), (10_001, 5.0, days[1]), (10_002, 5.0, None)], SCHEMA)
    n, touched = upsert.upsert_path(spark, path, changed, ["id"], "day")
    assert (n, touched.count, touched.has_null) == (3, 3, True)
    # rows with a key and rows without are read apart, from the touched partitions
    assert [s.partitions for s in _of(scans(), path) if s.partitions] == [2, 1, 2, 1]
    after = {d: os.listdir(os.path.join(path, d)) for d in os.listdir(path) if d.startswith("day=")}
    assert len([d for d in after if after[d] != before.get(d)]) == 3
    got = spark.read.schema(SCHEMA).parquet(path)
    assert got.count() == 2 * 100 + 2 + 2
    assert {(r.id, r.day) for r in got.filter("v = 5").collect()} == {(0, days[0]), (10_001, days[1]), (10_002, None)}


def test_only_the_null_partition_and_nothing(spark, scratch, scans):
    path = os.path.join(scratch, "t")
    _days(spark, path, 5)
    read = spark.read.schema(SCHEMA).parquet(path)
    assert upsert.Touched.of(_source(spark, [None, None]), "day").rows_of(read).count() == 2
    assert sum(s.partitions for s in _of(scans(), path)) == 1
    assert upsert.Touched.of(_source(spark, [FIRST]).limit(0), "day").rows_of(read).count() == 0


def test_more_partitions_than_are_broadcast_are_joined_by_a_shuffle(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "t")
    _days(spark, path, 20)
    monkeypatch.setattr(upsert, "MAX_BROADCAST_PARTITIONS", 2)
    days = [FIRST + dt.timedelta(days=k) for k in (0, 3, 19)] + [None]
    touched = upsert.Touched.of(_source(spark, days), "day")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = touched.rows_of(spark.read.schema(SCHEMA).parquet(path))
        assert df.count() == 8
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_a_daily_job_with_two_corrections_far_apart(spark, scratch, scans):
    """A year of days; the first and the last are corrected together."""
    pl, wl, layout = os.path.join(scratch, "p"), os.path.join(scratch, "w"), Layout(os.path.join(scratch, "t"))
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 60)]
    for d in days:
        feeds.write_price_file(pl, d, "SE1", feeds.price_records(d, "SE1"))
        feeds.write_weather_file(wl, d, "SE1", feeds.weather_payload(d, "SE1"))
    jobs.run_backfill(spark, layout, pl, wl)
    for d in (days[1], days[-2]):
        feeds.write_price_file(pl, d, "SE1", feeds.price_records(d, "SE1", value=lambda r, t: 9.0))
    os.utime(os.path.join(wl, "2024/01-01_SE1.json"), (1, 1))
    done = len(scans())
    # the margin reads the new files only
    jobs.run_increment(spark, layout, pl, wl, landing_margin=dt.timedelta(seconds=-1))
    found = scans()[done:]
    for layer, most in ((layout.silver_price, 12), (layout.silver_weather, 12), (layout.gold, 12)):
        own = _of(found, layer)
        assert own and all(s.partitions <= 6 for s in own), [(s.partitions, s.location) for s in own]
    g = tables.read(spark, layout.gold, GOLD)
    assert g.filter(F.col("EUR_per_kWh") == 9.0).count() == 2 * 24


def test_floor_and_members_without_a_mark(spark):
    rows = [(r, h) for r in ("a", "b", "c", None) for h in range(6)]
    source = spark.createDataFrame(rows, "region string, h int")
    known = spark.createDataFrame([("a", 3), ("b", 4)], "region string, mark int")
    unmarked = marks.unmarked_members(source, known, "region")
    assert {r.region for r in unmarked.collect()} == {"c", None}
    got = marks.increment(marks.since_floor(source, "region", F.col("h") > 3, unmarked), known, "region", "h")
    assert {tuple(r) for r in got.collect()} == \
        {("a", 4), ("a", 5), ("b", 5)} | {(r, h) for r in ("c", None) for h in range(6)}
    # no key lacks a mark: the pruned scan alone
    both = source.filter("region IN ('a', 'b')")
    none = marks.unmarked_members(both, known, "region")
    plan = marks.since_floor(both, "region", F.col("h") > 3, none)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "Join" not in plan


def test_gold_increment_collects_no_region_names(spark):
    src = open(gold_plan.__file__).read() + open(jobs.__file__).read()
    assert "collect_set" not in src and "isin(" not in src
