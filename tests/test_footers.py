"""Answers from footers: the same as of the data, without reading it."""

import datetime as dt
import os

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.operators import profiles
from gridmart.plans import gold as gold_plan
from gridmart.plans import jobs
from gridmart.schemas import GOLD, SILVER_PRICE, SILVER_WEATHER
from gridmart.sources import footers, tables
from gridmart.sources.tables import Layout

D1 = dt.date(2024, 5, 10)


@pytest.fixture(scope="module")
def rows(spark):
    day = F.date_add(F.lit(D1), (F.col("id") % 3).cast("int"))
    return spark.range(900).select(
        "id", day.alias("day"), (F.lit("2024-01-01 00:00:00").cast("timestamp")
                                 + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("t"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("wall"),
        F.when(F.col("id") % 7 > 0, F.col("id") / 3).alias("v"), F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") == 5, F.lit(float("nan"))).otherwise(F.col("id") / 2).alias("odd"),
        F.col("id").cast("string").alias("name"))


@pytest.fixture(scope="module")
def path(rows, tmp_path_factory):
    p = str(tmp_path_factory.mktemp("footers") / "t")
    tables.overwrite(rows, p, "day")
    return p


COLUMNS = ["id", "t", "wall", "v", "nothing", "odd", "name"]


def test_same_results_as_of_the_data(spark, rows, path):
    assert footers.row_count(spark, path, rows.schema).collect() == profiles.row_count(rows).collect()
    assert footers.null_profile(spark, path, rows.schema, COLUMNS).collect() == \
        profiles.null_profile(rows, COLUMNS).collect()
    # NaN is not equal to itself
    got, want = (str(f) for f in (footers.value_profile(spark, path, rows.schema, COLUMNS).collect(),
                                  profiles.value_profile(rows, COLUMNS).collect()))
    assert got == want
    assert footers.value_profile(spark, path, rows.schema, COLUMNS).schema == \
        profiles.value_profile(rows, COLUMNS).schema
    assert footers.time_range(spark, path, rows.schema, "t").collect() == profiles.time_range(rows, "t").collect()
    assert {tuple(r) for r in footers.counts_by_partition(spark, path, rows.schema, "day").collect()} == \
        {tuple(r) for r in profiles.counts_by(rows, ["day"]).collect()}
    assert footers.latest_wall(spark, path, rows.schema, "t") == dt.datetime(2024, 1, 1, 14, 59)


@pytest.mark.parametrize("what, pushed", [
    (lambda: [F.count(F.lit(1))], "COUNT(*)"), (lambda: [F.count("v")], "COUNT(v)"),
    (lambda: [F.min("t"), F.max("t")], "MIN(t), MAX(t)"), (lambda: [F.max("wall")], "MAX(wall)")])
def test_the_plan_pushes_the_aggregate(spark, rows, path, what, pushed):
    df = footers.table(spark, path, rows.schema).agg(*what())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"PushedAggregation: [{pushed}]" in plan
    by = footers.table(spark, path, rows.schema).groupBy("day").agg(*what())
    assert "PushedGroupBy: [day]" in by._jdf.queryExecution().executedPlan().toString()


def test_no_row_is_read(spark, rows, path, scans):
    footers.row_count(spark, path, rows.schema).collect()
    footers.time_range(spark, path, rows.schema, "t").collect()
    own = [s for s in scans() if s.kind.startswith("BatchScan") and path in s.location]
    files = sum(len([f for f in fs if f.endswith(".parquet")]) for _, _, fs in os.walk(path))
    found = [(s.kind, s.rows, s.metrics) for s in own]
    assert own and sum(s.rows for s in own) <= 2 * files, found   # one answer a file, not 900 rows


def test_missing_and_empty_tables(spark, rows, tmp_path):
    gone = str(tmp_path / "gone")
    empty = str(tmp_path / "empty")
    tables.overwrite(rows.limit(0), empty, "day")
    for p in (gone, empty):
        assert footers.row_count(spark, p, rows.schema).first()["rows"] == 0
        assert footers.range_walls(spark, p, rows.schema, "t") == (None, None)
        assert footers.null_profile(spark, p, rows.schema, ["v"]).first()["v_nulls"] == 0


def test_files_without_statistics_are_read(spark, rows, tmp_path):
    p = str(tmp_path / "int96")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")       # as other writers do
    try:
        rows.write.partitionBy("day").parquet(p)
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    assert footers.row_count(spark, p, rows.schema).first()["rows"] == 900
    assert footers.time_range(spark, p, rows.schema, "t").collect() == profiles.time_range(rows, "t").collect()


def test_the_caller_keeps_its_settings(spark, rows, path):
    footers.row_count(spark, path, rows.schema)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_jobs_ask_footers_for_ranges_and_marks(spark, tmp_path, scans):
    pl, wl, layout = str(tmp_path / "p"), str(tmp_path / "w"), Layout(str(tmp_path / "t"))
    feeds.write_feeds(pl, wl, [D1, D1 + dt.timedelta(days=1)], ["SE1"])
    jobs.run_backfill(spark, layout, pl, wl)
    sp = tables.read(spark, layout.silver_price, SILVER_PRICE)
    sw = tables.read(spark, layout.silver_weather, SILVER_WEATHER)
    assert jobs.common_range(spark, layout) == gold_plan.common_range(sp, sw)
    counts = {r.table: r.rows for r in jobs.silver_profile(spark, layout)["row_counts"].collect()}
    assert counts["silver_price"] == sp.count() and counts["silver_weather"] == sw.count()
    g = tables.read(spark, layout.gold, GOLD)
    assert footers.latest_wall(spark, layout.gold, GOLD, "hour_utc") == \
        g.agg(F.max(F.col("hour_utc").cast("timestamp_ntz"))).first()[0]
    # the global mark: a day later
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=2)], ["SE1"])
    jobs.run_increment(spark, layout, pl, wl, mode="marks", mark_scope="global")
    assert tables.read(spark, layout.gold, GOLD).count() == 72


@pytest.mark.parametrize("price, weather, want", [
    ((None, None), (1, 2), None), ((1, 5), (3, 9), (3, 5)), ((1, 2), (3, 4), None), ((2, 2), (2, 2), (2, 2))])
def test_common_range_of_walls(price, weather, want):
    def at(h):
        return None if h is None else dt.datetime(2024, 1, 1, h, 35)
    got = gold_plan.common_range_of_walls(tuple(map(at, price)), tuple(map(at, weather)))
    assert got == ((None, None) if want is None else tuple(dt.datetime(2024, 1, 1, h) for h in want))
