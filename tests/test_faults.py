"""Feed faults: malformed times, missing feeds, unreadable files, corrections,
late regions, stale feeds -- and what jobs leave behind."""

import datetime as dt
import os
import re
import time

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.functions import timecols
from gridmart.operators import marks, quality, upsert
from gridmart.operators.quality import QualityGateError
from gridmart.plans import gold as gold_plan
from gridmart.plans import jobs
from gridmart.schemas import GOLD, SILVER_PRICE, SILVER_WEATHER
from gridmart.sources import landing, tables
from gridmart.sources.tables import Layout

D1 = dt.date(2024, 5, 10)
D2, D3 = D1 + dt.timedelta(days=1), D1 + dt.timedelta(days=2)
PUBLISHED = {
    "Duplicate Gold keys", "Gold rows = distinct keys", "Region completeness", "Hourly continuity",
    "Gold keys mapped to Electricity", "Gold keys mapped to Weather", "Required Gold fields not null",
    "DST UTC day completeness"}


def _folders(scratch, name="a"):
    return (os.path.join(scratch, name, "price"), os.path.join(scratch, name, "weather"),
            Layout(os.path.join(scratch, name, "tables")))


def _rows(spark, layout, table):
    df = tables.read(spark, layout.tables()[table], tables.LAYER_SCHEMAS[table])
    return sorted((tuple(r) for r in df.drop("ingestion_time", "source").collect()), key=str)


def _bad_times(pl, day, region, n):
    recs = feeds.price_records(day, region)
    for i in range(n):
        recs[i]["time_start"] = f"bad-{i}" if i % 2 else f"{day.isoformat()}Tbad{i}"
    feeds.write_price_file(pl, day, region, recs)


@pytest.mark.parametrize("n", [1, 5])
def test_increment_with_malformed_times_equals_backfill(spark, scratch, n):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1], ["SE1", "SE2"])
    jobs.run_backfill(spark, layout, pl, wl)
    feeds.write_feeds(pl, wl, [D2], ["SE1", "SE2"])
    _bad_times(pl, D1 + dt.timedelta(days=3), "SE1", n)
    _bad_times(pl, D1 + dt.timedelta(days=4), "SE2", 1)
    jobs.run_increment(spark, layout, pl, wl)
    once = {t: _rows(spark, layout, t) for t in layout.tables()}
    jobs.run_increment(spark, layout, pl, wl)                       # idempotent
    assert {t: _rows(spark, layout, t) for t in layout.tables()} == once
    _, _, whole = _folders(scratch, "b")
    jobs.run_backfill(spark, whole, pl, wl)
    assert once == {t: _rows(spark, whole, t) for t in whole.tables()}
    silver = tables.read(spark, layout.silver_price, SILVER_PRICE)
    assert silver.filter("time_start IS NULL").count() == n + 1


def test_rows_of_the_null_partition_are_kept(spark, scratch):
    path = os.path.join(scratch, "t")
    day = dt.date(2024, 1, 1)
    schema = "id string, v int, day date"
    upsert.upsert_path(spark, path, spark.createDataFrame([("a", 1, None), ("b", 1, day)], schema), ["id"], "day")
    upsert.upsert_path(spark, path, spark.createDataFrame([("c", 1, None), ("e", 1, day)], schema), ["id"], "day")
    assert sorted(r.id for r in spark.read.schema(schema).parquet(path).collect()) == ["a", "b", "c", "e"]
    # the NULL partition alone
    _, touched = upsert.upsert_path(spark, path, spark.createDataFrame([("a", 2, None)], schema), ["id"], "day")
    read = spark.read.schema(schema).parquet(path)
    assert touched.has_null and touched.low is None
    assert sorted((r.id, r.v) for r in read.collect()) == [("a", 2), ("b", 1), ("c", 1), ("e", 1)]


def test_rows_without_a_key_are_known_by_their_content(spark, scratch):
    path, schema = os.path.join(scratch, "t"), "id string, v int, day date"
    rows = spark.createDataFrame([(None, 1, None), (None, 2, None), ("x", 3, None)], schema)
    for _ in range(2):
        upsert.upsert_path(spark, path, rows, ["id"], "day")
    upsert.upsert_path(spark, path, spark.createDataFrame([(None, 7, None)], schema), ["id"], "day")
    got = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.id or "", r.v) for r in got) == [("", 1), ("", 2), ("", 7), ("x", 3)]
    with pytest.raises(upsert.DuplicateSourceKeys):
        upsert.upsert_path(spark, path, rows.unionByName(rows), ["id"], "day")


def test_region_without_a_mark_keeps_its_history(spark, scratch):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=5)])
    jobs.run_backfill(spark, layout, pl, wl)
    for i in range(6):
        feeds.write_price_file(pl, D1 + dt.timedelta(days=i), "SE5", feeds.price_records(
            D1 + dt.timedelta(days=i), "SE5"))
        feeds.write_weather_file(wl, D1 + dt.timedelta(days=i), "SE5", feeds.weather_payload(
            D1 + dt.timedelta(days=i), "SE5"))
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=None)
    sp = tables.read(spark, layout.silver_price, SILVER_PRICE).filter("region = 'SE5'").count()
    assert sp == 6 * 24
    assert tables.read(spark, layout.gold, GOLD).filter("region = 'SE5'").count() == 6 * 24 - 2


def test_missing_feed_and_empty_gold(spark, scratch):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1])
    os.makedirs(os.path.join(scratch, "none"))
    counts = jobs.run_backfill(spark, layout, pl, os.path.join(scratch, "none"))
    assert counts["bronze_price"] > 0 and counts["bronze_weather"] == counts["gold"] == 0
    with pytest.raises(QualityGateError) as e:
        jobs.gate(spark, layout)
    assert "Region completeness" in e.value.failed
    jobs.run_increment(spark, layout, pl, wl)                    # the feed arrives
    jobs.gate(spark, layout, dst_days=[])


def test_partial_times_are_null(spark):
    texts = ["2024", "2024-05", "2024-05-10", "2024-05-10T", "2024-05-10T01", "2024-05-10 01:00",
             "2024-05-10T01:00Z", "2024-13-10T01:00", "2024-05-10T25:00", "", None, "x",
             "2024-05-10T01:00", "2024-05-10T01:00:30"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.p for r in df.select(timecols.parse_wall_ntz("t").alias("p")).collect()]
    assert got == [None] * 12 + [dt.datetime(2024, 5, 10, 1), dt.datetime(2024, 5, 10, 1, 0, 30)]


@pytest.mark.parametrize("newer", ["05-10_SE1.json", "05-11_SE1.json"])
def test_the_file_that_landed_last_wins(spark, scratch, newer):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1], ["SE1"])
    recs = feeds.price_records(D1, "SE1")
    now = time.time()
    for name, factor in (("05-10_SE1.json", 1), ("05-11_SE1.json", 2)):
        day = dt.date(2024, 5, int(name[3:5]))
        p = feeds.write_price_file(pl, day, "SE1", [{**r, "EUR_per_kWh": factor} for r in recs])
        os.utime(p, (now + 60 * (name == newer), now + 60 * (name == newer)))
    jobs.run_increment(spark, layout, pl, wl)
    bronze = tables.read(spark, layout.bronze_price, tables.LAYER_SCHEMAS["bronze_price"])
    got = {r.EUR_per_kWh for r in bronze.filter(F.col("time_start").startswith("2024-05-10T")).collect()}
    assert got == {1.0 if newer == "05-10_SE1.json" else 2.0}


def test_unreadable_file_is_counted_until_it_lands_again(spark, scratch):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1])
    extra = feeds.write_price_file(pl, D3, "SE2", feeds.price_records(D3, "SE2"))
    with open(extra, "r+") as f:
        f.truncate(700)
    assert jobs.run_backfill(spark, layout, pl, wl)["unreadable_price"] == 1
    bronze = tables.read(spark, layout.bronze_price, tables.LAYER_SCHEMAS["bronze_price"])
    assert bronze.filter("time_start IS NULL").count() == 0
    with pytest.raises(QualityGateError) as e:
        jobs.gate(spark, layout)
    assert e.value.failed == ["Landing files readable"]
    feeds.write_price_file(pl, D3, "SE2", feeds.price_records(D3, "SE2"))
    assert jobs.run_increment(spark, layout, pl, wl)["unreadable_price"] == 0
    jobs.gate(spark, layout)


def test_stopped_feed_and_published_names(spark, scratch):
    pl, wl, layout = _folders(scratch)
    day = dt.date(2025, 10, 26)                       # a DST day, so its check runs too
    feeds.write_feeds(pl, wl, [day])
    jobs.run_backfill(spark, layout, pl, wl)
    rows = jobs.gate(spark, layout, expected_until=dt.datetime(2025, 10, 26, 23))
    assert PUBLISHED <= {r["check"] for r in rows}
    with pytest.raises(QualityGateError) as e:
        jobs.gate(spark, layout, expected_until=dt.datetime(2025, 10, 27, 23))
    assert e.value.failed == ["Expected hourly grid"]


def test_global_increment_does_not_depend_on_the_process_zone(spark, monkeypatch):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 02:00:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("n"), F.col("t").cast("timestamp").alias("i"))
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        mark = dt.datetime(2024, 1, 1, 1)
        assert [marks.global_increment(df, c, mark).count() for c in ("n", "i")] == [1, 1]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_increment_leaves_no_staging_and_no_cache(spark, scratch):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1], ["SE1"])
    jobs.run_backfill(spark, layout, pl, wl)
    long_ago = time.time() - 86400
    os.utime(os.path.join(wl, "2024", "05-10_SE1.json"), (long_ago, long_ago))
    feeds.write_feeds(pl, wl, [D2], ["SE1"])
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    jobs.run_increment(spark, layout, pl, wl, mode="marks")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    stage = os.path.join(os.path.dirname(root), "gridmart-staging")
    here = os.path.join(root, "gridmart-staging")
    assert not any(os.path.isdir(d) and os.listdir(d) for d in (stage, here))
    sources = {r.source for r in tables.read(spark, layout.bronze_weather,
                                             tables.LAYER_SCHEMAS["bronze_weather"]).collect()}
    assert sources == {landing.WEATHER_SOURCE, landing.WEATHER_INCREMENT_SOURCE}


def test_layer_plans_prune(spark, scratch):
    pl, wl, layout = _folders(scratch)
    feeds.write_feeds(pl, wl, [D1, D2], ["SE1"])
    jobs.run_backfill(spark, layout, pl, wl)
    sp = tables.read(spark, layout.silver_price, SILVER_PRICE)
    sw = tables.read(spark, layout.silver_weather, SILVER_WEATHER)
    g = tables.read(spark, layout.gold, GOLD)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    built = plan(gold_plan.build(spark, sp, sw))
    assert built.count("FileScan parquet") == 2 and "GreaterThanOrEqual(time_start" in built
    assert re.search(r"PartitionFilters: \[[^\]]*utc_date", built)
    added = plan(gold_plan.increment(spark, sp, sw, g))
    assert "GreaterThan(time_start" in added and "GreaterThan(weather_time_utc" in added
    days = plan(quality.day_exceptions(g, "region", "hour_utc", g.select("region").distinct(), ["2024-05-10"]))
    assert "GreaterThanOrEqual(hour_utc" in days
    report = plan(jobs.gate_report(spark, layout, expected_regions=["SE1"]))
    assert len(re.findall(r"FileScan parquet[^\n]*gold/price_weather", report)) <= 2
