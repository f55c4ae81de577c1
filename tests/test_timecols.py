"""Time parsing, local parts across DST, hour keys, pushdown of day ranges."""

import datetime as dt

import feeds
from pyspark.sql import functions as F

from gridmart.functions import timecols
from gridmart.plans import silver
from gridmart.schemas import BRONZE_WEATHER


def test_offset_parse_distinct_instants_on_dst_day(spark):
    # 2025-10-26: local 02:00 occurs at +02:00 and again at +01:00 (C5)
    df = spark.createDataFrame([("2025-10-26T02:00:00+02:00",), ("2025-10-26T02:00:00+01:00",),
                                ("garbage",), (None,)], "t string")
    out = df.select(timecols.utc_wall(timecols.parse_offset_instant("t")).alias("u")).collect()
    assert [r.u for r in out] == [dt.datetime(2025, 10, 26, 0), dt.datetime(2025, 10, 26, 1), None, None]


def test_feed_local_date_is_text_date(spark):
    df = spark.createDataFrame([("2023-08-22T00:00:00+02:00",), ("bad",)], "t string")
    out = [r[0] for r in df.select(timecols.feed_local_date("t")).collect()]
    assert out == [dt.date(2023, 8, 22), None]          # T7: the local date as written


def test_local_parts_from_instant_independent_of_zone(spark):
    df = spark.createDataFrame([("2023-08-22T00:00:00+02:00",)], "t string")
    ts = timecols.parse_offset_instant("t")
    r = df.select(timecols.local_date(ts, "Europe/Stockholm").alias("d"),
                  timecols.local_hour(ts, "Europe/Stockholm").alias("h")).first()
    assert (r.d, r.h) == (dt.date(2023, 8, 22), 0)       # T8


def _weather_bronze_for_utc_hours(spark, start: dt.datetime, hours: int):
    rows = []
    for i in range(hours):
        t = start + dt.timedelta(hours=i)
        rows.append((t.strftime("%Y-%m-%dT%H:%M"), 1.0, 80.0, 0.0, 3.0, 1, "SE1", "x", 1.0, 1.0,
                     dt.datetime(2026, 1, 1), "t", t.date()))
    return spark.createDataFrame(rows, BRONZE_WEATHER)


def test_dst_local_day_lengths(spark):
    # C3 / C4: 23 and 25 hours on the local DST days; local 02:00 twice in autumn
    b = _weather_bronze_for_utc_hours(spark, dt.datetime(2025, 10, 24, 0), 24 * 5) \
        .unionByName(_weather_bronze_for_utc_hours(spark, dt.datetime(2026, 3, 27, 0), 24 * 5))
    s = silver.weather(b)
    counts = {(r.weather_date.isoformat()): r.rows for r in
              silver.local_day_counts(s, ["2025-10-26", "2026-03-29"]).collect()}
    assert counts == {"2025-10-26": 25, "2026-03-29": 23}
    twice = s.filter((F.col("weather_date") == F.lit(dt.date(2025, 10, 26))) & (F.col("weather_hour") == 2)).count()
    assert twice == 2
    # UTC days stay 24 long
    utc = s.groupBy("utc_date").count().filter(F.col("utc_date").isin(
        [F.lit(dt.date(2025, 10, 26)), F.lit(dt.date(2026, 3, 29))])).collect()
    assert sorted(r["count"] for r in utc) == [24, 24]


def test_hour_key_keeps_type(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5, 42),)], "t timestamp_ntz")
    out = df.select(timecols.hour_key("t", ntz=True).alias("h"))
    assert out.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert out.first().h == dt.datetime(2024, 1, 1, 5)


def test_day_range_pushed_to_scan(spark, scratch):
    p = f"{scratch}/ev"
    spark.createDataFrame([(dt.datetime(2024, 1, 10, 3),), (dt.datetime(2024, 1, 11, 0),)],
                          "ts timestamp_ntz").write.parquet(p)
    df = spark.read.parquet(p).filter(timecols.day_range("ts", "2024-01-10", ntz=True))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert df.count() == 1


def test_price_files_cover_dst_days():
    assert len(feeds.local_day_starts(dt.date(2026, 3, 29))) == 23
    assert len(feeds.local_day_starts(dt.date(2025, 10, 26))) == 25
