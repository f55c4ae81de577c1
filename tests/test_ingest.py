"""Landing JSON -> bronze, in batch."""

import datetime as dt
import json
import os

import feeds
from pyspark.sql import functions as F

from gridmart.sources import landing, tables


def test_price_landing_tags_region_and_date(spark, scratch):
    root = os.path.join(scratch, "price")
    d = dt.date(2026, 3, 29)
    feeds.write_price_file(root, d, "SE3", feeds.price_records(d, "SE3"))
    feeds.write_price_file(root, d, "SE9", feeds.price_records(d, "SE9"))
    b = landing.price_bronze(landing.read_price_landing(spark, root))
    rows = b.groupBy("region", "feed_date").count().collect()
    assert sorted((r.region, r.feed_date, r["count"]) for r in rows) == [("SE3", d, 23), ("SE9", d, 23)]
    assert b.filter(F.col("ingestion_time").isNull() | (F.col("source") != "price-feed")).count() == 0


def test_integers_read_as_doubles(spark, scratch):
    root = os.path.join(scratch, "price")
    os.makedirs(os.path.join(root, "2024"))
    with open(os.path.join(root, "2024", "01-01_SE1.json"), "w") as f:
        json.dump([{"SEK_per_kWh": 1, "EUR_per_kWh": 2, "EXR": 11,
                    "time_start": "2024-01-01T00:00:00+01:00", "time_end": "2024-01-01T01:00:00+01:00"}], f)
    r = landing.read_price_landing(spark, root).first()
    assert (r.SEK_per_kWh, r.EUR_per_kWh, r.EXR) == (1.0, 2.0, 11.0)     # C23 / T19


def test_weather_arrays_to_rows_with_location(spark, scratch):
    root = os.path.join(scratch, "weather")
    d = dt.date(2024, 5, 1)
    feeds.write_weather_file(root, d, "SE1", feeds.weather_payload(d, "SE1"))
    feeds.write_weather_file(root, d, "SE2", feeds.weather_payload(d, "SE2", short={"wind_speed_10m": 20}))
    files = landing.read_weather_landing(spark, root)
    b = landing.weather_bronze(files, landing.locations(spark))
    assert b.count() == 48
    se1 = b.filter("region = 'SE1'").select("location", "latitude").distinct().collect()
    assert [(r.location, r.latitude) for r in se1] == [("Lulea", 65.5848)]
    assert b.filter("region = 'SE2' AND wind_speed_10m IS NULL").count() == 4      # C22 padding
    mism = landing.weather_length_mismatch(files).collect()
    assert [(r.region, r["hourly_wind_speed_10m_len"]) for r in mism] == [("SE2", 20)]


def test_overwrite_counts_rows_with_observation(spark, scratch):
    df = spark.range(10).withColumn("d", F.lit(dt.date(2024, 1, 1)))
    assert tables.overwrite(df, os.path.join(scratch, "t"), "d") == 10
    assert tables.append(df, os.path.join(scratch, "t"), "d") == 10
    assert spark.read.parquet(os.path.join(scratch, "t")).count() == 20


def test_catalog_database_and_views(spark, scratch):
    from gridmart.sources.tables import Layout, create_database, register_views, save_table
    create_database(spark, "gm_test", location=os.path.join(scratch, "db"))
    df = spark.range(5).withColumn("d", F.lit(dt.date(2024, 1, 1)))
    save_table(df, "gm_test", "t", "d")
    assert spark.table("gm_test.t").count() == 5
    layout = Layout(os.path.join(scratch, "tables"))
    tables.overwrite(df, layout.gold, "d")
    assert register_views(spark, layout, prefix="v_") == ["v_gold"]
    assert spark.sql("SELECT count(*) AS n FROM v_gold").first().n == 5
    spark.sql("DROP DATABASE gm_test CASCADE")
