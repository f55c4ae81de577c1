"""Gold as one stream: hourly prices joined with hourly weather as both arrive.

Both feeds are read at the same time.  Prices are rolled up by watermarked
one-hour windows; each closed hour meets the weather row of its (region, hour) in
a stream-stream join on the window, whose state Spark drops once the watermark of
both feeds has passed it.  A row that comes late, but within the watermark, is in
its hour; one that comes later still is not, and is left to the batch increment,
which corrects gold from the layers.  A row that lands again within the watermark
counts once (the first landing).

The result equals batch gold of the hours that end at or before the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmart.functions.predicates import first_non_null_by
from gridmart.functions.timecols import as_instant, period, utc_wall
from gridmart.operators.upsert import upsert_path
from gridmart.plans import silver
from gridmart.schemas import GOLD, GOLD_KEYS, LOCAL_ZONE, WEATHER_MEASURES
from gridmart.session import shared_dir
from gridmart.sources import tables
from gridmart.streaming import ingest

DELAY = "2 hours"


def _once(df: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Rows with a key, each key once within the watermark."""
    return df.filter(F.col("region").isNotNull() & F.col(time_col).isNotNull()) \
        .withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["region", time_col])


def price_hours(silver_prices: DataFrame, delay: str = DELAY) -> DataFrame:
    """Hourly prices by window; an hour comes out when the watermark passes its end."""
    return _once(silver_prices, "time_start", delay) \
        .groupBy("region", F.window("time_start", "1 hour").alias("window")).agg(
            F.avg("SEK_per_kWh").alias("SEK_per_kWh"), F.avg("EUR_per_kWh").alias("EUR_per_kWh"),
            first_non_null_by("EXR", "time_start").alias("EXR"))


def weather_hours(silver_weather: DataFrame, delay: str = DELAY) -> DataFrame:
    """Weather rows with the window of their hour."""
    timed = silver_weather.withColumn("_hour", F.date_trunc("hour", as_instant("weather_time_utc")))
    return _once(timed, "_hour", delay).select(
        "region", F.window("_hour", "1 hour").alias("window"), "location", "latitude", "longitude",
        *WEATHER_MEASURES, "weather_code")


def gold(silver_prices: DataFrame, silver_weather: DataFrame, delay: str = DELAY,
         granularity: str = "day") -> DataFrame:
    """The gold stream of two silver streams."""
    joined = price_hours(silver_prices, delay).join(weather_hours(silver_weather, delay), ["region", "window"])
    hour = F.col("window.start")
    return joined.withColumns({"hour_utc": hour, "hour_date": period(F.to_date(utc_wall(hour)), granularity)}) \
        .select(*GOLD.fieldNames())


def gold_from_landing(spark: SparkSession, layout, price_landing: str, weather_landing: str,
                      checkpoint: str | None = None, available_now: bool = True, max_files: int | None = None,
                      delay: str = DELAY, zone: str = LOCAL_ZONE) -> StreamingQuery:
    """Starts the stream from the landing folders of both feeds to the layout's
    gold.  Each batch of finished hours is upserted, so a replayed one changes
    nothing; bronze and silver are not written (see ``ingest.layered_stream``)."""
    g = layout.granularity
    prices = silver.prices(ingest.price_landing_stream(spark, price_landing, max_files, g), zone, g)
    weather = silver.weather(ingest.weather_landing_stream(spark, weather_landing, max_files, g), zone, g)

    def write(batch: DataFrame, epoch_id: int) -> None:
        upsert_path(batch.sparkSession, layout.gold, batch, GOLD_KEYS, "hour_date",
                    cluster=tables.LAYER_CLUSTERS["gold"])

    at = checkpoint or f"{shared_dir(spark).rstrip('/')}/gridmart-streams/gold-join"
    w = gold(prices, weather, delay, g).writeStream.foreachBatch(write).option("checkpointLocation", at)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
