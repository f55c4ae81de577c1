"""Structured Streaming forms of ingest and of the hourly roll-up.

``landing_to_bronze`` replaces "find the missing dates, request them, append"
with a file stream over the landing folder: the stream's checkpoint (on the
shared ``spark.checkpoint.dir``) remembers which files were taken, each
micro-batch is upserted into bronze (idempotent if a batch is replayed after
a failure), and ``trigger(availableNow=True)`` processes everything new and
stops -- the daily job.

``hourly_prices`` is the roll-up as a one-hour tumbling window with a
watermark: an hour is emitted once the watermark passes its end, and
sub-hourly records later than the watermark are dropped by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridmart.functions.predicates import first_non_null_by
from gridmart.operators.upsert import latest_landed, upsert_path
from gridmart.schemas import (BRONZE_PRICE_KEYS, BRONZE_WEATHER_KEYS, PRICE_FEED,
                              WEATHER_FEED)
from gridmart.session import shared_dir
from gridmart.sources import landing


def _file_stream(spark: SparkSession, schema, path: str, max_files: int | None) -> DataFrame:
    r = (spark.readStream.schema(schema)
         .option("multiLine", True)
         .option("recursiveFileLookup", True)
         # by default a file a week older than the newest is ignored
         .option("maxFileAge", "36500d")
         .option("pathGlobFilter", "*.json"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return landing.with_file_tags(r.json(path))


def landed_stream(spark: SparkSession, feed: str, path: str, max_files: int | None = None) -> DataFrame:
    """Parsed rows of newly landed files, unreadable ones included."""
    if feed not in ("price", "weather"):
        raise ValueError(f"unknown feed {feed!r}")
    return _file_stream(spark, PRICE_FEED if feed == "price" else WEATHER_FEED, path, max_files)


def price_landing_stream(spark: SparkSession, path: str, max_files: int | None = None,
                         granularity: str = "day") -> DataFrame:
    return landing.price_bronze(_file_stream(spark, PRICE_FEED, path, max_files),
                                granularity=granularity)


def weather_landing_stream(spark: SparkSession, path: str, max_files: int | None = None,
                           granularity: str = "day") -> DataFrame:
    return landing.weather_bronze(_file_stream(spark, WEATHER_FEED, path, max_files),
                                  landing.locations(spark), granularity=granularity)


def _upsert_batch(target: str, keys: list[str], partition_col: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        dedup = latest_landed(batch, keys, landing.LANDED)
        upsert_path(batch.sparkSession, target, dedup, keys, partition_col)
    return write


def landing_to_bronze(spark: SparkSession, feed: str, landing_path: str, bronze_path: str,
                      checkpoint: str | None = None, available_now: bool = True,
                      max_files: int | None = None, granularity: str = "day") -> StreamingQuery:
    """Start the landing -> bronze stream for ``feed`` ("price" or "weather")."""
    if feed == "price":
        stream, keys = price_landing_stream(spark, landing_path, max_files, granularity), BRONZE_PRICE_KEYS
    elif feed == "weather":
        stream = weather_landing_stream(spark, landing_path, max_files, granularity)
        keys = BRONZE_WEATHER_KEYS
    else:
        raise ValueError(f"unknown feed {feed!r}")
    ckpt = checkpoint or f"{shared_dir(spark).rstrip('/')}/gridmart-streams/{feed}-bronze"
    w = (stream.writeStream.foreachBatch(_upsert_batch(bronze_path, keys, "feed_date"))
               .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _layered_batch(layout, feed: str, zone: str):
    from gridmart.plans import jobs
    keys = BRONZE_PRICE_KEYS if feed == "price" else BRONZE_WEATHER_KEYS
    target = layout.bronze_price if feed == "price" else layout.bronze_weather

    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        landed = landing.stage(batch, feed)
        try:
            rows = latest_landed(jobs.bronze(spark, landed, layout.granularity, landing.WEATHER_SOURCE),
                                 keys, landing.LANDED)
            _, touched = upsert_path(spark, target, rows, keys, "feed_date")
            jobs.record_unreadable(spark, layout, landed)
        finally:
            landed.remove()
        if feed == "price":
            jobs.changed_downstream(spark, layout, touched, None, zone)
        else:
            jobs.changed_downstream(spark, layout, None, touched, zone)
    return write


def layered_stream(spark: SparkSession, layout, feed: str, landing_path: str,
                   checkpoint: str | None = None, available_now: bool = True,
                   max_files: int | None = None, zone: str = "Europe/Stockholm") -> StreamingQuery:
    """The incremental job as a stream: each micro-batch of newly landed files
    of ``feed`` is parsed once, unreadable files go to the quarantine, the rest
    is upserted into bronze, and silver and gold are re-derived for exactly the
    partitions that batch changed.  A replayed batch gives
    the same tables (every write is an upsert).

    Run the price and the weather stream of one layout one after the other
    (``availableNow`` each, as the daily job does), not at the same time:
    both upsert gold, and two concurrent dynamic overwrites of the same gold
    partition would let the later one drop the other's rows.
    """
    stream = landed_stream(spark, feed, landing_path, max_files)
    ckpt = checkpoint or f"{shared_dir(spark).rstrip('/')}/gridmart-streams/{feed}-layers"
    w = stream.writeStream.foreachBatch(_layered_batch(layout, feed, zone)).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def hourly_prices(silver_stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """Streaming hourly roll-up of price silver rows (append mode)."""
    win = F.window("time_start", "1 hour")
    return (silver_stream.withWatermark("time_start", watermark)
            .groupBy(F.col("region"), win)
            .agg(F.avg("SEK_per_kWh").alias("SEK_per_kWh"),
                 F.avg("EUR_per_kWh").alias("EUR_per_kWh"),
                 first_non_null_by("EXR", "time_start").alias("EXR"))
            .select("region", F.col("window.start").alias("hour_utc"),
                    "SEK_per_kWh", "EUR_per_kWh", "EXR"))
