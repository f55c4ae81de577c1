"""Landed feed files -> bronze rows.

The feeds land as JSON files named ``{yyyy}/{mm-dd}_{region}.json`` (one per
day and region).  One ``spark.read.json`` over the landing folder reads all of
them in parallel -- instead of one request and one table append per day --
with an explicit schema (nothing inferred; a number written as ``1`` reads as
1.0).  Region and file date come from the file path via the ``_metadata``
column, so they are available in batch and in streaming reads alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.timecols import feed_local_date, period
from gridmart.operators.arrays import length_mismatch, zip_explode
from gridmart.session import remove_path, staging_path
from gridmart.schemas import (BRONZE_PRICE, BRONZE_WEATHER, LOCATION_SCHEMA,
                              LOCATIONS, PRICE_FEED, WEATHER_FEED, WEATHER_VARIABLES)

# Landing file naming ({yyyy}/{mm-dd}_{region}.json).
REGION_IN_PATH = r"_([A-Za-z0-9]+)\.json$"
YEAR_IN_PATH = r"/([0-9]{4})/[^/]+\.json$"
MONTH_DAY_IN_PATH = r"/([0-9]{2}-[0-9]{2})_[^/]+\.json$"

PRICE_SOURCE = "price-feed"
WEATHER_SOURCE = "weather-archive"
WEATHER_INCREMENT_SOURCE = "weather-forecast"
# When and from which file a row landed; orders the rows of one key.
LANDED = "_landed"


def file_region(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, REGION_IN_PATH, 1), F.lit(""))


def file_date(path: Column) -> Column:
    """Date encoded in the landing path (NULL if the name does not match)."""
    text = F.concat_ws("-", F.regexp_extract(path, YEAR_IN_PATH, 1),
                       F.regexp_extract(path, MONTH_DAY_IN_PATH, 1))
    return text.try_cast("date")


def with_file_tags(df: DataFrame) -> DataFrame:
    p = F.col("_metadata.file_path")
    return df.withColumns({"region": file_region(p), "file_date": file_date(p), "landed_file": p,
                           LANDED: F.struct(F.col("_metadata.file_modification_time").alias("at"),
                                            p.alias("file"))})


def is_unreadable() -> Column:
    """True for the row that stands for a file the JSON parser gave up on."""
    return F.col("_corrupt_record").isNotNull()


def _json_reader(spark: SparkSession, schema, modified_after=None):
    r = (spark.read.schema(schema)
         .option("multiLine", True)
         .option("recursiveFileLookup", True)
         .option("pathGlobFilter", "*.json"))
    if modified_after is not None:
        # filtered while listing: older files are never opened
        r = r.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S"))
    return r


def read_price_landing(spark: SparkSession, path: str, modified_after=None) -> DataFrame:
    """Interval records of every price file under ``path`` (only files
    modified after ``modified_after``, a UTC datetime, if given), with region
    and file date."""
    return with_file_tags(_json_reader(spark, PRICE_FEED, modified_after).json(path))


def read_weather_landing(spark: SparkSession, path: str, modified_after=None) -> DataFrame:
    """One row per weather file (struct of hourly arrays), with region and
    file date."""
    return with_file_tags(_json_reader(spark, WEATHER_FEED, modified_after).json(path))


@dataclass(frozen=True)
class Landed:
    """The landed files of one load, parsed once and kept in the shared folder
    until ``remove``: rows of files that could be read and, apart from them, one
    row with the content of each file that could not."""
    feed: str
    path: str
    table: DataFrame

    @property
    def readable(self) -> DataFrame:
        return self.table.filter(~F.col("quarantined")).drop("quarantined", "_corrupt_record")

    @property
    def quarantined(self) -> DataFrame:
        """landed_file and the content the parser gave up on."""
        return self.table.filter(F.col("quarantined")) \
            .select("landed_file", F.col("_corrupt_record").alias("content"))

    @property
    def outcomes(self) -> DataFrame:
        """Every file of the load: whether it was quarantined, and its records."""
        record = "time_start" if self.feed == "price" else "hourly"
        return self.table.groupBy("landed_file").agg(F.max("quarantined").alias("bad"),
                                                     F.count(record).alias("records"))

    def remove(self) -> None:
        remove_path(self.table.sparkSession, self.path)


def stage(parsed: DataFrame, feed: str) -> Landed:
    """Parses the files of ``parsed`` (a landing read or a micro-batch of one)
    in one pass that writes good rows and unreadable files apart.  Everything
    later in the load reads this table, never the landing files again."""
    spark = parsed.sparkSession
    path = staging_path(spark, f"landed-{feed}")
    rows = parsed.withColumn("quarantined", is_unreadable())
    rows.write.partitionBy("quarantined").parquet(path)
    return Landed(feed, path, spark.read.schema(rows.schema).parquet(path))


def stage_price(spark: SparkSession, path: str, modified_after=None) -> Landed:
    return stage(read_price_landing(spark, path, modified_after), "price")


def stage_weather(spark: SparkSession, path: str, modified_after=None) -> Landed:
    return stage(read_weather_landing(spark, path, modified_after), "weather")


def locations(spark: SparkSession) -> DataFrame:
    """The region -> weather location dimension (4 rows)."""
    return spark.createDataFrame(LOCATIONS, LOCATION_SCHEMA)


def audit(df: DataFrame, source: str) -> DataFrame:
    """Ingestion audit columns: load time and source tag."""
    return df.withColumns({"ingestion_time": F.current_timestamp(), "source": F.lit(source)})


def price_bronze(records: DataFrame, source: str = PRICE_SOURCE, granularity: str = "day") -> DataFrame:
    """Landing records -> price bronze rows (raw text times kept as text).

    ``feed_date`` (partition column) is the period (day or month) of the date
    as written at the start of ``time_start``, so it is a function of the key.
    """
    out = audit(_readable(records), source) \
        .withColumn("feed_date", period(feed_local_date("time_start"), granularity))
    return out.select(*BRONZE_PRICE.fieldNames(), *_landed(out))


def _readable(df: DataFrame) -> DataFrame:
    return df.filter(~is_unreadable()) if "_corrupt_record" in df.columns else df


def _landed(df: DataFrame) -> list[str]:
    return [LANDED] if LANDED in df.columns else []


def weather_rows(files: DataFrame) -> DataFrame:
    """Parallel hourly arrays -> one row per hour (NULL-padded if an array is
    shorter than ``time``)."""
    arrays = {"weather_time_utc": "hourly.time",
              **{v: f"hourly.{v}" for v in WEATHER_VARIABLES}}
    return zip_explode(_readable(files), ["region", "file_date", *_landed(files)], arrays)


def weather_length_mismatch(files: DataFrame) -> DataFrame:
    """Files whose hourly arrays are not all as long as ``hourly.time``."""
    return length_mismatch(files, ["region", "file_date"],
                           [f"hourly.{v}" for v in WEATHER_VARIABLES], "hourly.time")


def weather_bronze(files: DataFrame, dim: DataFrame, source: str = WEATHER_SOURCE,
                   granularity: str = "day") -> DataFrame:
    """Weather files -> weather bronze rows, tagged with location and
    coordinates from the location dimension."""
    return weather_bronze_rows(weather_rows(files), dim, source, granularity)


def weather_bronze_rows(rows: DataFrame, dim: DataFrame, source: str = WEATHER_SOURCE,
                        granularity: str = "day") -> DataFrame:
    """Hourly weather rows (time text, measures, region) -> weather bronze.
    The dimension's size is the planner's to judge (broadcast or not)."""
    tagged = rows.join(dim, "region", "left")
    out = audit(tagged, source).withColumn("feed_date", period(feed_local_date("weather_time_utc"), granularity))
    return out.select(*BRONZE_WEATHER.fieldNames(), *_landed(out))
