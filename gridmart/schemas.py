"""Schemas of the feeds and layers, key lists and the location dimension.

All ingest schemas are explicit and nullable; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for right results:
# region codes, their weather location and coordinates, the local zone of the
# feeds, the feed timestamp pattern, the QC report columns and the gold
# columns that must never be NULL.
# ---------------------------------------------------------------------------
REGIONS = ["SE1", "SE2", "SE3", "SE4"]
LOCATIONS = [
    # region, location, latitude, longitude
    ("SE1", "Lulea", 65.5848, 22.1547),
    ("SE2", "Umea", 63.8258, 20.2630),
    ("SE3", "Stockholm", 59.3293, 18.0686),
    ("SE4", "Malmo", 55.6050, 13.0038),
]
LOCAL_ZONE = "Europe/Stockholm"
PRICE_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ssXXX"
REQUIRED_GOLD_COLUMNS = [
    "region", "hour_utc", "SEK_per_kWh", "EUR_per_kWh", "EXR",
    "temperature_2m", "relative_humidity_2m", "precipitation",
    "wind_speed_10m", "weather_code",
]
QC_COLUMNS = ["check", "status", "detail"]
WEATHER_MEASURES = ["temperature_2m", "relative_humidity_2m", "precipitation",
                    "wind_speed_10m"]
# ---------------------------------------------------------------------------

WEATHER_VARIABLES = WEATHER_MEASURES + ["weather_code"]

D = T.DoubleType()
S = T.StringType()
I = T.IntegerType()
TS = T.TimestampType()
NTZ = T.TimestampNTZType()
DT = T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Landing: one JSON array of interval records per (day, region) file.
PRICE_FEED = _struct(("SEK_per_kWh", D), ("EUR_per_kWh", D), ("EXR", D),
                     ("time_start", S), ("time_end", S), ("_corrupt_record", S))

# Landing: one JSON object per (day, region) file, hourly parallel arrays.
WEATHER_FEED = _struct(
    ("latitude", D), ("longitude", D),
    ("hourly", _struct(("time", T.ArrayType(S)),
                       ("temperature_2m", T.ArrayType(D)),
                       ("relative_humidity_2m", T.ArrayType(D)),
                       ("precipitation", T.ArrayType(D)),
                       ("wind_speed_10m", T.ArrayType(D)),
                       ("weather_code", T.ArrayType(I)))),
    ("_corrupt_record", S),
)

BRONZE_PRICE = _struct(("SEK_per_kWh", D), ("EUR_per_kWh", D), ("EXR", D),
                       ("time_start", S), ("time_end", S), ("region", S),
                       ("ingestion_time", TS), ("source", S), ("feed_date", DT))

BRONZE_WEATHER = _struct(("weather_time_utc", S), ("temperature_2m", D),
                         ("relative_humidity_2m", D), ("precipitation", D),
                         ("wind_speed_10m", D), ("weather_code", I),
                         ("region", S), ("location", S), ("latitude", D),
                         ("longitude", D), ("ingestion_time", TS), ("source", S),
                         ("feed_date", DT))

SILVER_PRICE = _struct(("price_date", DT), ("time_start", TS), ("time_end", TS),
                       ("price_hour", I), ("region", S), ("SEK_per_kWh", D),
                       ("EUR_per_kWh", D), ("EXR", D), ("ingestion_time", TS),
                       ("source", S), ("utc_date", DT))

SILVER_WEATHER = _struct(("weather_date", DT), ("weather_time_utc", NTZ),
                         ("weather_time_local", NTZ), ("weather_hour", I),
                         ("region", S), ("location", S), ("latitude", D),
                         ("longitude", D), ("temperature_2m", D),
                         ("relative_humidity_2m", D), ("precipitation", D),
                         ("wind_speed_10m", D), ("weather_code", I),
                         ("ingestion_time", TS), ("source", S), ("utc_date", DT))

GOLD = _struct(("region", S), ("hour_utc", TS), ("location", S),
               ("latitude", D), ("longitude", D), ("SEK_per_kWh", D),
               ("EUR_per_kWh", D), ("EXR", D), ("temperature_2m", D),
               ("relative_humidity_2m", D), ("precipitation", D),
               ("wind_speed_10m", D), ("weather_code", I), ("hour_date", DT))

QC_REPORT = _struct(("check", S), ("status", S), ("detail", S))

# One row per load of a feed into bronze: when it started and what it wrote.
LOAD_LOG = _struct(("feed", S), ("load_started", TS), ("rows", T.LongType()))

# Quarantine: landed files that could not be parsed and have not landed again
# since, with what they hold.
UNREADABLE = _struct(("landed_file", S), ("feed", S), ("found_at", TS),
                     ("records", T.LongType()), ("content", S))

LOCATION_SCHEMA = _struct(("region", S), ("location", S), ("latitude", D),
                          ("longitude", D))

# Keys of each layer.  Partition columns are derived from the key's time, so a
# key can never move between partitions.
BRONZE_PRICE_KEYS = ["region", "time_start"]
BRONZE_WEATHER_KEYS = ["region", "weather_time_utc"]
SILVER_PRICE_KEYS = ["region", "time_start"]
SILVER_WEATHER_KEYS = ["region", "weather_time_utc"]
GOLD_KEYS = ["region", "hour_utc"]
