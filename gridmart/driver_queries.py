"""Library operators applied to the driver's test tables.

The driver tables carry no price or weather feed, so the two feeds are
played by the ``events`` table, split by ``event_id`` parity into two disjoint
halves that together hold every row:

* price feed ``P``   = events with even ``event_id``: region := ``event_type``,
  time := ``ts`` (UTC wall clock, NTZ), price := ``value``;
* weather feed ``X`` = events with odd ``event_id``: temperature := ``props.k``;
* gold ``G``         = hourly ``P`` joined with hourly ``X`` on (region, hour).

A query that needs one feed only takes it from all of ``events``.

The TPC-H-like tables stand in where a check needs calendar dates or
dimensions (orders per region and day, customer -> nation -> region).

Every query calls the library function it proves; ``oracle_sql()`` states
the same result independently in DuckDB SQL.  Each query reads whole tables:
no samples, id subsets or row caps (``worst_gaps_topk`` is a top-k report).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions import timecols
from gridmart.operators import (arrays, gaps, grids, joins, marks, profiles,
                                quality, rollup, upsert)
from gridmart.plans import analytics, silver
from gridmart.plans import gold as gold_plan
from gridmart.sources import landing
from gridmart.session import SESSION_ZONE, remove_path, staging_path

KEYS = ["region", "hour_utc"]
ZONE = "Europe/Stockholm"

# Parameters of individual queries (not row caps).
EXPECTED_TYPES = ["click", "view", "purchase", "error", "refund"]
ALLOWED_TYPES = ["click", "view", "purchase"]
LOADED_BEFORE = "2024-01-21 00:00:00"          # history already loaded (marks)
UNLOADED_REGION = "signup"                     # not in gold before the increment
LOOKBACK = _dt.timedelta(days=2)
SLICE_DAY = "2024-01-10"
TOP_K = 20
NULLABLE_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority"]
GOLD_REQUIRED = ["region", "hour_utc", "price", "first_price", "temperature"]


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone (the driver's session may come without it)."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the session's shared
    ``spark.checkpoint.dir`` -- the stand-in for a stored layer table, so the
    feed derivation is not repeated by every job of a query.  Without a
    configured folder the lineage is kept (no local folder is invented)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        d = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not d:
            return df
        sc.setCheckpointDir(d)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Stand-in feeds and layers
# --------------------------------------------------------------------------

def events(spark, d) -> DataFrame:
    return table(spark, d, "events")


def _half(df: DataFrame, parity: int, whole: bool) -> DataFrame:
    return df if whole else df.filter(F.col("event_id") % 2 == parity)


def price_feed(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return (_half(events(spark, sf_dir), 0, whole)
            .select(F.col("event_type").alias("region"), "ts", F.col("value").alias("price")))


def weather_feed(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return (_half(events(spark, sf_dir), 1, whole)
            .select(F.col("event_type").alias("region"), "ts",
                    F.get_json_object("props", "$.k").cast("double").alias("temperature"),
                    (F.col("user_id") % 20).cast("double").alias("wind")))


def price_hourly(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return rollup.hourly_rollup(price_feed(spark, sf_dir, whole), "region", "ts", ntz=True,
                                means={"price": "price"},
                                firsts={"first_price": "price"},
                                count_col="n_obs", mean_scale=6)


def weather_hourly(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    return rollup.hourly_rollup(weather_feed(spark, sf_dir, whole), "region", "ts", ntz=True,
                                means={"temperature": "temperature"})


def gold_with_wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    xh = rollup.hourly_rollup(weather_feed(spark, sf_dir), "region", "ts", ntz=True,
                              means={"temperature": "temperature", "wind": "wind"})
    return joins.keyed_join(price_hourly(spark, sf_dir), xh, KEYS)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.keyed_join(price_hourly(spark, sf_dir), weather_hourly(spark, sf_dir), KEYS)


def event_hour_keys(spark, d) -> DataFrame:
    return rollup.hour_keys(events(spark, d), "event_type", "ts", ntz=True, key_out="region")


def events_by_user_hour(spark, d) -> DataFrame:
    return events(spark, d).withColumn("hour_utc", timecols.hour_key("ts", ntz=True))


def _offset_text(utc: Column) -> Column:
    """UTC wall clock -> feed text with the true Stockholm offset
    (``2024-01-10T13:05:07+01:00``), as the price feed writes it."""
    local = timecols.to_local_wall(utc, ZONE)
    off = ((F.unix_seconds(local.cast("timestamp")) - F.unix_seconds(utc.cast("timestamp")))
           / F.lit(3600)).cast("int")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.format_string("+%02d:00", off))


def price_bronze_events(spark, d, whole: bool = False) -> DataFrame:
    """Price-feed records made from the price half of events (15-minute
    intervals; the exchange rate is constant within a UTC hour, as in the
    feed), through the library's bronze builder."""
    ev = _half(events(spark, d), 0, whole)
    records = ev.select(
        (F.col("value") * 11).alias("SEK_per_kWh"), F.col("value").alias("EUR_per_kWh"),
        (F.lit(10.0) + F.hour("ts").cast("double") / F.lit(100.0)).alias("EXR"),
        _offset_text(F.col("ts")).alias("time_start"),
        _offset_text(F.col("ts") + F.make_dt_interval(mins=F.lit(15))).alias("time_end"),
        F.col("event_type").alias("region"))
    return landing.price_bronze(records, source="events")


#: Event types that stand for the feeds' regions, so that the location dimension
#: has matching rows; the other types stay regions without a location.
REGION_OF_TYPE = {"click": "SE1", "error": "SE2", "purchase": "SE3", "signup": "SE4"}


def weather_bronze_events(spark, d, whole: bool = False) -> DataFrame:
    """Hourly weather rows made from the weather half of events, through the
    library's bronze builder (location dimension join included).  ``whole``:
    from all events, the event types mapped to the feeds' regions."""
    xh = weather_hourly(spark, d, whole)
    if whole:
        codes = F.create_map(*[F.lit(x) for kv in REGION_OF_TYPE.items() for x in kv])
        xh = xh.withColumn("region", F.coalesce(codes[F.col("region")], "region"))
    rows = xh.select(
        F.date_format("hour_utc", "yyyy-MM-dd'T'HH:mm").alias("weather_time_utc"),
        F.col("temperature").alias("temperature_2m"),
        F.lit(50.0).alias("relative_humidity_2m"), F.lit(0.0).alias("precipitation"),
        (F.col("temperature") / F.lit(10.0)).alias("wind_speed_10m"),
        F.lit(1).alias("weather_code"), "region")
    return landing.weather_bronze_rows(rows, landing.locations(spark), source="events")


SILVER_PRICE_OUT = ["price_date", "time_start", "time_end", "price_hour", "region", "SEK_per_kWh",
                    "EUR_per_kWh", "EXR", "source", "utc_date"]


def customer_regions(spark, d) -> DataFrame:
    """customer -> nation -> region.  The 25 x 5 dimension is broadcast by the
    planner on its file-size statistics (``autoBroadcastJoinThreshold``), a
    size check that costs no extra job; customer, which grows with the data,
    is never broadcast."""
    dim = (table(spark, d, "nation")
           .join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_name"))
    return (table(spark, d, "customer")
            .join(dim, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "c_name", "n_name", "r_name"))


def orders_by_region(spark, d) -> DataFrame:
    cr = customer_regions(spark, d).select("c_custkey", F.col("r_name").alias("region"))
    return table(spark, d, "orders").join(cr, F.col("o_custkey") == F.col("c_custkey"))


def orders_with_nulls(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.withColumns({
        "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("F")),
        "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")),
    })


def _members(spark, values: list[str], name: str = "member") -> DataFrame:
    return prepare(spark).createDataFrame([(v,) for v in values], f"{name} string")


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------

def q_hourly_rollup(spark, d):
    return price_hourly(spark, d, whole=True)


def q_gold_hourly_join(spark, d):
    return gold(spark, d)


def q_overlap_range(spark, d):
    ph, xh = price_hourly(spark, d), weather_hourly(spark, d)
    lo, hi = joins.overlap_bounds(ph, "hour_utc", xh, "hour_utc")
    return joins.within(ph, "hour_utc", lo, hi)


def q_anti_left_keys(spark, d):
    return joins.missing_on_right(price_hourly(spark, d).select(*KEYS), weather_hourly(spark, d), KEYS)


def q_anti_right_keys(spark, d):
    return joins.missing_on_right(weather_hourly(spark, d).select(*KEYS), price_hourly(spark, d), KEYS)


def q_existing_overlap(spark, d):
    hit = joins.present_on_right(weather_hourly(spark, d).select(*KEYS), price_hourly(spark, d), KEYS)
    return hit.agg(F.count(F.lit(1)).alias("existing_keys"))


def q_key_presence(spark, d):
    return quality.key_presence({"price": price_hourly(spark, d).select(*KEYS),
                                 "weather": weather_hourly(spark, d).select(*KEYS)}, KEYS)


def q_hour_gaps(spark, d):
    return gaps.segmented_gaps(event_hour_keys(spark, d), "region", "hour_utc")


def q_hour_gaps_lag(spark, d):
    return gaps.lag_gaps(event_hour_keys(spark, d), "region", "hour_utc")


def q_worst_gaps_topk(spark, d):
    return gaps.worst_gaps(q_hour_gaps(spark, d), TOP_K, "region", "hour_utc")


def q_continuity_breaks(spark, d):
    starts = gaps.gap_starts(event_hour_keys(spark, d), "region", "hour_utc")
    return profiles.counts_by(starts, ["region"], "gaps")


def q_missing_hours(spark, d):
    ev = events(spark, d)
    lo, hi = grids.whole_day_bounds(ev, "ts")
    members = joins.rename(profiles.distinct_members(ev, "event_type"), {"event_type": "region"})
    grid = grids.member_hour_grid(members, "region", lo, hi, ntz=True)
    return grids.absent_from(grid, event_hour_keys(spark, d), KEYS)


def q_upsert_merge(spark, d):
    ev = events(spark, d)
    target = ev.filter(F.col("event_id") % 3 != 0)
    source = ev.filter(F.col("event_id") % 3 != 1).withColumn("value", F.col("value") * 2)
    return upsert.upsert_frame(target, source, ["event_id"])


def q_latest_per_key(spark, d):
    ev = events_by_user_hour(spark, d).select("user_id", "hour_utc", "ts", "event_id", "value")
    return upsert.latest_per_key(ev, ["user_id", "hour_utc"], "ts")


def _loaded_marks(spark, d):
    loaded = events(spark, d).filter(F.col("ts") < timecols.utc_literal(LOADED_BEFORE, ntz=True))
    return marks.high_water_marks(loaded, "event_type", "ts")


def q_increment_filter(spark, d):
    return marks.increment(events(spark, d), _loaded_marks(spark, d), "event_type", "ts")


def q_increment_lookback(spark, d):
    return marks.increment(events(spark, d), _loaded_marks(spark, d), "event_type", "ts",
                           lookback=LOOKBACK)


def q_increment_global(spark, d):
    loaded = events(spark, d).filter(F.col("ts") < timecols.utc_literal(LOADED_BEFORE, ntz=True))
    mark = marks.global_mark(loaded, "ts")
    return marks.global_increment(events(spark, d), "ts", mark)


def q_high_water_mark(spark, d):
    return marks.high_water_marks(events(spark, d), "event_type", "ts")


def q_latest_date(spark, d):
    raw = events(spark, d).select(F.col("ts").cast("string").alias("ts_text"))
    return marks.latest_date(raw, "ts_text")


def q_date_spine(spark, d):
    return grids.date_spine_of(events(spark, d), F.to_date("ts"))


def q_missing_dates(spark, d):
    o = orders_by_region(spark, d).select("region", F.to_date("o_orderdate").alias("day"))
    b = table(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"),
                                      F.max(F.to_date("o_orderdate")).alias("hi")).first()
    regions = table(spark, d, "region").select(F.col("r_name").alias("region"))
    return marks.missing_dates(o, "region", "day", regions, b["lo"], b["hi"])


def q_null_profile(spark, d):
    return profiles.null_profile(orders_with_nulls(spark, d), NULLABLE_ORDERS)


def q_invalid_members(spark, d):
    return profiles.invalid_members(events(spark, d), "event_type", ALLOWED_TYPES)


def q_distinct_members(spark, d):
    return profiles.distinct_members(events(spark, d), "event_type")


def q_invalid_interval(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return profiles.invalid_interval(j, "o_orderdate", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate")


def q_duplicate_keys(spark, d):
    return profiles.duplicate_keys(events_by_user_hour(spark, d), ["user_id", "hour_utc"])


def q_duplicate_histogram(spark, d):
    return profiles.duplicate_histogram(events_by_user_hour(spark, d), ["user_id", "hour_utc"])


def q_distinct_keys(spark, d):
    return profiles.key_stats(events_by_user_hour(spark, d), ["user_id", "hour_utc"])


def q_row_counts(spark, d):
    raw = profiles.row_count(events(spark, d)).select(F.lit("raw").alias("layer"), "rows")
    hourly = profiles.row_count(event_hour_keys(spark, d)).select(F.lit("hourly").alias("layer"), "rows")
    return raw.unionByName(hourly)


def q_rows_by_region(spark, d):
    return profiles.counts_by(events(spark, d), ["event_type"])


def q_daily_coverage(spark, d):
    c = profiles.counts_by(events(spark, d), [F.to_date("ts").alias("day"), F.col("event_type")])
    return c.orderBy("day", "event_type")


def q_hour_coverage(spark, d):
    return profiles.hour_coverage(events(spark, d), [F.to_date("ts").alias("day"), F.col("event_type")],
                                  F.hour("ts"))


def q_value_profile(spark, d):
    return profiles.value_profile(events(spark, d), ["value"])


def q_time_range(spark, d):
    return profiles.time_range(gold(spark, d), "hour_utc")


def q_day_slice(spark, d):
    ev = events(spark, d)
    return ev.filter((F.col("event_type") == "click") & timecols.day_range("ts", SLICE_DAY, ntz=True))


def q_required_not_null(spark, d):
    return profiles.rows_with_nulls(orders_with_nulls(spark, d), NULLABLE_ORDERS)


def q_utc_day_completeness(spark, d):
    keys = event_hour_keys(spark, d)
    members = keys.select("region").distinct()
    return quality.day_exceptions(keys, "region", "hour_utc", members)


def q_region_completeness(spark, d):
    return profiles.member_sets(events(spark, d), "event_type", _members(spark, EXPECTED_TYPES))


def q_qc_report(spark, d):
    ph, xh = stored(price_hourly(spark, d)), stored(weather_hourly(spark, d))
    per_key = stored(quality.per_key_counts(joins.keyed_join(ph, xh, KEYS), KEYS, GOLD_REQUIRED))
    present_types = stored(profiles.distinct_members(events(spark, d), "event_type"))
    return quality.report([
        quality.check_basics_of(per_key, "hour_utc", not_null_name=quality.REQUIRED_NOT_NULL),
        quality.check_members(per_key, "region", present_types, quality.REGION_COMPLETENESS),
        quality.check_continuity(per_key, "region", "hour_utc"),
        quality.check_mappings(per_key, {"Electricity": ph.select(*KEYS), "Weather": xh.select(*KEYS)}, KEYS),
        quality.check_day_completeness(per_key, "region", "hour_utc", present_types, rows="_n"),
    ])


def q_local_time_parts(spark, d):
    ev = events(spark, d).select("event_id", "ts")
    return silver.time_parts(ev, "ts", ZONE, ntz=True).select(
        "event_id", "ts", "local_time", "local_date", "local_hour")


def q_dst_local_day_counts(spark, d):
    o = table(spark, d, "orders")
    spine = grids.hour_spine_of(o, F.min("o_orderdate"),
                                F.max("o_orderdate") + F.expr("INTERVAL 23 HOURS"), out="hour_utc")
    local = spine.select(F.to_date(timecols.to_local_wall("hour_utc", ZONE)).alias("local_date"))
    return profiles.counts_by(local, ["local_date"], "hours")


def q_parse_offset_timestamp(spark, d):
    ev = events(spark, d)
    text = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit("+02:00"))
    return ev.select("event_id", timecols.utc_wall(timecols.parse_offset_instant(text)).alias("parsed"))


def q_array_zip_rows(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return arrays.zip_explode(e, ["vec_id"], {"component": "embedding"}, index="idx")


def q_location_enrich(spark, d):
    return weather_bronze_events(spark, d, whole=True).select(
        "region", "weather_time_utc", "location", "latitude", "longitude")


def q_dimension_join(spark, d):
    return customer_regions(spark, d)


def q_upsert_null_days(spark, d):
    """``upsert_path`` on a table partitioned by day, some days and some keys
    NULL; the source is applied twice."""
    ev = events(spark, d).select(
        F.when(F.col("event_id") % 11 != 0, F.col("event_id")).alias("event_id"),
        F.col("event_id").alias("_id"), "ts", "user_id", "event_type", "value",
        F.when(F.col("event_id") % 7 != 0, F.to_date("ts")).alias("day"))
    first = ev.filter(F.col("_id") % 3 != 0).drop("_id")
    source = ev.filter(F.col("_id") % 3 != 1).drop("_id").withColumn("value", F.col("value") * 2)
    path = staging_path(prepare(spark), "upsert-query")
    for rows in (first, source, source):
        upsert.upsert_path(spark, path, rows, ["event_id"], "day")
    out = stored(spark.read.schema(first.schema).parquet(path).select(*first.columns))
    remove_path(spark, path)
    return out


def q_silver_projection(spark, d):
    ev = events(spark, d).select("event_id", F.col("event_type").alias("region"), "ts", "value")
    return silver.time_parts(ev, "ts", ZONE, ntz=True).drop("local_time")


def q_silver_prices(spark, d):
    sp = silver.prices(price_bronze_events(spark, d, whole=True), ZONE)
    return sp.withColumns({"time_start": timecols.utc_wall("time_start"),
                           "time_end": timecols.utc_wall("time_end")}).select(*SILVER_PRICE_OUT)


def q_silver_weather(spark, d):
    sw = silver.weather(weather_bronze_events(spark, d, whole=True), ZONE)
    return sw.drop("ingestion_time")


def q_gold_build(spark, d):
    sp = stored(silver.prices(price_bronze_events(spark, d), ZONE))
    sw = stored(silver.weather(weather_bronze_events(spark, d), ZONE))
    g = gold_plan.build(spark, sp, sw, mean_scale=6)
    return g.withColumn("hour_utc", timecols.utc_wall("hour_utc"))


def q_gold_increment(spark, d):
    """Gold already built from events before LOADED_BEFORE, without one region;
    the increment over all events adds the hours after each region's mark and
    all hours of the region that has none."""
    sp = stored(silver.prices(price_bronze_events(spark, d), ZONE))
    sw = stored(silver.weather(weather_bronze_events(spark, d), ZONE))
    cut = timecols.utc_literal(LOADED_BEFORE, ntz=False)
    target = gold_plan.build(spark, sp.filter(F.col("time_start") < cut),
                             sw.filter(F.col("weather_time_utc") < timecols.utc_literal(LOADED_BEFORE, ntz=True)),
                             mean_scale=6).filter(F.col("region") != UNLOADED_REGION)
    new = gold_plan.increment(spark, sp, sw, target, lookback=None, mean_scale=6)
    return new.withColumn("hour_utc", timecols.utc_wall("hour_utc"))


def q_monthly_trend(spark, d):
    o = orders_by_region(spark, d)
    return analytics.monthly_trend(o, "region", "o_orderdate", "o_totalprice", mean_scale=6)


def q_daily_observations(spark, d):
    return analytics.daily_observations(gold_with_wind(spark, d), "region", "hour_utc",
                                        ["price", "temperature", "wind"], digits=6)


def q_region_correlation(spark, d):
    g = gold_with_wind(spark, d)
    by_wind = analytics.correlation(g, "region", "price", "wind", digits=6).drop("pairs")
    return analytics.correlation(g, "region", "price", "temperature", digits=6).join(by_wind, "region")


def q_region_spread(spark, d):
    return analytics.pair_spread(gold(spark, d), "region", "hour_utc", "price", "click", "view", digits=6)


def q_region_level(spark, d):
    return analytics.level_vs_overall(gold(spark, d), "region", "price", digits=6)


def q_price_volatility(spark, d):
    return analytics.volatility(price_hourly(spark, d, whole=True), "region", "price", digits=6)


def q_seasonal_profile(spark, d):
    return analytics.hour_of_day_profile(price_feed(spark, d, whole=True), "ts", "price", mean_scale=6)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hourly_rollup": q_hourly_rollup,
    "gold_hourly_join": q_gold_hourly_join,
    "overlap_range": q_overlap_range,
    "anti_left_keys": q_anti_left_keys,
    "anti_right_keys": q_anti_right_keys,
    "existing_overlap": q_existing_overlap,
    "key_presence": q_key_presence,
    "hour_gaps": q_hour_gaps,
    "hour_gaps_lag": q_hour_gaps_lag,
    "worst_gaps_topk": q_worst_gaps_topk,
    "continuity_breaks": q_continuity_breaks,
    "missing_hours": q_missing_hours,
    "upsert_merge": q_upsert_merge,
    "latest_per_key": q_latest_per_key,
    "increment_filter": q_increment_filter,
    "increment_lookback": q_increment_lookback,
    "increment_global": q_increment_global,
    "high_water_mark": q_high_water_mark,
    "latest_date": q_latest_date,
    "date_spine": q_date_spine,
    "missing_dates": q_missing_dates,
    "null_profile": q_null_profile,
    "invalid_members": q_invalid_members,
    "distinct_members": q_distinct_members,
    "invalid_interval": q_invalid_interval,
    "duplicate_keys": q_duplicate_keys,
    "duplicate_histogram": q_duplicate_histogram,
    "distinct_keys": q_distinct_keys,
    "row_counts": q_row_counts,
    "rows_by_region": q_rows_by_region,
    "daily_coverage": q_daily_coverage,
    "hour_coverage": q_hour_coverage,
    "value_profile": q_value_profile,
    "time_range": q_time_range,
    "day_slice": q_day_slice,
    "required_not_null": q_required_not_null,
    "utc_day_completeness": q_utc_day_completeness,
    "region_completeness": q_region_completeness,
    "qc_report": q_qc_report,
    "local_time_parts": q_local_time_parts,
    "dst_local_day_counts": q_dst_local_day_counts,
    "parse_offset_timestamp": q_parse_offset_timestamp,
    "array_zip_rows": q_array_zip_rows,
    "location_enrich": q_location_enrich,
    "dimension_join": q_dimension_join,
    "upsert_null_days": q_upsert_null_days,
    "silver_projection": q_silver_projection,
    "silver_prices": q_silver_prices,
    "silver_weather": q_silver_weather,
    "gold_build": q_gold_build,
    "gold_increment": q_gold_increment,
    "monthly_trend": q_monthly_trend,
    "daily_observations": q_daily_observations,
    "region_correlation": q_region_correlation,
    "region_spread": q_region_spread,
    "region_level": q_region_level,
    "price_volatility": q_price_volatility,
    "seasonal_profile": q_seasonal_profile,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from gridmart import layer_queries
    return QUERIES | layer_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    from gridmart import layer_queries
    from gridmart.oracle import ORACLE
    return {k: v for k, v in (ORACLE | layer_queries.ORACLE).items() if k in queries()}
