"""Queries on stored layers: each writes a layer made from the driver tables with
the library's own writers, applies the feature to it and reads the result.

The layer lies in the session's shared folder and is removed once the result is
kept (``stored``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart import driver_queries as D
from gridmart import oracle
from gridmart.functions import timecols
from gridmart.operators import marks, profiles, upsert
from gridmart.plans import daily_state, jobs, silver
from gridmart.plans import gold as gold_plan
from gridmart.schemas import GOLD, PRICE_FEED
from gridmart.session import remove_path, staging_path
from gridmart.sources import bucketed, footers, landing, tables
from gridmart.streaming import continuity, gold_join

CLUSTER = ("event_type", "ts")
SLICE_TYPE = "purchase"
SLICE_FROM, SLICE_TO = _dt.datetime(2024, 1, 8), _dt.datetime(2024, 1, 15)
BUCKETS = 8


def _kept(df: DataFrame, path: str) -> DataFrame:
    out = D.stored(df)
    remove_path(df.sparkSession, path)
    return out


def _event_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.events(spark, d).select("event_id", "ts", "user_id", "event_type", "value")


def q_upsert_scattered_days(spark, d):
    """The first and the last day of a layer are corrected in one upsert; no
    partition between them is read."""
    ev = _event_rows(spark, d).withColumn("day", F.to_date("ts"))
    path = staging_path(D.prepare(spark), "scattered-query")
    tables.overwrite(ev, path, "day", CLUSTER)
    ends = ev.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    corrected = ev.filter((F.col("day") == F.lit(ends["lo"])) | (F.col("day") == F.lit(ends["hi"]))) \
        .withColumn("value", F.col("value") * 2)
    upsert.upsert_path(spark, path, corrected, ["event_id"], "day", cluster=CLUSTER)
    return _kept(tables.read(spark, path, ev.schema), path)


def q_quarantine_fan_out(spark, d):
    """Every event is a landed file with one price record, each thirteenth cut
    off in the middle; one parse gives bronze rows and the quarantine."""
    ev = D.events(spark, d)
    sound = F.to_json(F.struct(F.col("value").alias("EUR_per_kWh"), D._offset_text(F.col("ts")).alias("time_start")))
    broken = F.concat(F.lit('{"EUR_per_kWh": '), F.col("event_id").cast("string"))
    name = F.concat(F.lit("event-"), F.col("event_id").cast("string"))
    # bound to a column first: the parser must not see the text's two forms apart
    text = D.stored(ev.select(F.when(F.col("event_id") % 13 == 0, broken).otherwise(sound).alias("text"),
                              F.col("event_type").alias("region"), F.to_date("ts").alias("file_date"),
                              name.alias("landed_file"), F.col("ts").cast("timestamp").alias("at")))
    parsed = text.select(F.from_json("text", PRICE_FEED).alias("r"), "region", "file_date", "landed_file",
                         F.struct("at", F.col("landed_file").alias("file")).alias(landing.LANDED)) \
        .select("r.*", "region", "file_date", "landed_file", landing.LANDED)
    landed = landing.stage(parsed, "price")
    good = landing.price_bronze(landed.readable, source="events").select(
        F.col(f"{landing.LANDED}.file").alias("landed_file"), "region", "EUR_per_kWh",
        F.lit(None).cast("string").alias("content"))
    bad = landed.quarantined.select("landed_file", F.lit(None).cast("string").alias("region"),
                                    F.lit(None).cast("double").alias("EUR_per_kWh"), "content")
    out = good.unionByName(bad).join(landed.outcomes, "landed_file")
    return _kept(out, landed.path)


def q_footer_profile(spark, d):
    """Rows, NULLs and ranges of a stored layer, by partition and as a whole,
    from the footers of its files."""
    ev = D.events(spark, d).select(
        "event_id", "ts", F.col("ts").cast("timestamp").alias("instant"), "event_type",
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.trunc(F.to_date("ts"), "month").alias("month"))
    path = staging_path(D.prepare(spark), "footer-query")
    tables.overwrite(ev, path, "month", CLUSTER)
    whole = {}
    for found in (footers.row_count(spark, path, ev.schema, "all_rows"),
                  footers.null_profile(spark, path, ev.schema, ["value", "event_type"]),
                  footers.value_profile(spark, path, ev.schema, ["ts", "instant", "value", "event_id"])):
        walls = found.select(*[timecols.utc_wall(c).alias(c) if t == "timestamp" else c for c, t in found.dtypes])
        whole |= walls.first().asDict()
    out = footers.counts_by_partition(spark, path, ev.schema, "month").select("month", "rows", *[
        (timecols.ts_literal(v, ntz=True) if isinstance(v, _dt.datetime) else F.lit(v)).alias(k)
        for k, v in whole.items()])
    return _kept(out.withColumns({k: F.col(k).cast("long") for k in whole if k.endswith(("rows", "nulls", "id"))}), path)


def q_clustered_slice(spark, d):
    """A week of one event type from a layer clustered by type and time."""
    ev = _event_rows(spark, d).withColumn("month", F.trunc(F.to_date("ts"), "month"))
    path = staging_path(D.prepare(spark), "slice-query")
    tables.overwrite(ev, path, "month", CLUSTER)
    part = tables.read(spark, path, ev.schema).filter(
        (F.col("event_type") == SLICE_TYPE) & (F.col("ts") >= timecols.utc_literal(SLICE_FROM, ntz=True))
        & (F.col("ts") < timecols.utc_literal(SLICE_TO, ntz=True)))
    return _kept(part, path)


def q_bucketed_gold(spark, d):
    """``gold_build`` from silver tables bucketed by (region, hour)."""
    path = staging_path(D.prepare(spark), "bucketed-query")
    layout = tables.Layout(path, "month", BUCKETS)
    price, weather = (bucketed.silver_table(layout, f) for f in ("price", "weather"))
    price.overwrite(silver.with_hour(silver.prices(D.price_bronze_events(spark, d), D.ZONE, "month")))
    weather.overwrite(silver.with_hour(silver.weather(D.weather_bronze_events(spark, d), D.ZONE, "month")))
    gold = gold_plan.build(spark, price.read(spark), weather.read(spark), "month", mean_scale=6)
    hour = timecols.utc_wall("hour_utc")
    out = D.stored(gold.withColumns({"hour_utc": hour, "hour_date": F.to_date(hour)}))
    price.detach(spark)
    weather.detach(spark)
    remove_path(spark, path)
    return out


def q_missing_ranges(spark, d):
    """The holes of ``missing_dates``, one row each."""
    o = D.orders_by_region(spark, d).select("region", F.to_date("o_orderdate").alias("day"))
    b = D.table(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")).alias("lo"),
                                        F.max(F.to_date("o_orderdate")).alias("hi")).first()
    regions = D.table(spark, d, "region").select(F.col("r_name").alias("region"))
    return marks.missing_ranges(o, "region", "day", regions, b["lo"], b["hi"])


MEASURES, PAIR = ["price", "temperature"], ("price", "temperature")


def _state(gold: DataFrame) -> DataFrame:
    return daily_state.moments(gold, ["region", "day"], MEASURES, [PAIR], D.KEYS)


def q_moments_after_correction(spark, d):
    """Analytics of gold from its stored daily moments, after the prices of the
    first and the last day were doubled and those two days alone replaced."""
    g = D.stored(D.gold(spark, d).withColumn("day", F.to_date("hour_utc")))
    state = _state(g)
    path = staging_path(D.prepare(spark), "moments-query")
    table = tables.PathTable(path, T.StructType([T.StructField(f.name, f.dataType, True) for f in state.schema]), "day")
    table.overwrite(state)
    ends = g.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    changed = g.filter((F.col("day") == F.lit(ends["lo"])) | (F.col("day") == F.lit(ends["hi"]))) \
        .withColumn("price", F.col("price") * 2)
    table.replace(_state(changed), staged=False)
    s = table.read(spark)
    out = daily_state.correlation(s, "region", *PAIR, digits=6) \
        .join(daily_state.volatility(s, "region", "price", digits=6), "region") \
        .join(daily_state.level(s, "region", "price", digits=6), "region") \
        .join(s.groupBy("region").agg(F.min("price_min").alias("min_price"), F.max("price_max").alias("max_price")),
              "region")
    return _kept(out, path)


def q_key_sketches(spark, d):
    """The stored sketches' check of gold's keys, on gold and on gold with every
    row twice: is the estimate within its error of the exact count, and are the
    duplicates seen?"""
    g = D.stored(D.gold(spark, d).withColumn("day", F.to_date("hour_utc")))
    rows = []
    for name, df in (("gold", g), ("doubled", g.unionByName(g))):
        exact = profiles.key_stats(df, D.KEYS).select("distinct_keys").first()[0]
        check = daily_state.key_check(_state(df))
        rows.append(check.select(
            F.lit(name).alias("layer"), "rows", F.col("duplicates"),
            (F.abs(F.col("distinct_keys_estimate") - F.lit(exact)) <= F.lit(daily_state.KEY_ERROR * exact))
            .alias("within_error")))
    return rows[0].unionByName(rows[1])


DELAY_HOURS = 2


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    # a pattern, since the table may be one file, which a stream takes no folder for
    return D.prepare(spark).readStream.schema(D.events(spark, d).schema).parquet(f"{d.rstrip('/')}/events.parque[t]")


def _drained(stream: DataFrame, path: str) -> DataFrame:
    """All the stream gives of the rows that are there now."""
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state") \
        .trigger(availableNow=True).start().awaitTermination()
    return _kept(stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out"), path)


def q_gold_stream(spark, d):
    """Gold of two streams of events, both feeds at once: prices from all events,
    weather from the hours that have one (a value of the hour itself)."""
    ev = _event_stream(spark, d)
    prices = ev.select(F.col("event_type").alias("region"), F.col("ts").cast("timestamp").alias("time_start"),
                       (F.col("value") * 11).alias("SEK_per_kWh"), F.col("value").alias("EUR_per_kWh"),
                       F.lit(11.0).alias("EXR"))
    hour = F.hour("ts").cast("double")
    weather = _event_stream(spark, d).filter(F.col("event_id") % 2 == 1).select(
        F.col("event_type").alias("region"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("weather_time_utc"),
        F.lit(None).cast("string").alias("location"), F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"), hour.alias("temperature_2m"),
        F.lit(50.0).alias("relative_humidity_2m"), F.lit(0.0).alias("precipitation"),
        (hour / 10).alias("wind_speed_10m"), F.lit(1).alias("weather_code"))
    out = _drained(gold_join.gold(prices, weather, f"{DELAY_HOURS} hours"), staging_path(D.prepare(spark), "gold-stream"))
    return out.withColumns({"hour_utc": timecols.utc_wall("hour_utc"),
                            **{c: F.round(c, 6) for c in ("SEK_per_kWh", "EUR_per_kWh")}})


def q_continuity_monitor(spark, d):
    """Holes of each event type's hours, as its state and timers report them."""
    rows = _event_stream(spark, d).select("event_type", F.col("ts").cast("timestamp").alias("at"))
    out = _drained(continuity.holes(rows, "event_type", "at", f"{DELAY_HOURS} hours"),
                   staging_path(D.prepare(spark), "monitor"))
    return out.withColumns({c: timecols.utc_wall(c) for c in ("previous_hour", "hour_utc")})


def _land(files: DataFrame, root: str) -> None:
    """Writes rows (year, name, content) as the feeds land them, one file each:
    ``{root}/{year}/{name}.json``.  Spark names its own files, so each is moved to
    its place; there are as many as days and regions, however large they are."""
    spark, path = files.sparkSession, staging_path(files.sparkSession, "landing")
    files.select("year", "name", F.col("content").alias("value")).write.partitionBy("year", "name").text(path)
    fs, make = tables._fs(spark, path)
    for part in fs.globStatus(make(f"{path}/year=*/name=*/part-*")):
        file = part.getPath()
        year, name = (p.getName().split("=")[1] for p in (file.getParent().getParent(), file.getParent()))
        fs.mkdirs(make(f"{root}/{year}"))
        fs.rename(file, make(f"{root}/{year}/{name}.json"))
    remove_path(spark, path)


def _landing_files(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Price and weather files of all events: a price file for each region and
    local day, a weather file for each region and UTC day."""
    codes = F.create_map(*[F.lit(x) for kv in D.REGION_OF_TYPE.items() for x in kv])
    ev = D.events(spark, d).withColumn("region", F.coalesce(codes[F.col("event_type")], "event_type"))

    def files(rows: DataFrame, content) -> DataFrame:
        return rows.groupBy("region", "day").agg(F.sort_array(F.collect_list("r")).alias("r")).select(
            "day", F.date_format("day", "yyyy").alias("year"),
            F.concat(F.date_format("day", "MM-dd"), F.lit("_"), "region").alias("name"), content.alias("content"))

    # one record for each second, the feed's resolution
    second = ev.groupBy("region", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("t")).agg(
        F.max("value").alias("v"))
    record = F.struct(D._offset_text(F.col("t")).alias("time_start"),
                      D._offset_text(F.col("t") + F.make_dt_interval(mins=F.lit(15))).alias("time_end"),
                      (F.col("v") * 11).alias("SEK_per_kWh"), F.col("v").alias("EUR_per_kWh"),
                      (F.lit(10.0) + F.hour("t").cast("double") / F.lit(100.0)).alias("EXR"))
    prices = files(second.select("region", F.to_date(timecols.to_local_wall("t", D.ZONE)).alias("day"),
                                 record.alias("r")), F.to_json("r"))
    k = F.get_json_object("props", "$.k").cast("double")
    hourly = ev.groupBy("region", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t")).agg(F.max(k).alias("k"))
    names = {"time": "t", "temperature_2m": "k", "relative_humidity_2m": "h", "precipitation": "p",
             "wind_speed_10m": "w", "weather_code": "c"}
    measured = F.struct(F.date_format("t", "yyyy-MM-dd'T'HH:mm").alias("t"), "k", F.lit(50.0).alias("h"),
                        F.lit(0.0).alias("p"), (F.col("k") / 10).alias("w"), F.lit(1).alias("c"))
    arrays = F.struct(*[F.col(f"r.{short}").alias(name) for name, short in names.items()])
    weather = files(hourly.select("region", F.to_date("t").alias("day"), measured.alias("r")),
                    F.to_json(F.struct(F.lit(60.0).alias("latitude"), F.lit(18.0).alias("longitude"),
                                       arrays.alias("hourly"))))
    return prices, weather


def q_daily_job(spark, d):
    """The jobs on landed files made from events: a backfill of the history, then
    the daily increment over the files that land after it; the gold they leave."""
    root = staging_path(D.prepare(spark), "daily-job")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    layout, landing_at = tables.Layout(f"{root}/tables", "month"), (f"{root}/price", f"{root}/weather")
    cut = F.lit(D.LOADED_BEFORE).cast("date")
    feeds = [D.stored(f) for f in _landing_files(spark, d)]
    for files, at in zip(feeds, landing_at):
        _land(files.filter(F.col("day") < cut), at)
    jobs.run_backfill(spark, layout, *landing_at)
    for files, at in zip(feeds, landing_at):
        _land(files.filter(F.col("day") >= cut), at)
    jobs.run_increment(spark, layout, *landing_at)
    gold = tables.read(spark, layout.gold, GOLD)
    hour = timecols.utc_wall("hour_utc")
    return _kept(gold.withColumns({"hour_utc": hour, "hour_date": F.to_date(hour),
                                   **{c: F.round(c, 6) for c in ("SEK_per_kWh", "EUR_per_kWh")}}), root)


QUERIES = {
    "daily_job": q_daily_job,
    "gold_stream": q_gold_stream,
    "continuity_monitor": q_continuity_monitor,
    "upsert_scattered_days": q_upsert_scattered_days,
    "quarantine_fan_out": q_quarantine_fan_out,
    "footer_profile": q_footer_profile,
    "clustered_slice": q_clustered_slice,
    "bucketed_gold": q_bucketed_gold,
    "missing_ranges": q_missing_ranges,
    "moments_after_correction": q_moments_after_correction,
    "key_sketches": q_key_sketches,
}

_w = oracle._w

# The watermark: the latest event, less the delay; weather's is that of its hours.
CLOSED_BEFORE = f"""(SELECT least(max(ts), max(date_trunc('hour', ts)) FILTER (WHERE event_id % 2 = 1))
                           - INTERVAL {DELAY_HOURS} HOUR FROM events)"""
CLOSED_HOUR = f"(SELECT date_trunc('hour', max(date_trunc('hour', ts)) - INTERVAL {DELAY_HOURS} HOUR) FROM events)"

_REGION = """CASE event_type WHEN 'click' THEN 'SE1' WHEN 'error' THEN 'SE2' WHEN 'purchase' THEN 'SE3'
                          WHEN 'signup' THEN 'SE4' ELSE event_type END"""

ORACLE = {
    "daily_job": _w(
        """SELECT P1.region, P1.hour_utc, location, latitude, longitude, SEK_per_kWh, EUR_per_kWh,
                  10.0::DOUBLE + CAST(hour(P1.hour_utc) AS DOUBLE) / 100.0::DOUBLE AS EXR, temperature_2m,
                  50.0::DOUBLE AS relative_humidity_2m, 0.0::DOUBLE AS precipitation,
                  temperature_2m / 10::DOUBLE AS wind_speed_10m, 1 AS weather_code, CAST(P1.hour_utc AS DATE) AS hour_date
           FROM P1 JOIN W1 ON P1.region = W1.region AND P1.hour_utc = W1.hour_utc LEFT JOIN LOC ON LOC.region = P1.region""",
        f"""P1 AS (SELECT region, date_trunc('hour', t) AS hour_utc, round(avg(v * 11), 6) AS SEK_per_kWh,
                          round(avg(v), 6) AS EUR_per_kWh
                   FROM (SELECT {_REGION} AS region, date_trunc('second', ts) AS t, max(value) AS v
                         FROM events GROUP BY ALL) GROUP BY ALL)""",
        f"""W1 AS (SELECT {_REGION} AS region, date_trunc('hour', ts) AS hour_utc,
                          max(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS temperature_2m
                   FROM events GROUP BY ALL)"""),
    "gold_stream": f"""
        SELECT P.region, P.hour_utc, NULL::VARCHAR AS location, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude,
               round(avg(value * 11), 6) AS SEK_per_kWh, round(avg(value), 6) AS EUR_per_kWh, 11.0::DOUBLE AS EXR,
               CAST(hour(P.hour_utc) AS DOUBLE) AS temperature_2m, 50.0::DOUBLE AS relative_humidity_2m,
               0.0::DOUBLE AS precipitation, CAST(hour(P.hour_utc) AS DOUBLE) / 10 AS wind_speed_10m, 1 AS weather_code,
               CAST(P.hour_utc AS DATE) AS hour_date
        FROM (SELECT event_type AS region, date_trunc('hour', ts) AS hour_utc, ts, any_value(value) AS value
              FROM events GROUP BY ALL) P
        WHERE P.hour_utc + INTERVAL 1 HOUR <= {CLOSED_BEFORE}
          AND EXISTS (SELECT 1 FROM events e WHERE e.event_id % 2 = 1 AND e.event_type = P.region
                                               AND date_trunc('hour', e.ts) = P.hour_utc)
        GROUP BY P.region, P.hour_utc""",
    "continuity_monitor": f"""
        SELECT event_type, 'closed' AS kind, previous_hour, hour_utc, date_diff('hour', previous_hour, hour_utc) AS gap_hours
        FROM (SELECT event_type, h AS hour_utc, lag(h) OVER (PARTITION BY event_type ORDER BY h) AS previous_hour
              FROM (SELECT DISTINCT event_type, date_trunc('hour', ts) AS h FROM events))
        WHERE hour_utc < {CLOSED_HOUR} AND date_diff('hour', previous_hour, hour_utc) > 1
        UNION ALL
        SELECT event_type, 'open', max(h), NULL, date_diff('hour', max(h), {CLOSED_HOUR})
        FROM (SELECT event_type, date_trunc('hour', ts) AS h FROM events) WHERE h < {CLOSED_HOUR}
        GROUP BY 1 HAVING max(h) + INTERVAL 1 HOUR < {CLOSED_HOUR}""",
    "upsert_scattered_days": """
        SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS day,
               CASE WHEN CAST(ts AS DATE) IN ((SELECT min(CAST(ts AS DATE)) FROM events),
                                              (SELECT max(CAST(ts AS DATE)) FROM events)) THEN value * 2 ELSE value END AS value
        FROM events""",
    "quarantine_fan_out": """
        SELECT 'event-' || event_id AS landed_file, event_id % 13 = 0 AS bad,
               CASE WHEN event_id % 13 = 0 THEN 0::BIGINT ELSE 1::BIGINT END AS records,
               CASE WHEN event_id % 13 <> 0 THEN event_type END AS region,
               CASE WHEN event_id % 13 <> 0 THEN value END AS EUR_per_kWh,
               CASE WHEN event_id % 13 = 0 THEN '{"EUR_per_kWh": ' || event_id END AS content
        FROM events""",
    "footer_profile": """
        SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS rows, w.* FROM events,
          (SELECT count(*) AS all_rows, count(*) FILTER (WHERE event_id % 5 = 0 OR value IS NULL) AS value_nulls,
                  count(*) FILTER (WHERE event_type IS NULL) AS event_type_nulls,
                  min(ts) AS min_ts, max(ts) AS max_ts, min(ts) AS min_instant, max(ts) AS max_instant,
                  min(value) FILTER (WHERE event_id % 5 <> 0) AS min_value,
                  max(value) FILTER (WHERE event_id % 5 <> 0) AS max_value,
                  min(event_id) AS min_event_id, max(event_id) AS max_event_id FROM events) w
        GROUP BY ALL""",
    "clustered_slice": f"""
        SELECT event_id, ts, user_id, event_type, value, CAST(date_trunc('month', ts) AS DATE) AS month FROM events
        WHERE event_type = '{SLICE_TYPE}' AND ts >= TIMESTAMP '{SLICE_FROM}' AND ts < TIMESTAMP '{SLICE_TO}'""",
    "bucketed_gold": oracle.ORACLE["gold_build"],
    "missing_ranges": f"""
        SELECT region, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM
          (SELECT region, day, day - CAST(row_number() OVER (PARTITION BY region ORDER BY day) AS INTEGER) AS island
           FROM ({oracle.ORACLE["missing_dates"]}))
        GROUP BY region, island""",
    "moments_after_correction": _w(
        """SELECT C.region, count(*) AS pairs, round(corr(price, temperature), 6) AS corr_price_temperature,
                  round(stddev_samp(price), 6) AS stddev_price, round(sum(price) / count(price), 6) AS mean,
                  round(any_value(A.a), 6) AS overall_mean, round(sum(price) / count(price) - any_value(A.a), 6) AS difference,
                  min(price) AS min_price, max(price) AS max_price
           FROM C, (SELECT sum(price) / count(price) AS a FROM C) A GROUP BY C.region""",
        """C AS (SELECT region, hour_utc, temperature,
                        CASE WHEN CAST(hour_utc AS DATE) IN ((SELECT min(CAST(hour_utc AS DATE)) FROM G),
                                                             (SELECT max(CAST(hour_utc AS DATE)) FROM G))
                             THEN price * 2 ELSE price END AS price FROM G)"""),
    "key_sketches": _w(
        """SELECT 'gold' AS layer, count(*) AS rows, false AS duplicates, true AS within_error FROM G
           UNION ALL SELECT 'doubled', 2 * count(*), true, true FROM G"""),
}
