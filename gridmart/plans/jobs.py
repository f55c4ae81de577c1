"""Backfill and daily increment over the layers, and the quality gate.

Order of the daily job: price bronze -> price silver, weather bronze ->
weather silver (the two feeds are independent), then gold, then the gate.
State passes between steps only through the tables.  Every write is either a
full replacement (backfill) or a keyed upsert of the touched partitions
(increment), so any step can be re-run after a failure.
"""

from __future__ import annotations

import datetime as _dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.timecols import (feed_local_date, hour_key, parse_offset_instant,
                                         parse_wall_ntz, period_of, utc_wall)
from gridmart.operators import marks as marks_op
from gridmart.operators import profiles, quality
from gridmart.operators.upsert import Touched, latest_landed, upsert_into, upsert_path
from gridmart.plans import daily_state
from gridmart.plans import gold as gold_plan
from gridmart.plans import silver as silver_plan
from gridmart.schemas import (BRONZE_PRICE, BRONZE_PRICE_KEYS, BRONZE_WEATHER,
                              BRONZE_WEATHER_KEYS, GOLD,
                              GOLD_KEYS, LOAD_LOG, LOCAL_ZONE, REGIONS,
                              REQUIRED_GOLD_COLUMNS, SILVER_PRICE,
                              SILVER_PRICE_KEYS, SILVER_WEATHER,
                              SILVER_WEATHER_KEYS, UNREADABLE, WEATHER_MEASURES)
from gridmart.session import assert_utc, shared_dir
from gridmart.sources import footers, landing, tables
from gridmart.sources.bucketed import for_table, silver_table
from gridmart.sources.tables import Layout

# The two DST change days checked by the original gate.
DST_DAYS = ["2025-10-26", "2026-03-29"]


def bronze(spark: SparkSession, landed: landing.Landed, granularity: str, weather_source: str) -> DataFrame:
    """Bronze rows of a load's readable files, tagged with when they landed."""
    if landed.feed == "price":
        return landing.price_bronze(landed.readable, granularity=granularity)
    return landing.weather_bronze(landed.readable, landing.locations(spark), weather_source, granularity)


def common_range(spark: SparkSession, layout: Layout):
    """First and last common hour of the stored silver feeds, from the footers of
    their files: no data page is read."""
    return gold_plan.common_range_of_walls(
        footers.range_walls(spark, layout.silver_price, SILVER_PRICE, "time_start"),
        footers.range_walls(spark, layout.silver_weather, SILVER_WEATHER, "weather_time_utc"))


def log_load(spark: SparkSession, layout: Layout, feed: str, started: _dt.datetime, rows: int) -> None:
    """Append one row to the load log (a tiny table next to the layers)."""
    (spark.createDataFrame([(feed, started, rows)], LOAD_LOG).coalesce(1)
          .write.mode("append").parquet(layout.load_log))


def record_unreadable(spark: SparkSession, layout: Layout, landed: landing.Landed) -> int:
    """Keeps the quarantine of a feed: the files of this load that could not be
    parsed, with their content, and earlier ones that have not landed again
    since.  Returns how many there are."""
    path = layout.path(f"_unreadable/{landed.feed}")
    seen = landed.outcomes.checkpoint(eager=True)
    old = tables.read(spark, path, UNREADABLE)
    bad = landed.quarantined.groupBy("landed_file").agg(F.first("content").alias("content")) \
        .join(seen, "landed_file") \
        .select("landed_file", F.lit(landed.feed).alias("feed"), F.current_timestamp().alias("found_at"),
                "records", "content")
    rows = old.join(seen, "landed_file", "left_anti").select(*UNREADABLE.fieldNames()) \
        .unionByName(bad).checkpoint(eager=True)
    rows.coalesce(1).write.mode("overwrite").parquet(path)
    return rows.count()


def landed_since(spark: SparkSession, layout: Layout, feed: str, bronze_path: str,
                 margin: _dt.timedelta):
    """Files to ingest are those modified after the previous load started
    (less ``margin`` for clock skew between storage and driver).

    The start is read from the load log (a few rows per day), not from the
    bronze table; without a log the latest ``ingestion_time`` of bronze is
    used, and without bronze everything is read (None).  A file copied into
    the landing folder with an old modification time is not seen; the landing
    stream (``streaming.ingest``), which remembers the files it took, sees it.
    """
    log = tables.read(spark, layout.load_log, LOAD_LOG)
    last = (log.filter(F.col("feed") == feed)
               .agg(F.max(utc_wall("load_started")).alias("t")).first()["t"])
    if last is None:
        b = tables.read(spark, bronze_path, BRONZE_PRICE if feed == "price" else BRONZE_WEATHER)
        last = footers.latest_wall(spark, bronze_path, b.schema, "ingestion_time")
    return None if last is None else last - margin


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


def run_backfill(spark: SparkSession, layout: Layout, price_landing: str,
                 weather_landing: str, zone: str = LOCAL_ZONE) -> dict[str, int]:
    """Read every landed file once, rebuild all layers.  A feed without files
    gives empty layers.  Returns rows written per table and the number of
    unreadable files per feed."""
    assert_utc(spark)
    shared_dir(spark)
    out = {}
    g = layout.granularity
    for feed, read, root, path in (("price", landing.stage_price, price_landing, layout.bronze_price),
                                   ("weather", landing.stage_weather, weather_landing, layout.bronze_weather)):
        started = _now()
        landed = read(spark, root)
        try:
            out[f"bronze_{feed}"] = tables.overwrite(
                bronze(spark, landed, g, landing.WEATHER_SOURCE).drop(landing.LANDED), path, "feed_date",
                tables.LAYER_CLUSTERS[f"bronze_{feed}"])
            out[f"unreadable_{feed}"] = record_unreadable(spark, layout, landed)
        finally:
            landed.remove()
        log_load(spark, layout, feed, started, out[f"bronze_{feed}"])
    bp = tables.read(spark, layout.bronze_price, BRONZE_PRICE)
    bw = tables.read(spark, layout.bronze_weather, BRONZE_WEATHER)
    price, weather = (silver_table(layout, feed) for feed in ("price", "weather"))
    out["silver_price"] = price.overwrite(for_table(price, silver_plan.prices(bp, zone, g)))
    out["silver_weather"] = weather.overwrite(for_table(weather, silver_plan.weather(bw, zone, g)))
    sp, sw = price.read(spark), weather.read(spark)
    out["gold"] = tables.overwrite(gold_plan.build(spark, sp, sw, g, bounds=common_range(spark, layout)),
                                   layout.gold, "hour_date",
                                   tables.LAYER_CLUSTERS["gold"])
    if layout.daily_state:
        daily_state.refresh(spark, layout)
    return out


def _silver_increment(bronze: DataFrame, silver_target: DataFrame, key: str, parsed_time,
                      lookback: _dt.timedelta | None, granularity: str) -> DataFrame:
    """Bronze rows after their region's silver mark (minus lookback), all rows
    of a region without a mark, and rows whose time does not parse."""
    m = marks_op.kept(marks_op.high_water_marks(silver_target.filter(F.col(key).isNotNull()), "region", key))
    b = bronze.withColumn("_t", parsed_time)
    lo = m.agg(F.min(utc_wall("mark")).alias("lo")).first()["lo"]
    if lo is not None:
        # Pruning on bronze: no row of a region with a mark before the
        # earliest mark (less lookback, less a day for the feed's own zone)
        # can be needed.  A region without a mark is never cut.
        floor = lo - (lookback or _dt.timedelta(0)) - _dt.timedelta(days=1)
        recent = (F.col("feed_date") >= F.lit(period_of(floor.date(), granularity))) | F.col("feed_date").isNull()
        b = marks_op.since_floor(b, "region", recent, marks_op.unmarked_members(b, m, "region"))
    return marks_op.increment(b, m, "region", "_t", lookback=lookback, keep_null_time=True).drop("_t")


def run_increment(spark: SparkSession, layout: Layout, price_landing: str,
                  weather_landing: str, *, mode: str = "changed",
                  lookback: _dt.timedelta | None = _dt.timedelta(days=2),
                  mark_scope: str = "region", zone: str = LOCAL_ZONE,
                  landing_margin: _dt.timedelta = _dt.timedelta(hours=1)) -> dict[str, int]:
    """Upsert newly landed (or corrected, i.e. re-landed) files through all
    layers.

    Only landing files modified since the previous successful load are read
    (the upsert makes a re-read file idempotent).  Then:

    * mode "changed" (default): silver is re-derived from exactly the bronze
      partitions this load changed, and gold from exactly the silver
      partitions that changed -- work proportional to the change, corrections
      always applied, no scan of the full silver or gold tables;
    * mode "marks": rows after each region's high-water mark (``mark_scope``
      "region") or one global mark ("global"), re-deriving ``lookback``
      before it (None: strictly after, the original rule).

    Of rows with one key the one from the file that landed last wins.  A row
    whose time does not parse stays in bronze and silver (with a NULL time,
    which the null profile counts) and reaches no gold hour.  A file that can
    not be read gives no rows and is listed (``record_unreadable``).

    The load log is written after every layer succeeded, so a failed run is
    retried from the same landing files.
    """
    assert_utc(spark)
    shared_dir(spark)
    if mode not in ("changed", "marks"):
        raise ValueError("mode must be 'changed' or 'marks'")
    out = {}
    since_p = landed_since(spark, layout, "price", layout.bronze_price, landing_margin)
    since_w = landed_since(spark, layout, "weather", layout.bronze_weather, landing_margin)
    g = layout.granularity
    started = _now()
    touched = {}
    for feed, read, root, since, path, keys in (
            ("price", landing.stage_price, price_landing, since_p, layout.bronze_price, BRONZE_PRICE_KEYS),
            ("weather", landing.stage_weather, weather_landing, since_w, layout.bronze_weather,
             BRONZE_WEATHER_KEYS)):
        landed = read(spark, root, since)
        try:
            rows = latest_landed(bronze(spark, landed, g, landing.WEATHER_INCREMENT_SOURCE), keys, landing.LANDED)
            out[f"bronze_{feed}"], touched[feed] = upsert_path(spark, path, rows, keys, "feed_date",
                                                                  cluster=tables.LAYER_CLUSTERS[f"bronze_{feed}"])
            out[f"unreadable_{feed}"] = record_unreadable(spark, layout, landed)
        finally:
            landed.remove()
    if mode == "changed":
        changed_downstream(spark, layout, touched["price"], touched["weather"], zone, out)
    else:
        _marks_downstream(spark, layout, lookback, mark_scope, zone, out)
    log_load(spark, layout, "price", started, out["bronze_price"])
    log_load(spark, layout, "weather", started, out["bronze_weather"])
    return out


def changed_downstream(spark: SparkSession, layout: Layout, touched_bp: Touched | None,
                       touched_bw: Touched | None, zone: str = LOCAL_ZONE, out: dict | None = None) -> dict:
    """Re-derive silver from the touched bronze partitions of each feed and
    gold from the silver partitions that changed; None means "nothing changed
    in this feed"."""
    out = {} if out is None else out
    g = layout.granularity
    price, weather = (silver_table(layout, feed) for feed in ("price", "weather"))
    out["silver_price"], touched_sp = 0, None
    if touched_bp is not None:
        new_bp = touched_bp.rows_of(tables.read(spark, layout.bronze_price, BRONZE_PRICE))
        out["silver_price"], touched_sp = upsert_into(
            spark, price, for_table(price, silver_plan.prices(new_bp, zone, g)), SILVER_PRICE_KEYS)
    out["silver_weather"], touched_sw = 0, None
    if touched_bw is not None:
        new_bw = touched_bw.rows_of(tables.read(spark, layout.bronze_weather, BRONZE_WEATHER))
        out["silver_weather"], touched_sw = upsert_into(
            spark, weather, for_table(weather, silver_plan.weather(new_bw, zone, g)), SILVER_WEATHER_KEYS)
    touched = touched_sw if touched_sp is None else touched_sp.union(touched_sw)
    if touched is None:
        out["gold"] = 0
        return out
    sp, sw = price.read(spark), weather.read(spark)
    if not tables.exists(spark, layout.gold):
        new_g = gold_plan.build(spark, sp, sw, g)
    else:
        # An hour's rows always share one partition, so the changed
        # partitions of either feed hold complete hours of both.
        new_g = gold_plan.join_hourly(gold_plan.price_hourly(touched.rows_of(sp)),
                                      gold_plan.weather_hourly(touched.rows_of(sw)), g)
    _upsert_gold(spark, layout, new_g, out)
    return out


def _upsert_gold(spark: SparkSession, layout: Layout, rows: DataFrame, out: dict) -> None:
    out["gold"], touched = upsert_path(spark, layout.gold, rows, GOLD_KEYS, "hour_date",
                                       cluster=tables.LAYER_CLUSTERS["gold"])
    if layout.daily_state and touched is not None:
        daily_state.refresh(spark, layout, touched)


def _marks_downstream(spark: SparkSession, layout: Layout, lookback, mark_scope: str, zone: str,
                      out: dict) -> None:
    g = layout.granularity
    price, weather = (silver_table(layout, feed) for feed in ("price", "weather"))
    new_bp = _silver_increment(tables.read(spark, layout.bronze_price, BRONZE_PRICE), price.read(spark),
                               "time_start", parse_offset_instant("time_start"), lookback, g)
    out["silver_price"], _ = upsert_into(spark, price, for_table(price, silver_plan.prices(new_bp, zone, g)),
                                         SILVER_PRICE_KEYS)
    new_bw = _silver_increment(tables.read(spark, layout.bronze_weather, BRONZE_WEATHER), weather.read(spark),
                               "weather_time_utc", parse_wall_ntz("weather_time_utc"), lookback, g)
    out["silver_weather"], _ = upsert_into(spark, weather, for_table(weather, silver_plan.weather(new_bw, zone, g)),
                                           SILVER_WEATHER_KEYS)

    sp, sw = price.read(spark), weather.read(spark)
    g_t = tables.read(spark, layout.gold, GOLD)
    new_g = gold_plan.increment(spark, sp, sw, g_t, lookback=lookback, mark_scope=mark_scope,
                                granularity=g)
    _upsert_gold(spark, layout, new_g, out)


def silver_profile(spark: SparkSession, layout: Layout,
                   dst_days: list[str] = DST_DAYS) -> dict[str, DataFrame]:
    """The informational silver checks, as lazy DataFrames (only the row counts,
    which cost no scan, are taken here): null profiles, invalid regions, intervals whose end is
    not after their start, duplicate keys, value profile, daily and hourly
    coverage, bronze-versus-silver row counts and the local DST day lengths."""
    sp = tables.read(spark, layout.silver_price, SILVER_PRICE)
    sw = tables.read(spark, layout.silver_weather, SILVER_WEATHER)
    price_cols = ["price_date", "time_start", "time_end", "price_hour", "region",
                  "SEK_per_kWh", "EUR_per_kWh", "EXR"]
    # counted by the files' footers
    counts = [footers.row_count(spark, layout.tables()[name], tables.LAYER_SCHEMAS[name])
              .select(F.lit(name).alias("table"), "rows")
              for name in ("bronze_price", "silver_price", "bronze_weather", "silver_weather")]
    return {
        "price_nulls": profiles.null_profile(sp, price_cols),
        "weather_nulls": profiles.null_profile(sw, ["weather_time_utc", "region"] + WEATHER_MEASURES),
        "invalid_regions": profiles.invalid_members(sp, "region", REGIONS),
        "invalid_intervals": profiles.invalid_interval(sp, "time_start", "time_end"),
        "price_duplicates": profiles.duplicate_keys(sp, SILVER_PRICE_KEYS),
        "weather_duplicates": profiles.duplicate_keys(sw, SILVER_WEATHER_KEYS),
        "price_values": profiles.value_profile(sp, ["SEK_per_kWh", "EUR_per_kWh"]),
        "daily_coverage": profiles.counts_by(sp, ["price_date", "region"]),
        "hour_coverage": profiles.hour_coverage(sp, ["price_date", "region"], F.col("price_hour")),
        "row_counts": functools.reduce(lambda a, b: a.unionByName(b), counts),
        "dst_local_days": silver_plan.local_day_counts(sw, dst_days),
    }


def _requested(spark: SparkSession, layout: Layout, feed: str, start: _dt.date, end: _dt.date | None,
               regions: list[str]):
    """The feed's loaded (region, day) from ``start``, its regions, and the last
    day it can hold: today for prices, yesterday for weather (the archive lags)."""
    if end is None:
        today = _now().date()
        end = today if feed == "price" else today - _dt.timedelta(days=1)
    path, time_col = ((layout.bronze_price, "time_start") if feed == "price"
                      else (layout.bronze_weather, "weather_time_utc"))
    b = tables.read(spark, path, BRONZE_PRICE if feed == "price" else BRONZE_WEATHER)
    members = spark.createDataFrame([(r,) for r in regions], "region string")
    loaded = b.filter(F.col("feed_date") >= F.lit(period_of(start, layout.granularity))) \
              .select("region", feed_local_date(time_col).alias("day"))
    return loaded, members, end


def missing_landing(spark: SparkSession, layout: Layout, feed: str, start: _dt.date,
                    end: _dt.date | None = None, regions: list[str] = REGIONS) -> DataFrame:
    """(region, day) with no bronze row between ``start`` and ``end`` -- the
    files still to request from a feed that is asked for single days.  Holes in
    the middle are listed, not only days after the latest load.  Only meaningful
    with day partitions or for day-level feeds; the day is the feed's own date."""
    loaded, members, end = _requested(spark, layout, feed, start, end, regions)
    return marks_op.missing_dates(loaded, "region", "day", members, start, end)


def missing_requests(spark: SparkSession, layout: Layout, feed: str, start: _dt.date,
                     end: _dt.date | None = None, regions: list[str] = REGIONS) -> DataFrame:
    """The same as ranges (region, first_day, last_day, days), for a feed whose
    requests take a start and an end (the weather archive): one row a hole."""
    loaded, members, end = _requested(spark, layout, feed, start, end, regions)
    return marks_op.missing_ranges(loaded, "region", "day", members, start, end)


def merge_summary(spark: SparkSession, layout: Layout) -> dict[str, dict]:
    """Post-merge re-check of every layer: rows, distinct keys, duplicated
    keys and the latest time (informational; one aggregation per table)."""
    specs = {
        "bronze_price": (layout.bronze_price, BRONZE_PRICE, BRONZE_PRICE_KEYS, "time_start"),
        "bronze_weather": (layout.bronze_weather, BRONZE_WEATHER, BRONZE_WEATHER_KEYS, "weather_time_utc"),
        "silver_price": (layout.silver_price, SILVER_PRICE, SILVER_PRICE_KEYS, "time_start"),
        "silver_weather": (layout.silver_weather, SILVER_WEATHER, SILVER_WEATHER_KEYS, "weather_time_utc"),
        "gold": (layout.gold, GOLD, GOLD_KEYS, "hour_utc"),
    }
    out = {}
    for name, (path, schema, keys, t) in specs.items():
        if tables.exists(spark, path):
            df = tables.read(spark, path, schema)
            out[name] = profiles.key_stats(df, keys, t).first().asDict()
    return out


def gate_report(spark: SparkSession, layout: Layout, expected_regions: list[str] = REGIONS,
                dst_days: list[str] | None = DST_DAYS,
                expected_until: _dt.datetime | None = None) -> DataFrame:
    """The gold quality report (check, status, detail), its eight published
    checks under their published names.

    Beyond them: every expected region must hold every hour between the first
    gold hour and ``expected_until`` (a UTC wall clock; default the last gold
    hour), so head and tail gaps, a lagging region and, with
    ``expected_until``, a feed that stopped for all regions fail; a DST day
    inside the gold span is checked on the grid of expected regions, so a
    wholly missing day fails; a landed file that could not be read and has not
    landed again fails.

    Region completeness, continuity, the grid and the day lengths come from
    one aggregate of gold by (region, hour), kept in the shared folder.
    """
    shared_dir(spark)
    g = tables.read(spark, layout.gold, GOLD)
    sp = tables.read(spark, layout.silver_price, SILVER_PRICE)
    sw = tables.read(spark, layout.silver_weather, SILVER_WEATHER)
    price_keys = sp.select("region", hour_key("time_start", ntz=False).alias("hour_utc"))
    weather_keys = sw.select("region", F.col("weather_time_utc").cast("timestamp").alias("hour_utc"))
    expected = spark.createDataFrame([(r,) for r in expected_regions], "region string")
    per_key = quality.per_key_counts(g, GOLD_KEYS, REQUIRED_GOLD_COLUMNS).checkpoint(eager=True)
    span = per_key.agg(F.min(utc_wall("hour_utc")).alias("lo"), F.max(utc_wall("hour_utc")).alias("hi")).first()
    checks = [
        quality.check_basics_of(per_key, "hour_utc", not_null_name=quality.REQUIRED_NOT_NULL),
        quality.check_members(per_key, "region", expected, quality.REGION_COMPLETENESS),
        quality.check_continuity(per_key, "region", "hour_utc"),
        quality.check_mappings(per_key, {"Electricity": price_keys, "Weather": weather_keys}, GOLD_KEYS),
        quality.check_no_rows(functools.reduce(
            DataFrame.unionByName, [tables.read(spark, layout.path(f"_unreadable/{f}"), UNREADABLE)
                                    for f in ("price", "weather")]), "Landing files readable", "unreadable_files"),
    ]
    if span["lo"] is not None:
        until = max(span["hi"], expected_until or span["hi"])
        checks.append(quality.check_expected_grid(per_key, "region", "hour_utc", expected, span["lo"], until))
        inside = [d for d in (dst_days or [])
                  if span["lo"].date() <= _dt.date.fromisoformat(d) <= span["hi"].date()]
        if inside:
            checks.append(quality.check_day_completeness(per_key, "region", "hour_utc", expected, days=inside,
                                                         name=quality.DST_DAYS_COMPLETE, rows="_n"))
    return quality.report(checks)


def gate(spark: SparkSession, layout: Layout, **kw) -> list:
    """Run the report and raise ``QualityGateError`` if any check failed."""
    return quality.enforce(gate_report(spark, layout, **kw))
