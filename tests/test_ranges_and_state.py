"""Missing days as ranges; aggregates of gold that merge."""

import datetime as dt
import math
import os
import random

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.operators import marks, profiles
from gridmart.operators.upsert import upsert_path
from gridmart.plans import analytics, daily_state, jobs
from gridmart.schemas import GOLD, GOLD_KEYS
from gridmart.sources import tables
from gridmart.sources.tables import Layout

START, END = dt.date(2024, 1, 1), dt.date(2024, 4, 30)


def _holes(present, members):
    days = [START + dt.timedelta(days=k) for k in range((END - START).days + 1)]
    out = set()
    for m in members:
        run = []
        for d in [*days, None]:
            if d is not None and (m, d) not in present:
                run.append(d)
            elif run:
                out.add((m, run[0], run[-1], len(run)))
                run = []
    return out


@pytest.mark.parametrize("segment", [1, 7, 28, 1000])
def test_ranges_are_the_islands_of_the_missing_days(spark, segment):
    rng = random.Random(3)
    members = ["a", "b", "c", "d", "none"]
    share = {"a": 0.9, "b": 0.5, "c": 0.05, "d": 1.0}
    present = {(m, START + dt.timedelta(days=k)) for m, s in share.items() for k in range(121) if rng.random() < s}
    rows = [*present, ("a", START - dt.timedelta(days=9)), ("b", END + dt.timedelta(days=1)), ("other", START),
            ("a", None), (None, START)] + [(m, d) for m, d in present if m == "b"]
    loaded = spark.createDataFrame(rows, "region string, day date")
    named = spark.createDataFrame([(m,) for m in [*members, "a"]], "region string")
    got = marks.missing_ranges(loaded, "region", "day", named, START, END, segment)
    assert sorted(map(tuple, got.collect())) == sorted(_holes(present, members))
    # the same days as the single ones
    single = marks.missing_dates(loaded, "region", "day", named, START, END)
    expanded = got.select("region", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    assert sorted(map(tuple, expanded.collect())) == sorted(map(tuple, single.collect()))


def test_a_three_day_hole_is_one_request(spark, scratch):
    pl, wl, layout = os.path.join(scratch, "p"), os.path.join(scratch, "w"), Layout(os.path.join(scratch, "t"))
    days = [dt.date(2024, 5, 1) + dt.timedelta(days=k) for k in range(8)]
    os.makedirs(pl)
    for d in days:
        if d.day not in (3, 4, 5):
            feeds.write_weather_file(wl, d, "SE1", feeds.weather_payload(d, "SE1"))
    jobs.run_backfill(spark, layout, pl, wl)
    got = jobs.missing_requests(spark, layout, "weather", days[0], dt.date(2024, 5, 10), ["SE1", "SE2"]).collect()
    assert sorted(map(tuple, got)) == [("SE1", dt.date(2024, 5, 3), dt.date(2024, 5, 5), 3),
                                       ("SE1", dt.date(2024, 5, 9), dt.date(2024, 5, 10), 2),
                                       ("SE2", dt.date(2024, 5, 1), dt.date(2024, 5, 10), 10)]


# Moments and sketches

def _gold(spark, days=40, seed=1):
    rng = random.Random(seed)
    rows = []
    for r in ("SE1", "SE2", "SE3", None):
        for h in range(24 * days):
            t = dt.datetime(2024, 1, 15) + dt.timedelta(hours=h)
            value = [rng.gauss(50 if r == "SE1" else 1, 3) if rng.random() > 0.05 else None for _ in range(7)]
            rows.append((r, t, "x", 1.0, 1.0, *value, 1, t.date()))
    return spark.createDataFrame(rows, GOLD)


def _same(a, b, digits=6):
    def norm(rows):
        return sorted([tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in rows], key=str)
    got, want = norm(a.collect()), norm(b.collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert len(g) == len(w)
        for x, y in zip(g, w):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=2e-6)), (g, w)


def _all_equal(state, gold):
    day = F.to_date("hour_utc")
    gold, eur = gold.withColumn("day", day), "EUR_per_kWh"
    _same(daily_state.trend(state, "region", "day", eur), analytics.monthly_trend(gold, "region", "hour_utc", eur))
    _same(daily_state.daily(state, "region", "day", [eur, "precipitation"]),
          analytics.daily_observations(gold, "region", "hour_utc", [eur, "precipitation"]))
    _same(daily_state.level(state, "region", eur), analytics.level_vs_overall(gold, "region", eur))
    _same(daily_state.correlation(state, "region", eur, "temperature_2m"),
          analytics.correlation(gold, "region", eur, "temperature_2m"))
    _same(daily_state.volatility(state, "region", eur), analytics.volatility(gold, "region", eur))
    measures = daily_state.GOLD_MEASURES
    _same(daily_state.null_profile(state, measures), profiles.null_profile(gold, measures))
    _same(daily_state.value_profile(state, measures), profiles.value_profile(gold, measures))


def test_analytics_from_moments_equal_those_of_gold(spark):
    gold = _gold(spark)
    _all_equal(daily_state._gold_state(gold), gold)


def test_groups_of_one_value_and_of_none(spark):
    one = _gold(spark, 1).filter("hour(hour_utc) = 0")
    none = one.withColumn("EUR_per_kWh", F.lit(None).cast("double"))
    for gold in (one, none, one.limit(0)):
        _all_equal(daily_state._gold_state(gold), gold)


def test_a_correction_replaces_only_the_days_it_changed(spark, scratch):
    layout = Layout(os.path.join(scratch, "t"))
    gold = _gold(spark, 6).filter("region IS NOT NULL")
    tables.overwrite(gold, layout.gold, "hour_date")
    daily_state.refresh(spark, layout)
    files = {d: sorted(os.listdir(os.path.join(layout.path("_daily_state/gold"), d)))
             for d in os.listdir(layout.path("_daily_state/gold")) if d.startswith("hour_date")}
    changed = gold.filter("hour_date = DATE'2024-01-17'").withColumn("EUR_per_kWh", F.col("EUR_per_kWh") * 3)
    _, touched = upsert_path(spark, layout.gold, changed, GOLD_KEYS, "hour_date")
    for _ in range(2):                                          # a repeat changes nothing
        daily_state.refresh(spark, layout, touched)
        _all_equal(daily_state.read(spark, layout), tables.read(spark, layout.gold, GOLD))
    after = {d: sorted(os.listdir(os.path.join(layout.path("_daily_state/gold"), d))) for d in files}
    assert [d for d in files if files[d] != after[d]] == ["hour_date=2024-01-17"]


def test_the_jobs_keep_the_state_with_gold(spark, scratch):
    pl, wl = os.path.join(scratch, "p"), os.path.join(scratch, "w")
    layout = Layout(os.path.join(scratch, "t"), daily_state=True)
    days = [dt.date(2024, 5, 10), dt.date(2024, 5, 11)]
    feeds.write_feeds(pl, wl, days[:1], ["SE1", "SE2"])
    jobs.run_backfill(spark, layout, pl, wl)
    feeds.write_feeds(pl, wl, days, ["SE1", "SE2"])
    jobs.run_increment(spark, layout, pl, wl)
    gold = tables.read(spark, layout.gold, GOLD)
    assert gold.count() == 96
    _all_equal(daily_state.read(spark, layout), gold)
    check = daily_state.key_check(daily_state.read(spark, layout)).first()
    assert check.rows == 96 and not check.duplicates


def test_the_key_check_needs_no_scan_of_gold(spark, scratch, scans):
    layout = Layout(os.path.join(scratch, "t"))
    tables.overwrite(_gold(spark, 3), layout.gold, "hour_date")
    daily_state.refresh(spark, layout)
    done = len(scans())
    check = daily_state.key_check(daily_state.read(spark, layout)).first()
    assert check.rows == 4 * 72
    assert not [s for s in scans()[done:] if layout.gold in s.location]


@pytest.mark.parametrize("keys", [100, 20_000, 300_000])
def test_the_sketch_error_holds(spark, keys):
    df = spark.range(keys).select(F.col("id").cast("string").alias("region"), F.col("id").alias("h"),
                                  (F.col("id") % 50).alias("day"))
    state = daily_state.moments(df, ["day"], [], [], ["region", "h"])
    check = daily_state.key_check(state).first()
    assert check.rows == keys and not check.duplicates
    assert abs(check.distinct_keys_estimate - keys) <= daily_state.KEY_ERROR * keys
    twice = daily_state.key_check(state.unionByName(state)).first()     # every key again
    assert twice.duplicates and abs(twice.distinct_keys_estimate - keys) <= daily_state.KEY_ERROR * keys
