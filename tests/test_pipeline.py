"""End to end: landing files -> bronze -> silver -> gold -> gate."""

import datetime as dt
import os

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.operators.quality import QualityGateError
from gridmart.plans import jobs
from gridmart.sources.tables import Layout

D1 = dt.date(2024, 5, 10)


def _setup(scratch, n_days=2, start=D1, regions=feeds.REGIONS, step=60):
    pl, wl = os.path.join(scratch, "landing/price"), os.path.join(scratch, "landing/weather")
    feeds.write_feeds(pl, wl, [start + dt.timedelta(days=i) for i in range(n_days)], regions, step)
    return pl, wl, Layout(os.path.join(scratch, "tables"))


def _gold_rows(spark, layout):
    g = spark.read.parquet(layout.gold).drop("hour_date")
    return sorted(tuple(r) for r in g.collect())


def test_backfill_builds_common_range_and_passes_gate(spark, scratch):
    pl, wl, layout = _setup(scratch)
    counts = jobs.run_backfill(spark, layout, pl, wl)
    # 2 UTC days of weather x 4 regions inside a wider price range (C1, C6)
    assert counts["gold"] == 192
    g = spark.read.parquet(layout.gold)
    r = g.agg(F.min("hour_utc").alias("lo"), F.max("hour_utc").alias("hi")).first()
    assert r["lo"] == dt.datetime(2024, 5, 10, 0, 0)
    assert r["hi"] == dt.datetime(2024, 5, 11, 23, 0)
    rows = jobs.gate(spark, layout)
    assert {x["status"] for x in rows} <= {"PASS", "INFO"}
    # price feed is wider than the overlap: informational only (C15)
    info = {x["check"]: x["detail"] for x in rows}
    assert info["Electricity-only keys"] != "source_only_keys=0"


def test_quarter_hour_prices_are_averaged(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=1, step=15)
    counts = jobs.run_backfill(spark, layout, pl, wl)
    assert counts["gold"] == 96
    assert counts["silver_price"] == 4 * 3 * 24 * 4   # 3 local days, 4 per hour
    g = spark.read.parquet(layout.gold)
    one = g.filter((F.col("region") == "SE1") & (F.col("hour_utc") == dt.datetime(2024, 5, 10, 5))).first()
    assert one["EUR_per_kWh"] == pytest.approx(0.5 + 5 / 100)


def test_increment_adds_new_days_and_is_idempotent(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=2)
    jobs.run_backfill(spark, layout, pl, wl)
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=2)])
    jobs.run_increment(spark, layout, pl, wl)
    first = _gold_rows(spark, layout)
    assert len(first) == 3 * 96
    jobs.run_increment(spark, layout, pl, wl)          # same input again (C20)
    assert _gold_rows(spark, layout) == first
    jobs.gate(spark, layout)
    summary = jobs.merge_summary(spark, layout)        # Q19
    assert summary["gold"]["rows"] == summary["gold"]["distinct_keys"] == 3 * 96
    assert all(s["duplicate_keys"] == 0 for s in summary.values())
    assert summary["gold"]["max_hour_utc"] == dt.datetime(2024, 5, 12, 23)


def test_increment_on_empty_target_takes_everything(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=2)
    jobs.run_increment(spark, layout, pl, wl)          # no tables yet (C17)
    assert len(_gold_rows(spark, layout)) == 192


def test_split_history_equals_backfill(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=3)
    jobs.run_backfill(spark, layout, pl, wl)
    full = _gold_rows(spark, layout)

    os.makedirs(os.path.join(scratch, "split"))
    pl2, wl2 = os.path.join(scratch, "split/price"), os.path.join(scratch, "split/weather")
    feeds.write_feeds(pl2, wl2, [D1, D1 + dt.timedelta(days=1)])
    layout2 = Layout(os.path.join(scratch, "split/tables"))
    jobs.run_backfill(spark, layout2, pl2, wl2)
    feeds.write_feeds(pl2, wl2, [D1 + dt.timedelta(days=2)])
    jobs.run_increment(spark, layout2, pl2, wl2)
    assert _gold_rows(spark, layout2) == full


def _correct_day(pl, day, factor):
    for r in feeds.REGIONS:
        recs = feeds.price_records(day, r, value=lambda reg, t: feeds.price_value(reg, t) * factor)
        feeds.write_price_file(pl, day, r, recs)


def test_correction_strict_ignored_lookback_applied(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=2)
    jobs.run_backfill(spark, layout, pl, wl)
    before = _gold_rows(spark, layout)
    _correct_day(pl, D1 + dt.timedelta(days=1), 2.0)   # C18
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=None)
    assert _gold_rows(spark, layout) == before
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=dt.timedelta(days=3))
    after = _gold_rows(spark, layout)
    assert after != before and len(after) == len(before)


def test_late_region_kept_by_region_marks(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=2)
    jobs.run_backfill(spark, layout, pl, wl)
    d3 = D1 + dt.timedelta(days=2)
    feeds.write_feeds(pl, wl, [d3], regions=["SE1", "SE2", "SE3"])
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=None)
    with pytest.raises(QualityGateError):
        jobs.gate(spark, layout)                        # SE4 lags: grid check fails
    feeds.write_feeds(pl, wl, [d3], regions=["SE4"])  # arrives a day later (C19)
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=None)
    assert len(_gold_rows(spark, layout)) == 3 * 96
    jobs.gate(spark, layout)


def test_late_region_lost_by_global_mark(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=2)
    jobs.run_backfill(spark, layout, pl, wl)
    d3 = D1 + dt.timedelta(days=2)
    feeds.write_feeds(pl, wl, [d3], regions=["SE1", "SE2", "SE3"])
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=None, mark_scope="global")
    feeds.write_feeds(pl, wl, [d3], regions=["SE4"])
    jobs.run_increment(spark, layout, pl, wl, mode="marks", lookback=None, mark_scope="global")
    g = spark.read.parquet(layout.gold)
    assert g.filter((F.col("region") == "SE4") & (F.col("hour_date") == F.lit(d3))).count() == 0


def test_session_zone_must_be_utc(spark, scratch):
    from gridmart.session import SessionZoneError
    pl, wl, layout = _setup(scratch, n_days=1)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Stockholm")   # C26
    try:
        with pytest.raises(SessionZoneError):
            jobs.run_backfill(spark, layout, pl, wl)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_partitions_split_history(spark, scratch):
    pl, wl, _ = _setup(scratch, n_days=3, start=dt.date(2024, 5, 30))   # spans May/June
    full = Layout(os.path.join(scratch, "full"), "month")
    jobs.run_backfill(spark, full, pl, wl)
    assert sorted(r.hour_date.isoformat() for r in
                  spark.read.parquet(full.gold).select("hour_date").distinct().collect()) == \
        ["2024-05-01", "2024-06-01"]
    pl2, wl2 = os.path.join(scratch, "p2"), os.path.join(scratch, "w2")
    feeds.write_feeds(pl2, wl2, [dt.date(2024, 5, 30), dt.date(2024, 5, 31)])
    part = Layout(os.path.join(scratch, "part"), "month")
    jobs.run_backfill(spark, part, pl2, wl2)
    feeds.write_feeds(pl2, wl2, [dt.date(2024, 6, 1)])
    jobs.run_increment(spark, part, pl2, wl2)
    assert _gold_rows(spark, part) == _gold_rows(spark, full)
    jobs.gate(spark, part)


def test_changed_mode_applies_corrections_and_late_regions(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=2)
    jobs.run_backfill(spark, layout, pl, wl)
    d3 = D1 + dt.timedelta(days=2)
    feeds.write_feeds(pl, wl, [d3], regions=["SE1", "SE2", "SE3"])
    jobs.run_increment(spark, layout, pl, wl)
    feeds.write_feeds(pl, wl, [d3], regions=["SE4"])            # late region
    _correct_day(pl, D1, 3.0)                                    # correction of day 1
    jobs.run_increment(spark, layout, pl, wl)
    rows = _gold_rows(spark, layout)
    assert len(rows) == 3 * 96
    g = spark.read.parquet(layout.gold)
    one = g.filter((F.col("region") == "SE2") & (F.col("hour_utc") == dt.datetime(2024, 5, 10, 5))).first()
    assert one["EUR_per_kWh"] == pytest.approx((0.6 + 5 / 100) * 3.0)
    jobs.gate(spark, layout)


def test_silver_profile_and_missing_landing(spark, scratch):
    pl, wl, layout = _setup(scratch, n_days=3)
    os.remove(os.path.join(pl, "2024", "05-11_SE2.json"))               # C25: hole in the middle
    feeds.write_price_file(pl, dt.date(2024, 5, 10), "SE9",
                           feeds.price_records(dt.date(2024, 5, 10), "SE9"))   # C9
    jobs.run_backfill(spark, layout, pl, wl)
    prof = jobs.silver_profile(spark, layout)
    assert [r.region for r in prof["invalid_regions"].collect()] == ["SE9"]
    assert prof["price_duplicates"].count() == 0
    assert prof["invalid_intervals"].count() == 0
    counts = {r.table: r.rows for r in prof["row_counts"].collect()}
    assert counts["bronze_price"] == counts["silver_price"]
    miss = jobs.missing_landing(spark, layout, "price", dt.date(2024, 5, 9), dt.date(2024, 5, 14))
    got = sorted((r.region, r.day.isoformat()) for r in miss.collect())
    assert ("SE2", "2024-05-11") in got
    assert [d for r, d in got if r == "SE1"] == ["2024-05-14"]


def test_landed_since_reads_the_log(spark, scratch):
    layout = Layout(os.path.join(scratch, "t"))
    assert jobs.landed_since(spark, layout, "price", layout.bronze_price, dt.timedelta(0)) is None
    for i in range(5):
        jobs.log_load(spark, layout, "price", dt.datetime(2024, 1, 1 + i, tzinfo=dt.timezone.utc), i)
    assert jobs.landed_since(spark, layout, "price", layout.bronze_price, dt.timedelta(0)) == \
        dt.datetime(2024, 1, 5)
    os.makedirs(os.path.join(scratch, "u/_loads"))            # a folder without a data file
    empty = Layout(os.path.join(scratch, "u"))
    assert jobs.landed_since(spark, empty, "price", empty.bronze_price, dt.timedelta(0)) is None
