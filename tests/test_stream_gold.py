"""Gold as a stream-stream join, and the continuity monitor with its timers."""

import datetime as dt
import os
import random

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.operators import gaps
from gridmart.plans import jobs
from gridmart.schemas import GOLD
from gridmart.sources import tables
from gridmart.sources.tables import Layout
from gridmart.streaming import continuity, gold_join

D1 = dt.date(2024, 5, 10)
T0 = dt.datetime(2024, 5, 10)


def _gold(spark, layout, before=None):
    g = tables.read(spark, layout.gold, GOLD)
    g = g if before is None else g.filter(F.col("hour_utc") < F.lit(before.isoformat()).cast("timestamp"))
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in g.collect())


def _run(spark, scratch, layout, pl, wl, **kw):
    q = gold_join.gold_from_landing(spark, layout, pl, wl, checkpoint=os.path.join(scratch, "ckpt"), **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_both_feeds_at_once_give_batch_gold(spark, scratch):
    pl, wl = os.path.join(scratch, "p"), os.path.join(scratch, "w")
    batch, stream = Layout(os.path.join(scratch, "batch")), Layout(os.path.join(scratch, "stream"))
    regions = ["SE1", "SE2"]
    feeds.write_feeds(pl, wl, [D1], regions, step_minutes=30)
    _run(spark, scratch, stream, pl, wl)
    first = len(_gold(spark, stream))
    assert 0 < first < 48                                # the last hours are still open
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=1)], regions, step_minutes=30)
    _run(spark, scratch, stream, pl, wl)
    jobs.run_backfill(spark, batch, pl, wl)
    # weather ends at 23:00 of the second day; less two hours
    closed = T0 + dt.timedelta(days=1, hours=21)
    assert _gold(spark, stream) == _gold(spark, batch, closed)
    assert len(_gold(spark, stream)) == 2 * 45


def test_late_rows_within_the_watermark_are_in_their_hour(spark, scratch):
    pl, wl = os.path.join(scratch, "p"), os.path.join(scratch, "w")
    layout = Layout(os.path.join(scratch, "t"))
    day = feeds.price_records(D1, "SE1", 30)             # local day: 22:00 the day before to 22:00
    weather = feeds.weather_payload(D1, "SE1")
    late = [r for r in day if "T12:30" in r["time_start"]]
    feeds.write_price_file(pl, D1, "SE1", [r for r in day if r not in late and r["time_start"] < "2024-05-10T14"])
    feeds.write_weather_file(wl, D1, "SE1", weather)
    _run(spark, scratch, layout, pl, wl, delay="6 hours")
    # the half hour that was missing, twice over, and the rest of the day
    feeds.write_price_file(pl, D1 + dt.timedelta(days=30), "SE1", late + late)
    feeds.write_price_file(pl, D1 + dt.timedelta(days=31), "SE1",
                           [r for r in day if r["time_start"] >= "2024-05-10T14"])
    feeds.write_price_file(pl, D1 + dt.timedelta(days=1), "SE1", feeds.price_records(D1 + dt.timedelta(days=1), "SE1"))
    feeds.write_weather_file(wl, D1 + dt.timedelta(days=1), "SE1",
                             feeds.weather_payload(D1 + dt.timedelta(days=1), "SE1"))
    _run(spark, scratch, layout, pl, wl, delay="6 hours")
    rows = {r.hour_utc: r for r in tables.read(spark, layout.gold, GOLD).collect()}
    hour = dt.datetime(2024, 5, 10, 10)                  # 12:00 local
    assert rows[hour].EUR_per_kWh == pytest.approx(feeds.price_value("SE1", hour.replace(tzinfo=feeds.UTC)))
    assert len(rows) == 24 + 15                          # prices end at 21:00; less six hours


def test_state_is_dropped_behind_the_watermark(spark, scratch):
    pl, wl = os.path.join(scratch, "p"), os.path.join(scratch, "w")
    layout = Layout(os.path.join(scratch, "t"))
    for k in range(3):
        d = D1 + dt.timedelta(days=k)
        feeds.write_price_file(pl, d, "SE1", feeds.price_records(d, "SE1"))
        feeds.write_weather_file(wl, d, "SE1", feeds.weather_payload(d, "SE1"))
        q = _run(spark, scratch, layout, pl, wl)
    held = [s.numRowsTotal for p in q.recentProgress[-1:] for s in p.stateOperators]
    assert held and max(held) < 24, held                 # three days went through
    assert len(_gold(spark, layout)) > 48


# Continuity

def _hours(spark, rows):
    return spark.createDataFrame([(r, T0 + dt.timedelta(hours=h)) for r, h in rows], "region string, hour_utc timestamp")


class Feed:
    """A stream fed file by file."""

    def __init__(self, spark, scratch):
        self.spark, self.path, self.at = spark, os.path.join(scratch, "rows"), scratch
        os.makedirs(self.path)
        self.reports = []

    def send(self, rows):
        _hours(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)
        stream = self.spark.readStream.schema("region string, hour_utc timestamp").parquet(self.path)

        def keep(batch, _):
            self.reports += [tuple(r) for r in batch.collect()]
        q = continuity.holes(stream, "region", "hour_utc").writeStream.foreachBatch(keep) \
            .option("checkpointLocation", os.path.join(self.at, "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        return self

    def closed(self):
        return sorted((r, p, h, g) for r, kind, p, h, g in self.reports if kind == "closed")


def _at(h):
    return T0 + dt.timedelta(hours=h)


def test_a_stopped_region_raises_its_hour(spark, scratch):
    feed = Feed(spark, scratch)
    feed.send([(r, h) for r in ("a", "b") for h in range(5)])
    assert feed.reports == []
    feed.send([("a", h) for h in range(5, 12)])           # b has stopped after hour 4
    assert [r[:3] for r in feed.reports] == [("b", "open", _at(4))]
    feed.send([("a", h) for h in range(12, 15)])
    assert len(feed.reports) == 1                         # reported once
    feed.send([("a", 20), ("b", 16), ("b", 17)])
    feed.send([("a", 30), ("b", 30)])
    rows = [("a", h) for h in range(15)] + [("b", h) for h in range(5)] + [("a", 20), ("b", 16), ("b", 17)]
    want = gaps.segmented_gaps(_hours(spark, rows), "region", "hour_utc").collect()
    assert feed.closed()[:2] == sorted(tuple(r)[:1] + (r.previous_hour, r.hour_utc, r.gap_hours) for r in want)


def test_an_hour_within_the_watermark_closes_its_hole(spark, scratch):
    feed = Feed(spark, scratch)
    feed.send([("a", h) for h in (0, 1, 2, 4)])
    feed.send([("a", 3), ("a", 4), ("a", 5)])
    feed.send([("a", h) for h in range(6, 20)])
    assert feed.reports == []


def test_steps_find_the_holes_of_the_closed_hours():
    rng = random.Random(2)
    for _ in range(300):
        present = sorted(rng.sample(range(60), rng.randint(1, 50)))
        sent, last, reported, seen, reports = present[:], None, None, [], []
        at = 0
        while at < 64:
            at += rng.randint(1, 6)
            now = [h for h in sent if h < at]             # within the watermark's delay of two hours
            sent = [h for h in sent if h >= at]
            rng.shuffle(now)
            out, last, reported, seen = continuity.advance("r", now, last, reported, seen, max(0, at - 2))
            reports += out
            wake = continuity._wake_at(last, reported, seen)
            assert wake is None or wake >= max(0, at - 2) * continuity.HOUR_MS
        want = [("r", "closed", a, b, b - a) for a, b in zip(present, present[1:]) if b - a > 1]
        assert [r for r in reports if r[1] == "closed"] == want
        opened = [r[2] for r in reports if r[1] == "open"]
        assert len(opened) == len(set(opened)) and present[-1] in opened
