"""One parse of every landing file per load; unreadable files in quarantine."""

import datetime as dt
import os

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.plans import jobs
from gridmart.schemas import UNREADABLE
from gridmart.sources import landing, tables
from gridmart.sources.tables import Layout
from gridmart.streaming import ingest

D1 = dt.date(2024, 5, 10)
BROKEN = '[{"SEK_per_kWh": 1.0, "time_start": '


def _setup(scratch, days=2, regions=("SE1", "SE2")):
    pl, wl = os.path.join(scratch, "landing/price"), os.path.join(scratch, "landing/weather")
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=k) for k in range(days)], list(regions))
    return pl, wl, Layout(os.path.join(scratch, "tables"))


def _break(root, day, region, text=BROKEN):
    path = feeds.write_price_file(root, day, region, [])
    with open(path, "w") as f:
        f.write(text)
    return path


def _json(found, root):
    return [s for s in found if s.kind.startswith("Scan json") and root in s.location]


def _files(root):
    return sum(len(names) for _, _, names in os.walk(root))


def _records(root):
    import json
    n = 0
    for d, _, names in os.walk(root):
        for name in names:
            with open(os.path.join(d, name)) as f:
                try:
                    loaded = json.load(f)
                except ValueError:
                    loaded = [None]
                n += len(loaded) if isinstance(loaded, list) else 1
    return n


def _quarantine(spark, layout, feed="price"):
    return {os.path.basename(r.landed_file): r for r in
            tables.read(spark, layout.path(f"_unreadable/{feed}"), UNREADABLE).collect()}


def test_a_backfill_parses_every_file_once(spark, scratch, scans):
    pl, wl, layout = _setup(scratch)
    _break(pl, D1 + dt.timedelta(days=5), "SE1")
    _break(wl, D1 + dt.timedelta(days=5), "SE2", "{")
    out = jobs.run_backfill(spark, layout, pl, wl)
    for root in (pl, wl):
        own = _json(scans(), root)
        assert len(own) == 1, [(s.kind, s.location) for s in own]
        assert own[0].files == _files(root) and own[0].rows == _records(root)
    assert (out["unreadable_price"], out["unreadable_weather"]) == (1, 1)
    assert out["bronze_price"] == _records(pl) - 1


def test_an_increment_parses_the_new_files_once(spark, scratch, scans):
    pl, wl, layout = _setup(scratch)
    jobs.run_backfill(spark, layout, pl, wl)
    done = len(scans())
    new = D1 + dt.timedelta(days=3)
    feeds.write_price_file(pl, new, "SE1", feeds.price_records(new, "SE1"))
    feeds.write_weather_file(wl, new, "SE1", feeds.weather_payload(new, "SE1"))
    _break(pl, new, "SE2")
    jobs.run_increment(spark, layout, pl, wl, landing_margin=dt.timedelta(seconds=-1))
    found = scans()[done:]
    assert [(s.files, s.rows) for s in _json(found, pl)] == [(2, 25)]
    assert [(s.files, s.rows) for s in _json(found, wl)] == [(1, 1)]


def test_quarantine_keeps_the_content_until_the_file_lands_again(spark, scratch):
    pl, wl, layout = _setup(scratch)
    bad = _break(pl, D1 + dt.timedelta(days=1), "SE2")
    jobs.run_backfill(spark, layout, pl, wl)
    held = _quarantine(spark, layout)
    assert list(held) == [os.path.basename(bad)]
    row = held[os.path.basename(bad)]
    assert row.content == BROKEN and row.feed == "price" and row.records == 0
    # another load leaves it there; a sound file of the same name takes it out
    jobs.run_increment(spark, layout, pl, wl, landing_margin=dt.timedelta(seconds=-1))
    assert list(_quarantine(spark, layout)) == list(held)
    day = D1 + dt.timedelta(days=1)
    feeds.write_price_file(pl, day, "SE2", feeds.price_records(day, "SE2"))
    jobs.run_increment(spark, layout, pl, wl)
    assert _quarantine(spark, layout) == {}
    whole = Layout(os.path.join(scratch, "whole"))
    jobs.run_backfill(spark, whole, pl, wl)
    for a, b in ((layout.gold, whole.gold), (layout.silver_price, whole.silver_price)):
        cols = [c for c in spark.read.parquet(a).columns if c not in ("ingestion_time", "source")]
        assert sorted(map(str, spark.read.parquet(a).select(cols).collect())) == \
            sorted(map(str, spark.read.parquet(b).select(cols).collect()))


def test_staged_rows_are_apart_and_removed(spark, scratch):
    pl, _, _ = _setup(scratch, days=1)
    _break(pl, D1 + dt.timedelta(days=5), "SE1")
    _break(pl, D1 + dt.timedelta(days=6), "SE1", "")              # an empty file has nothing to parse
    landed = landing.stage_price(spark, pl)
    assert landed.quarantined.count() == 1
    assert landed.readable.count() == _records(pl) - 2
    assert landed.readable.filter(F.col("region").isNull()).count() == 0
    seen = {os.path.basename(r.landed_file): (r.bad, r.records) for r in landed.outcomes.collect()}
    assert seen["05-15_SE1.json"] == (True, 0) and seen["05-10_SE1.json"] == (False, 24)
    assert tables.exists(spark, landed.path)
    landed.remove()
    assert not tables.exists(spark, landed.path)


def test_a_failed_load_leaves_no_staged_rows_and_can_be_run_again(spark, scratch, monkeypatch):
    pl, wl, layout = _setup(scratch, days=1)
    staged = []
    real = landing.stage
    monkeypatch.setattr(landing, "stage", lambda *a: staged.append(real(*a)) or staged[-1])

    def fail(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(jobs, "upsert_into", fail)
        m.setattr(jobs, "upsert_path", fail)
        with pytest.raises(RuntimeError):
            jobs.run_increment(spark, layout, pl, wl)
    assert staged and not any(tables.exists(spark, s.path) for s in staged)
    assert jobs.run_increment(spark, layout, pl, wl)["gold"] == 48


def test_no_files_at_all(spark, scratch):
    pl, wl = os.path.join(scratch, "p"), os.path.join(scratch, "w")
    os.makedirs(pl), os.makedirs(wl)
    out = jobs.run_backfill(spark, Layout(os.path.join(scratch, "t")), pl, wl)
    assert set(out.values()) == {0}


def test_the_layered_stream_quarantines_and_parses_once(spark, scratch, scans):
    pl, wl, layout = _setup(scratch, days=1)
    bad = _break(pl, D1, "SE4")
    for feed, root in (("price", pl), ("weather", wl)):
        ingest.layered_stream(spark, layout, feed, root, checkpoint=os.path.join(scratch, feed)).awaitTermination()
    assert list(_quarantine(spark, layout)) == [os.path.basename(bad)]
    own = [s for s in scans() if s.kind.startswith("Scan json")]
    assert sum(s.rows for s in own) == _records(pl) + _records(wl)
    assert spark.read.parquet(layout.gold).count() == 48


@pytest.mark.parametrize("text", ["", "[]"])
def test_files_without_records_are_not_quarantined(spark, scratch, text):
    pl, wl, layout = _setup(scratch, days=1)
    _break(pl, D1, "SE4", text)
    assert jobs.run_backfill(spark, layout, pl, wl)["unreadable_price"] == 0
