"""Layouts that save work later: clustered files, safe replacement, buckets."""

import datetime as dt
import os
import re

import feeds
import pytest
from pyspark.sql import functions as F

from gridmart.plans import gold as gold_plan
from gridmart.plans import jobs
from gridmart.plans import silver as silver_plan
from gridmart.schemas import SILVER_PRICE, SILVER_WEATHER
from gridmart.sources import bucketed, tables
from gridmart.sources.tables import Layout

D1 = dt.date(2024, 5, 10)
SMALL = {"parquet.block.size": "65536", "parquet.page.size": "4096"}


def _series(spark, regions=20, hours=2_000):
    """Rows of ``regions`` series, dealt out without any order."""
    return spark.range(regions * hours).select(
        F.concat(F.lit("R"), F.lpad((F.col("id") % regions).cast("string"), 2, "0")).alias("region"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(hours=(F.col("id") / regions).cast("int"))).alias("t"),
        F.rand(7).alias("a"), F.rand(8).alias("b"),
        F.make_date(F.lit(2024), F.lit(1) + ((F.col("id") / regions / 1_000).cast("int")), F.lit(1)).alias("month")) \
        .repartition(4)


def _slice_rows(spark, scans, path, schema):
    done = len(scans())
    part = spark.read.schema(schema).parquet(path).filter("region = 'R07'")
    rows = sorted(tuple(r) for r in part.select("region", "t", "a").collect())
    own = [s for s in scans()[done:] if path in s.location]
    return rows, sum(s.rows for s in own)


def test_a_slice_of_one_region_reads_a_fraction_of_the_row_groups(spark, scratch, scans):
    df = _series(spark)
    loose, tight = os.path.join(scratch, "loose"), os.path.join(scratch, "tight")
    assert tables.overwrite(df, loose, "month", options=SMALL) == 40_000
    assert tables.overwrite(df, tight, "month", ("region", "t"), options=SMALL) == 40_000
    want, all_rows = _slice_rows(spark, scans, loose, df.schema)
    got, few_rows = _slice_rows(spark, scans, tight, df.schema)
    assert got == want and len(got) == 2_000
    assert all_rows == 40_000                     # every row group holds every region
    assert few_rows < all_rows / 3, few_rows
    # and one day of one region by the instant's statistics
    done = len(scans())
    day = spark.read.schema(df.schema).parquet(tight).filter(
        "region = 'R07' AND t >= '2024-02-10' AND t < '2024-02-11'")
    assert day.count() == 24
    assert sum(s.rows for s in scans()[done:]) <= few_rows


def test_layers_written_by_the_jobs_are_clustered(spark, scratch):
    pl, wl, layout = _feeds(scratch, 3)
    jobs.run_backfill(spark, layout, pl, wl)
    new = D1 + dt.timedelta(days=3)
    feeds.write_feeds(pl, wl, [new])
    jobs.run_increment(spark, layout, pl, wl)
    for name, path in layout.tables().items():
        key = list(tables.LAYER_CLUSTERS[name])
        part = {"bronze": "feed_date", "silver": "utc_date", "gold": "hour_date"}[name.split("_")[0]]
        rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), part, *key,
                                               F.monotonically_increasing_id().alias("i")).orderBy("i").collect()
        by_file = {}
        for r in rows:
            by_file.setdefault(r.f, []).append(tuple(r[k] for k in key))
        assert all(v == sorted(v) for v in by_file.values()), name


def test_instants_have_statistics_in_the_footers(spark, scratch):
    path = os.path.join(scratch, "t")
    tables.overwrite(_series(spark, 2, 10), path, "month")
    import pyarrow.parquet as pq
    files = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    meta = pq.ParquetFile(files[0]).metadata.row_group(0)
    t = next(meta.column(i) for i in range(meta.num_columns) if meta.column(i).path_in_schema == "t")
    assert t.physical_type == "INT64" and t.statistics.has_min_max


# Replacement of a whole layer

def _listing(path):
    return sorted(os.listdir(os.path.dirname(path)))


def test_a_failed_replacement_keeps_the_old_table(spark, scratch):
    path = os.path.join(scratch, "layers/t")
    tables.overwrite(_series(spark, 2, 10), path, "month")
    broken = _series(spark, 2, 10).withColumn("a", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        tables.overwrite(broken, path, "month")
    assert spark.read.parquet(path).count() == 20 and _listing(path) == ["t"]


def test_a_replacement_may_read_the_table_it_replaces(spark, scratch):
    path = os.path.join(scratch, "layers/t")
    tables.overwrite(_series(spark, 2, 10), path, "month")
    old = tables.read(spark, path, _series(spark).schema)
    assert tables.overwrite(old.filter("region = 'R01'"), path, "month") == 10
    assert tables.read(spark, path, _series(spark).schema).count() == 10 and _listing(path) == ["t"]


@pytest.mark.parametrize("whole", [True, False])
def test_an_interrupted_swap_is_settled(spark, scratch, whole):
    path = os.path.join(scratch, "layers/t")
    tables.overwrite(_series(spark, 2, 10), path, "month")
    tables.overwrite(_series(spark, 3, 10), path + ".new-1", "month")
    if not whole:
        os.remove(os.path.join(path + ".new-1", "_SUCCESS"))
    os.rename(path, path + ".old-1")                     # the run ended between the two renames
    tables.settle(spark, path)
    assert spark.read.parquet(path).count() == (30 if whole else 20) and _listing(path) == ["t"]
    tables.settle(spark, path)
    assert _listing(path) == ["t"]


# Buckets

def _feeds(scratch, n_days, buckets=0, name="t", step=30):
    pl, wl = os.path.join(scratch, "p"), os.path.join(scratch, "w")
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=k) for k in range(n_days)], step_minutes=step)
    return pl, wl, Layout(os.path.join(scratch, name), "month", buckets)


def _gold(spark, layout):
    return sorted(tuple(r) for r in spark.read.parquet(layout.gold).collect())


def _no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def test_gold_from_bucketed_silver_has_no_exchange(spark, scratch):
    pl, wl, layout = _feeds(scratch, 2, buckets=4)
    jobs.run_backfill(spark, layout, pl, wl)
    price, weather = (bucketed.silver_table(layout, f) for f in ("price", "weather"))
    _no_broadcast(spark)
    try:
        df = gold_plan.build(spark, price.read(spark), weather.read(spark), "month")
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plain = gold_plan.build(spark, tables.read(spark, layout.silver_price, SILVER_PRICE),
                                tables.read(spark, layout.silver_weather, SILVER_WEATHER), "month")
        plain_plan = plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plain_plan)) >= 2
    assert "SelectedBucketsCount: 4 out of 4" in plan


def test_bucketed_and_plain_layouts_hold_the_same_gold(spark, scratch):
    pl, wl, plain = _feeds(scratch, 2, name="plain")
    bucket = Layout(os.path.join(scratch, "bucketed"), "month", 4)
    for layout in (plain, bucket):
        jobs.run_backfill(spark, layout, pl, wl)
    feeds.write_feeds(pl, wl, [D1 + dt.timedelta(days=2)], step_minutes=30)
    for r in feeds.REGIONS:                              # and a correction
        feeds.write_price_file(pl, D1, r, feeds.price_records(D1, r, value=lambda *_: 7.0))
    for layout in (plain, bucket):
        jobs.run_increment(spark, layout, pl, wl)
        jobs.run_increment(spark, layout, pl, wl, mode="marks")
    assert _gold(spark, plain) == _gold(spark, bucket) and len(_gold(spark, plain)) == 3 * 96
    jobs.gate(spark, bucket)


def test_a_session_that_does_not_know_the_table_attaches_its_files(spark, scratch):
    pl, wl, layout = _feeds(scratch, 1, buckets=3)
    jobs.run_backfill(spark, layout, pl, wl)
    price = bucketed.silver_table(layout, "price")
    rows = price.read(spark).count()
    price.detach(spark)
    assert not spark.catalog.tableExists(price.name)
    assert price.read(spark).count() == rows
    # replaced as a whole: only the new rows, in new files
    sample = price.read(spark).filter("region = 'SE1'").select(*price.schema.fieldNames())
    n = price.overwrite(sample)
    assert n == price.read(spark).count() == rows // 4
    assert [d for d in os.listdir(os.path.dirname(price.path)) if d.startswith("price")] == ["price"]


def test_hours_of_null_times_stay_null(spark):
    sw = spark.createDataFrame([(None, "SE1")], "weather_time_utc timestamp_ntz, region string")
    assert silver_plan.with_hour(sw).first().hour_utc is None
