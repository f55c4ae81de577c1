"""Every enforced check must FAIL on its own injected defect."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmart.operators import profiles, quality
from gridmart.schemas import GOLD, GOLD_KEYS, REGIONS, REQUIRED_GOLD_COLUMNS

D0 = dt.datetime(2025, 10, 25)


def _gold(spark, hours=72, regions=REGIONS):
    rows = []
    for r in regions:
        for h in range(hours):
            t = D0 + dt.timedelta(hours=h)
            rows.append((r, t, "loc", 60.0, 18.0, 1.0, 0.1, 11.0, 5.0, 80.0, 0.0, 3.0, 1, t.date()))
    return spark.createDataFrame(rows, GOLD)


def _expected(spark):
    return spark.createDataFrame([(r,) for r in REGIONS], "region string")


def _gate(spark, g, keys=None):
    keys = keys if keys is not None else g.select(*GOLD_KEYS)
    exp = _expected(spark)
    rep = quality.report([
        quality.check_keys(g, GOLD_KEYS),
        quality.check_members(g, "region", exp, "Region completeness"),
        quality.check_continuity(g, "region", "hour_utc"),
        quality.check_mapped(g, keys, GOLD_KEYS, "Gold keys map to price"),
        quality.check_not_null(g, REQUIRED_GOLD_COLUMNS),
        quality.check_expected_grid(g, "region", "hour_utc", exp, D0, D0 + dt.timedelta(hours=71)),
        quality.check_day_completeness(g, "region", "hour_utc", exp, days=["2025-10-26"]),
        quality.info_time_range(g, "hour_utc"),
    ])
    return {r["check"]: (r["status"], r["detail"]) for r in rep.collect()}


def _failed(res):
    return sorted(k for k, (s, _) in res.items() if s == "FAIL")


def test_clean_gold_passes(spark):
    res = _gate(spark, _gold(spark))
    assert _failed(res) == []
    assert res["Time range"] == ("INFO", "min=2025-10-25 00:00:00, max=2025-10-27 23:00:00")


def test_duplicate_key_fails(spark):
    g = _gold(spark)
    res = _gate(spark, g.unionByName(g.limit(1)))
    assert {"Duplicate Gold keys", "Gold rows = distinct keys"} <= set(_failed(res))


def test_missing_region_fails(spark):
    res = _gate(spark, _gold(spark, regions=["SE1", "SE3", "SE4"]))     # C10
    assert "Region completeness" in _failed(res)
    assert res["Region completeness"][1] == "missing=1 (first: SE2), unexpected=0 (first: -)"
    assert "Expected hourly grid" in _failed(res)


def test_unexpected_region_listed(spark):
    res = _gate(spark, _gold(spark, regions=REGIONS + ["SE9"]))         # C9
    assert res["Region completeness"][1] == "missing=0 (first: -), unexpected=1 (first: SE9)"


def test_interior_gap_fails_continuity(spark):
    g = _gold(spark).filter(~((F.col("region") == "SE1") & (F.col("hour_utc") == D0 + dt.timedelta(hours=10))))
    res = _gate(spark, g)                                             # C12
    assert "Hourly continuity" in _failed(res)


def test_tail_gap_only_grid_sees_it(spark):
    g = _gold(spark).filter(~((F.col("region") == "SE1") & (F.col("hour_utc") == D0 + dt.timedelta(hours=71))))
    res = _gate(spark, g)
    assert res["Hourly continuity"][0] == "PASS"
    assert "Expected hourly grid" in _failed(res)


def test_absent_dst_day_fails_grid_rule(spark):
    day = F.to_date("hour_utc")
    g = _gold(spark).filter(~((F.col("region") == "SE2") & (day == F.lit(dt.date(2025, 10, 26)))))
    res = _gate(spark, g)                                             # C13
    assert "UTC day completeness" in _failed(res)
    # the group-only rule of the original gate would have passed
    groups = g.filter(day == F.lit(dt.date(2025, 10, 26))).groupBy("region", day).count()
    assert groups.filter(F.col("count") != 24).count() == 0


def test_unmapped_key_fails(spark):
    g = _gold(spark)
    keys = g.select(*GOLD_KEYS).filter(~((F.col("region") == "SE3") & (F.col("hour_utc") == D0)))
    res = _gate(spark, g, keys)                                       # C14
    assert res["Gold keys map to price"] == ("FAIL", "missing_keys=1")


def test_required_null_fails_but_latitude_null_passes(spark):
    g = _gold(spark)
    bad = g.withColumn("EXR", F.when(F.col("hour_utc") == D0, None).otherwise(F.col("EXR")))
    assert "Required fields not null" in _failed(_gate(spark, bad))   # C16
    ok = g.withColumn("latitude", F.lit(None).cast("double"))
    assert "Required fields not null" not in _failed(_gate(spark, ok))


def test_empty_gold_fails_and_enforce_raises(spark):
    g = spark.createDataFrame([], GOLD)
    res = _gate(spark, g)
    assert "Region completeness" in _failed(res)
    with pytest.raises(quality.QualityGateError) as e:
        quality.enforce(quality.report([quality.check_members(g, "region", _expected(spark), "Region completeness")]))
    assert e.value.failed == ["Region completeness"]


def test_profiles(spark):
    df = spark.createDataFrame([("SE1", None, 1.0), ("SE9", "x", None), (None, "y", 3.0)],
                               "region string, t string, p double")
    nulls = profiles.null_profile(df, ["region", "t", "p"]).first()
    assert tuple(nulls) == (1, 1, 1)                                  # C7
    assert [r.region for r in profiles.invalid_members(df, "region", REGIONS).collect()] == ["SE9"]
    empty = profiles.null_profile(df.limit(0), ["p"]).first()
    assert empty[0] == 0                                              # T21: 0, not NULL
    iv = spark.createDataFrame([(D0, D0), (D0, D0 + dt.timedelta(hours=1))], "s timestamp, e timestamp")
    assert profiles.invalid_interval(iv, "s", "e").count() == 1      # C8


def test_basics_equal_separate_checks(spark):
    g = _gold(spark)
    bad = g.unionByName(g.limit(1)).withColumn(
        "EXR", F.when(F.col("hour_utc") == D0 + dt.timedelta(hours=3), None).otherwise(F.col("EXR")))
    sep = quality.report([quality.check_keys(bad, GOLD_KEYS), quality.check_not_null(bad, REQUIRED_GOLD_COLUMNS),
                          quality.info_time_range(bad, "hour_utc")])
    one = quality.check_basics(bad, GOLD_KEYS, REQUIRED_GOLD_COLUMNS, "hour_utc")
    assert sorted(tuple(r) for r in sep.collect()) == sorted(tuple(r) for r in one.collect())
