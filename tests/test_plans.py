"""Plan regression: the physical plans keep the properties the scale design
relies on."""

import re

import pytest

import __spark_entry__ as E
from gridmart import driver_queries

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(driver_queries.queries()))
def test_no_cartesian_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_gold_join_reuses_rollup_partitioning(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()["gold_hourly_join"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    # one exchange per roll-up, none added for the join
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_filters_reach_the_scan(spark):
    plan = _plan(E.queries()["day_slice"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,click\)", plan)
    plan = _plan(E.queries()["increment_global"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts", plan)


def test_columns_pruned(spark):
    plan = _plan(E.queries()["hourly_rollup"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = _plan(E.queries()["latest_per_key"](spark, SF))
    assert "partial_max_by" in plan
