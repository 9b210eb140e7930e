"""Plan-shape guards for the scale properties (static plans, AQE off for the inspection)."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield lambda name: E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def n(pat, plan):
    return len(re.findall(pat, plan))


def test_station_mart_reads_silver_once_with_partial_aggregation(static_plans):
    plan = static_plans("gold_stations")
    assert n(r"FileScan parquet", plan) == 1
    assert "partial_min(struct" in plan          # dedup collapses copies before its shuffle
    # both the dedup and the per-(station, lat, lon) aggregate run a partial phase before
    # their shuffle (long function lists are truncated in the plan text, so count phases)
    assert n(r"functions=\[partial_", plan) == 2
    assert n(r"BroadcastExchange", plan) == 0


def test_filters_and_columns_reach_the_scan(static_plans):
    plan = static_plans("aqi_silver")
    assert "PushedFilters: [" in plan and "In(event_type, [error,purchase,signup])" in plan
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in scan


def test_asof_join_moves_its_rows_once(spark, static_plans, tmp_path):
    """Over written tables one exchange carries the left rows, and no join or second sort of them follows."""
    from airshed.operators.joins import combined
    from airshed.plans import queries as Q
    for name in ("weather_silver", "aqi_silver"):
        Q.QUERIES[name](spark, SF).write.parquet(str(tmp_path / name))
    frame = combined(*[spark.read.parquet(str(tmp_path / x)) for x in ("weather_silver", "aqi_silver")], "now")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert n(r"Join", plan) == 0 and n(r"Exchange hashpartitioning", plan) == 3  # two are of the bucket table
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x]
    assert len(scans) == 4 and sum("feels_like_c" in x.split("ReadSchema")[1] for x in scans) == 1
    plan = static_plans("combined")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pivot_and_feeds_are_hash_aggregates(static_plans):
    for name in ["sensor_pivot", "source_fallback"]:
        plan = static_plans(name)
        assert "SortAggregate" not in plan and "HashAggregate" in plan, name


def test_horizon_pairing_has_no_self_join(static_plans):
    plan = static_plans("horizon_samples")
    assert n(r"FileScan parquet", plan) == 2     # the AQ and the weather series, once each
    assert n(r"Window \[", plan) == 1
    # pairs are made after the shuffle: the first operator from the top that makes rows is above
    # every exchange
    assert plan.index("Generate explode") < plan.index("Exchange")


def test_no_query_uses_a_cartesian_product(static_plans):
    rows_only = {"train_metrics", "feature_importance", "nowcast", "forecast_curve", "forecast_peak",
                 "trend", "forecast_downsample", "top_features", "dashboard_forecast", "ingest_stream",
                 "request_forecast", "landing_sinks"}
    for name in E.queries():
        if name in rows_only:
            continue
        plan = static_plans(name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
