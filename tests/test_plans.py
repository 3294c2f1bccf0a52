"""Physical-plan properties the design relies on at scale."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF01


from conftest import SF001

from telewatch.operators import dashboard as dash
from telewatch.operators import quality, rollup
from telewatch.plans.catalog import Fixture
from telewatch.sources.devices import seed_devices
from telewatch.sources.tables import Warehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SF01)


def test_alert_detection_is_map_only(spark):
    from telewatch.functions.enrich import enrich
    from telewatch.operators.alerts import detect_alerts
    from telewatch.sources.fixtures import telemetry_from_events

    raw = telemetry_from_events(spark.read.parquet(f"{SF01}/events.parquet"))
    p = plan(detect_alerts(enrich(raw)))
    assert "Exchange" not in p and "Generate" in p



def test_scan_prunes_unused_columns(fx):
    p = plan(dash.alerts_by(fx.alerts, "severity"))
    schema = p[p.index("ReadSchema: struct<"):].split(">")[0]
    assert "value" not in schema and "ts:" not in schema and "props" in schema


def test_raw_rows_only_meet_hash_aggregates(fx):
    """String MAX would force a sort-based aggregate; it must only see the
    per-(device, day, type, region) partials, never the raw scan."""
    p = plan(rollup.daily_event_stats(fx.raw))
    scan_side = p[p.rindex("Exchange hashpartitioning"):]
    assert "SortAggregate" not in scan_side and "HashAggregate" in scan_side


def test_top_k_is_take_ordered(fx):
    assert "TakeOrderedAndProject" in plan(dash.alerts_by(fx.alerts, "device_id", limit=10))


def test_fk_check_aggregates_before_join_and_broadcasts_literal_dimension(fx, spark):
    p = plan(quality.orphan_devices(fx.raw, seed_devices(spark), known_small=True))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p and "partial_count" in p


def test_day_read_prunes_partitions_and_pushes_time_range(spark, scratch):
    wh = Warehouse(spark, scratch)
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 3, 1, 1)), ("b", dt.datetime(2024, 3, 2, 1))],
        "event_id STRING, event_timestamp TIMESTAMP",
    )
    wh.append("raw_network_events", df)
    day = wh.read_day("raw_network_events", "2024-03-02")
    p = plan(day)
    # only that day's folder is listed, with the time range pushed to the scan
    assert len(day.inputFiles()) == 1 and "event_date=2024-03-02" in day.inputFiles()[0]
    assert "PushedFilters: [IsNotNull(event_timestamp), GreaterThanOrEqual(event_timestamp" in p
    assert [r["event_id"] for r in day.collect()] == ["b"]


def test_only_a_side_of_proven_size_is_hinted(spark):
    from telewatch.operators.joins import join_small

    small = spark.range(5).withColumnRenamed("id", "k")
    big = spark.range(100).withColumnRenamed("id", "k")
    assert "ResolvedHint" in join_small(big, small, "k", known_small=True)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in join_small(big, small, "k")._jdf.queryExecution().analyzed().toString()
    assert join_small(small, big, "k").count() == 5


@pytest.mark.parametrize("name", ["g4_active_devices_5m", "g5_device_failures_1h", "g7_avg_cpu_5m", "o2_high_latency_recent"])
def test_recency_bound_reaches_the_scan(spark, name):
    from telewatch.plans import catalog

    p = plan(catalog.queries()[name](spark, SF001))
    assert any("GreaterThan(ts" in part.split("]")[0] for part in p.split("PushedFilters: ")[1:])
