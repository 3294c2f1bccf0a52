"""Batch jobs over a warehouse written by the streaming jobs."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF001

from pyspark.sql import functions as F

from telewatch.plans import daily, health
from telewatch.sources.fixtures import kafka_frame_from_events, read_events
from telewatch.sources.tables import Warehouse
from telewatch.streaming.jobs import run_available, start_alerting, start_ingestion, stream_checkpoint
from telewatch.streaming.sources import kafka_files_stream


@pytest.fixture(scope="module")
def loaded(spark):
    """sf0.001 events streamed through both jobs into a fresh warehouse."""
    from telewatch.session import scratch_path

    frame = scratch_path(spark, "frame")
    kafka_frame_from_events(read_events(spark, SF001)).repartitionByRange(3, "offset").write.parquet(frame)
    wh = Warehouse(spark, scratch_path(spark, "wh"))
    for start, name in ((start_ingestion, "ing"), (start_alerting, "alr")):
        q = start(kafka_files_stream(spark, frame, 1), wh, stream_checkpoint(wh.root, name),
                  trigger={"availableNow": True}, name=f"{name}_{id(wh)}")
        run_available(q)
    return wh


def test_streams_wrote_every_table(loaded):
    for t in ("bronze", "raw_network_events", "processed_network_events", "silver_alerts", "alerts", "rejects"):
        assert loaded.exists(t), t
    raw = loaded.read("raw_network_events").count()
    rej = loaded.read("rejects").count()
    assert raw + rej == loaded.read("bronze").count() == 1000
    assert loaded.read("alerts").count() == loaded.read("silver_alerts").count() > 0


def test_daily_job_upsert_is_idempotent_and_scoped(spark, loaded, tmp_path):
    day = loaded.read("raw_network_events").agg(F.max(F.to_date("event_timestamp"))).first()[0]
    other = day - dt.timedelta(days=1)
    daily.run_daily(spark, loaded.root, other)
    first = daily.run_daily(spark, loaded.root, day, report_dir=str(tmp_path))
    assert first["device_rows"] > 0
    before = {r["device_id"]: r.asDict() for r in loaded.read_day("daily_monitoring_summary", day).collect()}
    other_before = loaded.read_day("daily_monitoring_summary", other).drop("computed_at").collect()
    daily.run_daily(spark, loaded.root, day)
    after = {r["device_id"]: r.asDict() for r in loaded.read_day("daily_monitoring_summary", day).collect()}
    assert set(before) == set(after)
    for k in before:
        before[k].pop("computed_at"), after[k].pop("computed_at")
    assert before == after
    assert sorted(map(tuple, other_before)) == sorted(
        map(tuple, loaded.read_day("daily_monitoring_summary", other).drop("computed_at").collect())
    )
    text = (tmp_path / f"daily_report_{day}.md").read_text()
    assert text.startswith(f"# Daily Network Monitoring Report — {day}\n\n- **Total events:** ")
    assert "| Device | Region | Events | Alerts | Critical | High | Medium |" in text


def test_report_for_day_without_data(spark, loaded):
    lines = daily.report_for_day(loaded, dt.date(1999, 1, 1)).orderBy("line_no").collect()
    assert lines[-1]["line"] == "No data recorded for this date."


def test_health_check(spark, loaded):
    # ingested_at is the stream's wall-clock time, so "now" is fresh...
    assert health.check_recent_events(spark, loaded.root) > 0
    # ...and a day later nothing has arrived.
    with pytest.raises(RuntimeError):
        health.check_recent_events(spark, loaded.root, as_of=dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(days=2))


def test_compaction_keeps_rows(spark, loaded):
    day = loaded.read("raw_network_events").agg(F.min(F.to_date("event_timestamp"))).first()[0]
    before = sorted(r["event_id"] for r in loaded.read_day("raw_network_events", day).collect())
    loaded.compact("raw_network_events", day, rows_per_file=10)
    after = sorted(r["event_id"] for r in loaded.read_day("raw_network_events", day).collect())
    assert before == after


def test_compaction_refuses_open_days(loaded):
    today = dt.datetime.now(dt.UTC).date()
    with pytest.raises(ValueError):
        loaded.compact("raw_network_events", today - dt.timedelta(days=1), today)


def test_freshness_status_and_accepted_rows(spark, loaded):
    from telewatch.operators.quality import accepted_rows
    from telewatch.sources.devices import seed_devices

    row = health.freshness_status(spark, loaded.root).first()
    assert row["status"] == "OK" and row["recent_rows"] > 0
    raw = loaded.read("raw_network_events")
    assert accepted_rows(raw, seed_devices(spark), known_small=True).count() == raw.count()


def test_dashboard_panels_prune_to_window_days(spark, loaded):
    from telewatch.plans.dashboard import panels
    from telewatch.operators import dashboard as dash

    raw = loaded.read("raw_network_events")
    as_of = raw.agg(F.max("event_timestamp")).first()[0]
    p = panels(spark, loaded.root, as_of=as_of)
    # same answers as the operators over the whole table
    full = dash.active_devices(raw, F.lit(as_of)).first()["value"]
    assert p["active_devices_5m"].first()["value"] == full
    assert p["device_failures_1h"].first()["value"] == dash.device_failures(raw, F.lit(as_of)).first()["value"]
    sev = {r["severity"]: r["count"] for r in p["alerts_by_severity"].collect()}
    assert sum(sev.values()) == loaded.read("alerts").count()
    assert p["top_devices"].count() <= 10 and p["total_events"].first()["value"] == raw.count()
    from telewatch.plans.dashboard import kpi_row

    kpis = kpi_row(spark, p).first()
    assert kpis["total_events"] == raw.count() and kpis["total_events_band"] == "blue"
    assert kpis["active_devices"] == full
    assert kpis["active_devices_band"] == ("green" if full >= 24 else "orange" if full >= 15 else "red")
    # the recency panels list only the window's days
    days = {f.split("event_date=")[1][:10] for f in p["active_devices_5m"].inputFiles()}
    assert days == {str(d) for d in ((as_of - dt.timedelta(minutes=5)).date(), as_of.date())}


def test_alert_rollup_matches_alerts(spark, loaded):
    from telewatch.operators import dashboard as dash

    loaded.roll_up("alert_counts")
    counts, alerts = loaded.counts("alert_counts"), loaded.read("alerts")
    for key in ("severity", "region", "device_id"):
        a = {r[key]: r["count"] for r in dash.alerts_by(alerts, key).collect()}
        b = {r[key]: r["count"] for r in dash.alerts_by_rollup(counts, key).collect()}
        assert a == b, key
    share = [tuple(r) for r in dash.severity_share(alerts).collect()]
    assert share == [tuple(r) for r in dash.severity_share_rollup(counts).collect()]
    assert counts.count() < alerts.count()


def test_recency_panels_have_no_upper_bound(spark, scratch):
    """A reading 90 s ahead of the clock, on the next day, counts."""
    from telewatch.plans.dashboard import panels

    wh = Warehouse(spark, scratch)
    as_of = dt.datetime(2024, 3, 1, 23, 59)
    rows = [("a", as_of - dt.timedelta(seconds=30), "D1"), ("b", as_of + dt.timedelta(seconds=90), "D2")]
    wh.append_unique("raw_network_events", spark.createDataFrame(rows, "event_id STRING, event_timestamp TIMESTAMP, device_id STRING"))
    assert panels(spark, scratch, as_of)["active_devices_5m"].first()["value"] == 2


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_windows_do_not_depend_on_the_drivers_zone(spark, scratch, monkeypatch, zone):
    import time

    from telewatch.plans.dashboard import panels

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        wh = Warehouse(spark, scratch)
        at = dt.datetime(2024, 3, 1, 12, tzinfo=dt.UTC)
        rows = [("a", at - dt.timedelta(minutes=4), "D1", 10.0), ("b", at - dt.timedelta(minutes=6), "D2", 90.0)]
        events = spark.createDataFrame(rows, "event_id STRING, event_timestamp TIMESTAMP, device_id STRING, cpu_usage DOUBLE")
        wh.append_unique("raw_network_events", events.withColumn("ingested_at", F.col("event_timestamp")))
        for as_of in (at, at.replace(tzinfo=None)):
            p = panels(spark, scratch, as_of)
            assert p["active_devices_5m"].first()["value"] == 1 and p["avg_cpu_5m"].first()["value"] == 10.0
            assert p["cpu_memory_trend"].count() == 2
            assert health.freshness_status(spark, scratch, as_of).first()["recent_rows"] == 2
        late = health.freshness_status(spark, scratch, at + dt.timedelta(hours=2)).first()
        assert (late["recent_rows"], late["status"]) == (0, "STALE")
    finally:
        monkeypatch.undo()
        time.tzset()


def test_dashboard_trend_over_a_range(spark, loaded):
    from telewatch.plans.dashboard import panels
    from telewatch.operators import dashboard as dash

    raw = loaded.read("raw_network_events")
    lo, hi = raw.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    p = panels(spark, loaded.root, as_of=hi, start=lo, end=hi)
    got = [tuple(r) for r in p["packet_loss_trend"].collect()]
    want = [tuple(r) for r in dash.metric_trend(raw, ("packet_loss",)).collect()]
    assert got == want and len(got) > 100
    # a one-hour range keeps only that hour's minutes
    hour = panels(spark, loaded.root, as_of=hi)["cpu_memory_trend"].collect()
    assert all(hi - dt.timedelta(hours=1) - dt.timedelta(minutes=1) <= r["time"] <= hi for r in hour)


def test_daily_summary_from_rollup_equals_from_alerts(spark, loaded):
    from telewatch.operators.rollup import daily_summary

    day = loaded.read("raw_network_events").agg(F.max(F.to_date("event_timestamp"))).first()[0]
    stamp = F.lit(dt.datetime(2024, 1, 31))
    loaded.roll_up("alert_counts", day, day)
    via_rollup = daily.compute_summary(loaded, day, computed_at=stamp)
    direct = daily_summary(loaded.read_day("raw_network_events", day), loaded.read_day("alerts", day),
                           ds=day, computed_at=stamp)
    cols = [c for c in direct.columns if c != "computed_at"]
    rows = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert rows(via_rollup) == rows(direct) and len(rows(direct)) > 0
