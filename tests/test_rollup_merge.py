"""Roll-up, upsert and report semantics (§1.4 items 9, 10, 12; K10–K15)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from telewatch.operators.merge import insert_if_absent, upsert_summary, with_defaults
from telewatch.operators.report import report_lines
from telewatch.operators.rollup import daily_summary
from telewatch.schemas import SUMMARY_COLUMNS, SUMMARY_SCHEMA

D1 = dt.date(2024, 3, 1)
T0 = dt.datetime(2024, 3, 1, 10, 0)


def _events(spark, rows):
    schema = (
        "event_id STRING, event_timestamp TIMESTAMP, device_id STRING, device_type STRING, region STRING, "
        "cpu_usage DOUBLE, memory_usage DOUBLE, bandwidth_mbps DOUBLE, packet_loss DOUBLE, "
        "latency_ms DOUBLE, status STRING"
    )
    return spark.createDataFrame(rows, schema)


def _alerts(spark, rows):
    return spark.createDataFrame(
        rows, "alert_id STRING, alert_timestamp TIMESTAMP, device_id STRING, severity STRING"
    )


def test_summary_counts_avg_skips_nulls_and_zero_alerts(spark):
    ev = _events(spark, [
        ("1", T0, "A", "router", "Giza", 10.0, None, 1.0, 1.0, 1.0, "UP"),
        ("2", T0, "A", "router", "Giza", None, None, 3.0, 1.0, 1.0, "UP"),
        ("3", T0, "B", "switch", "Cairo", 50.0, 1.0, 1.0, 1.0, 1.0, "UP"),
    ])
    al = _alerts(spark, [
        ("x", T0, "A", "HIGH"), ("y", T0, "A", "CRITICAL"), ("z", T0, "C", "HIGH"),  # C has no events
    ])
    rows = {r["device_id"]: r for r in daily_summary(ev, al, ds=D1).collect()}
    assert set(rows) == {"A", "B"}  # alerts-only device C gets no row
    a = rows["A"]
    assert a["total_events"] == 2 and a["avg_cpu_usage"] == 10.0 and a["avg_memory_usage"] is None
    assert (a["total_alerts"], a["critical_alerts"], a["high_alerts"], a["medium_alerts"]) == (2, 1, 1, 0)
    assert rows["B"]["total_alerts"] == 0


def _summary_row(spark, device, total_events, device_type="router", region="Giza", day=D1, stamp=T0):
    row = (day, device, device_type, region, total_events, 1.0, 1.0, 1.0, 1.0, 1.0, 0, 0, 0, 0, stamp)
    return spark.createDataFrame([row], SUMMARY_SCHEMA)


def test_upsert_keeps_type_region_and_untouched_rows(spark):
    target = _summary_row(spark, "A", 5, device_type="old", region="OldTown").unionByName(
        _summary_row(spark, "Z", 7)
    )
    updates = _summary_row(spark, "A", 9, device_type="new", region="NewTown").unionByName(
        _summary_row(spark, "N", 1)
    ).drop("computed_at")
    stamp = dt.datetime(2024, 3, 2, 0, 0)
    out = {r["device_id"]: r for r in upsert_summary(target, updates, F.lit(stamp)).collect()}
    assert set(out) == {"A", "Z", "N"}
    assert out["A"]["total_events"] == 9
    assert (out["A"]["device_type"], out["A"]["region"]) == ("old", "OldTown")
    assert out["A"]["computed_at"] == stamp
    assert out["Z"]["total_events"] == 7 and out["Z"]["computed_at"] == T0  # left alone
    assert out["N"]["device_type"] == "router"  # inserted


def test_upsert_twice_changes_only_computed_at(spark):
    base = _summary_row(spark, "A", 5)
    updates = base.drop("computed_at")
    once = upsert_summary(base, updates, F.lit(dt.datetime(2024, 3, 2)))
    twice = upsert_summary(once, updates, F.lit(dt.datetime(2024, 3, 3)))
    a, b = once.first().asDict(), twice.first().asDict()
    assert a.pop("computed_at") != b.pop("computed_at")
    assert a == b


def test_report_lines_with_empty_day(spark):
    summary = _summary_row(spark, "A", 5).unionByName(_summary_row(spark, "B", 3))
    summary = summary.withColumn("total_alerts", F.when(F.col("device_id") == "B", 4).otherwise(1))
    days = spark.createDataFrame([(D1,), (dt.date(2024, 3, 2),)], "summary_date DATE")
    lines = report_lines(summary, days).orderBy("summary_date", "line_no").collect()
    d1 = [r["line"] for r in lines if r["summary_date"] == D1]
    assert d1[0] == "# Daily Network Monitoring Report — 2024-03-01"
    assert d1[2] == "- **Total events:** 8" and d1[3] == "- **Total alerts:** 5"
    assert d1[7].startswith("| B | Giza | 3 | 4 |") and d1[8].startswith("| A |")
    d2 = [r["line"] for r in lines if r["summary_date"] == dt.date(2024, 3, 2)]
    assert d2 == ["# Daily Network Monitoring Report — 2024-03-02", "", "No data recorded for this date."]


def test_insert_if_absent_and_defaults(spark):
    from telewatch.sources.devices import seed_devices

    new = spark.createDataFrame(
        [("RTR-ASW-001", "router", "Aswan"), ("NEW-001", "router", "Giza"), ("NEW-001", "router", "Giza")],
        "device_id STRING, device_type STRING, region STRING",
    )
    added = insert_if_absent(new, seed_devices(spark), ["device_id"])
    added = with_defaults(added, {"current_status": F.lit("UP")})
    assert [(r["device_id"], r["current_status"]) for r in added.collect()] == [("NEW-001", "UP")]


def test_summary_columns_contract(spark):
    ev = _events(spark, [("1", T0, "A", "router", "Giza", 1.0, 1.0, 1.0, 1.0, 1.0, "UP")])
    out = daily_summary(ev, _alerts(spark, []), ds=D1)
    assert tuple(out.columns) == SUMMARY_COLUMNS


def test_kpi_bands_and_last_not_null(spark):
    from telewatch.functions.bands import band, last_not_null

    df = spark.createDataFrame([(1, 10.0), (2, 95.0), (3, None)], "t INT, v DOUBLE")
    assert df.agg(last_not_null(F.col("v"), F.col("t")).alias("x")).first()["x"] == 95.0
    colours = [r["c"] for r in spark.createDataFrame([(14,), (15,), (24,)], "n INT")
               .select(band(F.col("n"), "active_devices").alias("c")).collect()]
    assert colours == ["red", "orange", "green"]
    colours = [r["c"] for r in spark.createDataFrame([(0,), (1,), (5,)], "n INT")
               .select(band(F.col("n"), "device_failures").alias("c")).collect()]
    assert colours == ["green", "orange", "red"]


def test_alert_counts_from_rollup_equal_counts_from_alerts(spark):
    from telewatch.operators.dashboard import alert_count_partials
    from telewatch.operators.rollup import daily_alert_counts, daily_alert_counts_from_rollup

    T1 = dt.datetime(2024, 3, 2, 5, 0)
    al = spark.createDataFrame(
        [("a", T0, "A", "Giza", "HIGH"), ("b", T0, "A", "Giza", "CRITICAL"), ("c", T0, "B", "Cairo", "MEDIUM"),
         ("d", T1, "A", "Giza", "HIGH"), ("e", T1, "A", "Giza", "HIGH")],
        "alert_id STRING, alert_timestamp TIMESTAMP, device_id STRING, region STRING, severity STRING",
    )
    # two "micro-batches" of partials for the same rows split arbitrarily
    parts = alert_count_partials(al.filter("alert_id < 'c'")).unionByName(alert_count_partials(al.filter("alert_id >= 'c'")))
    want = sorted(tuple(r) for r in daily_alert_counts(al).collect())
    assert sorted(tuple(r) for r in daily_alert_counts_from_rollup(parts).collect()) == want
    one_day = sorted(tuple(r) for r in daily_alert_counts_from_rollup(parts, ds=D1).collect())
    assert one_day == sorted(tuple(r) for r in daily_alert_counts(al, ds=D1).collect())
