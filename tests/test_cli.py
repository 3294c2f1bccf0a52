"""The command line runs every job end to end on the file stand-in."""

from __future__ import annotations

import json

from conftest import SF001

from telewatch.__main__ import main
from telewatch.sources.fixtures import kafka_frame_from_events, read_events
from telewatch.sources.tables import Warehouse


def test_cli_jobs(spark, scratch, tmp_path, capsys):
    frame = f"{scratch}/frame"
    kafka_frame_from_events(read_events(spark, SF001)).write.parquet(frame)
    root = f"{scratch}/wh"
    assert main(["ingest", "--root", root, "--files", frame, "--trigger", "available-now"]) == 0
    assert main(["alerts", "--root", root, "--files", frame, "--trigger", "available-now"]) == 0
    wh = Warehouse(spark, root)
    assert wh.read("raw_network_events").count() + wh.read("rejects").count() == 1000

    assert main(["backfill", "--root", root, "--start", "2024-01-01", "--end", "2024-01-30"]) == 0
    summary = wh.read("daily_monitoring_summary")
    assert summary.groupBy().sum("total_events").first()[0] == wh.read("raw_network_events").count()
    summary_rows = summary.count()

    capsys.readouterr()
    assert main(["daily", "--root", root, "--ds", "2024-01-15", "--report-dir", str(tmp_path)]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["device_rows"] > 0 and (tmp_path / "daily_report_2024-01-15.md").is_file()

    assert main(["health", "--root", root]) == 0
    capsys.readouterr()
    assert main(["dashboard", "--root", root, "--as-of", "2024-01-30T23:59:00"]) == 0
    board = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert board["total_events"][0]["value"] == wh.read("raw_network_events").count()
    assert len(board) == 13 and "latency_band" in str(board["high_latency_1h"] or "latency_band")
    assert spark.read.parquet(f"{root}/stream_status").count() > 0
    assert main(["rollup", "--root", root]) == 0
    assert main(["compact", "--root", root, "--table", "raw_network_events", "--start", "2024-01-01",
                 "--end", "2024-01-30", "--rows-per-file", "100"]) == 0
    assert summary_rows == wh.read("daily_monitoring_summary").count()
    assert wh.read("raw_network_events").count() + wh.read("rejects").count() == 1000


def test_backfill_reports_every_day(spark, scratch, tmp_path):
    from telewatch.plans.daily import run_range

    frame = f"{scratch}/frame"
    kafka_frame_from_events(read_events(spark, SF001)).write.parquet(frame)
    root = f"{scratch}/wh"
    assert main(["ingest", "--root", root, "--files", frame, "--trigger", "available-now"]) == 0
    assert main(["alerts", "--root", root, "--files", frame, "--trigger", "available-now"]) == 0
    run_range(spark, root, "2024-01-29", "2024-02-01", report_dir=str(tmp_path / "reports"))
    files = sorted(p.name for p in (tmp_path / "reports").iterdir() if not p.name.startswith("."))
    assert files == [f"daily_report_{d}.md" for d in ("2024-01-29", "2024-01-30", "2024-01-31", "2024-02-01")]
    text = (tmp_path / "reports" / "daily_report_2024-02-01.md").read_text()
    assert text.startswith("# Daily Network Monitoring Report — 2024-02-01")
    assert "No data recorded for this date." in text
    full = (tmp_path / "reports" / "daily_report_2024-01-30.md").read_text().splitlines()
    assert full[5].startswith("| Device |") and len(full) > 7


def test_alert_rules_from_a_file(spark, scratch, tmp_path):
    rules = [
        {"alert_type": "CPU_HIGH", "severity": "HIGH", "column": "cpu_usage", "template": "%s at %.2f", "above": 90.0},
        {"alert_type": "CPU_HIGH", "severity": "CRITICAL", "column": "cpu_usage", "template": "%s at %.2f", "above": 95.0, "rule_id": "CPU_95"},
    ]
    (tmp_path / "rules.json").write_text(json.dumps(rules, indent=1))
    frame, root = f"{scratch}/frame", f"{scratch}/wh"
    kafka_frame_from_events(read_events(spark, SF001)).write.parquet(frame)
    assert main(["alerts", "--root", root, "--files", frame, "--trigger", "available-now", "--rules", str(tmp_path / "rules.json")]) == 0
    alerts = Warehouse(spark, root).read("alerts")
    by = {r["severity"]: r["count"] for r in alerts.groupBy("severity").count().collect()}
    assert by["HIGH"] > by["CRITICAL"] > 0
    assert alerts.select("alert_id").distinct().count() == alerts.count()


def test_devices_gate_and_reports(spark, scratch, tmp_path, capsys):
    from pyspark.sql import functions as F

    def said():
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    frame, root = f"{scratch}/frame", f"{scratch}/wh"
    text = F.col("value").cast("string")
    ghost = F.when(F.col("offset") % 10 == 0, F.regexp_replace(text, '"device_id":"[^"]*"', '"device_id":"GHOST"')).otherwise(text)
    kafka_frame_from_events(read_events(spark, SF001)).withColumn("value", ghost.cast("binary")).write.parquet(frame)
    for job in ("ingest", "alerts"):
        assert main([job, "--root", root, "--files", frame, "--trigger", "available-now", "--known-devices-only"]) == 0
    wh = Warehouse(spark, root)
    held = wh.read("held_events").count()
    assert held > 0 and wh.read("raw_network_events").count() + held + wh.read("rejects").count() == 1000
    (tmp_path / "new.csv").write_text("device_id,device_type,region\nGHOST,router,Giza\n")
    assert main(["register-devices", "--root", root, "--csv", str(tmp_path / "new.csv")]) == 0 and said() == {"devices": 27}
    assert main(["readmit", "--root", root]) == 0 and said() == {"released": held, "held": 0}
    assert wh.read("raw_network_events").where("device_id = 'GHOST'").count() == held
    assert main(["reconcile", "--root", root]) == 0 and said() == []
    assert main(["history", "--root", root]) == 0
    rows = said()
    assert {r["query_name"] for r in rows} >= {"raw_ingestion", "alert_detection"}
    assert {r["kind"] for r in rows} == {"started", "stopped"}
