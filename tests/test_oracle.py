"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate: same column names, row count and value hash)."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from conftest import SF01

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

from telewatch.plans import catalog, oracle  # noqa: E402

# Queries of the optional subpackages have tests of their own.
NAMES = sorted(catalog.queries())


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


ORDERED = {
    "o1_last_day_report_rows": lambda r: (-r["total_alerts"], r["device_id"]),
    "o2_high_latency_recent": lambda r: (-r["event_timestamp"].timestamp(), r["event_id"]),
    "g11_alerts_by_severity": lambda r: (-r["count"], r["severity"]),
    "g12_alerts_by_region": lambda r: (-r["count"], r["region"]),
    "g13_top_devices_by_alerts": lambda r: (-r["count"], r["device_id"]),
    "g9_cpu_memory_trend": lambda r: r["time"],
    "g10_packet_loss_trend": lambda r: r["time"],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    """The comparison with the oracle does not see the order of rows."""
    rows = catalog.queries()[name](spark, SF01).collect()
    assert len(rows) > 1 and rows == sorted(rows, key=ORDERED[name])


def test_a_changed_rule_shows(spark, monkeypatch):
    changed = list(oracle.RULES)
    changed[0] = ("CPU_HIGH", "HIGH", "cpu_usage > 91e0", *changed[0][3:])
    monkeypatch.setattr(oracle, "ALERTS", oracle._alerts_cte(changed))
    sql = oracle.oracle_sql()["g11_alerts_by_severity"]
    want = duck_connection(SF01).execute(sql).fetchall()
    got = [tuple(r) for r in catalog.queries()["g11_alerts_by_severity"](spark, SF01).collect()]
    assert got != want


def test_fault_queries_find_faults(spark):
    q = catalog.queries()
    assert q["q2_faulty_keys"](spark, SF01).first()["duplicate_keys"] > 0
    nulls = {r["column_name"]: r["null_rows"] for r in q["q3_faulty_nulls"](spark, SF01).collect()}
    assert nulls["region"] > 0 and nulls["event_id"] == 0
    wide = {r["column_name"]: r["too_long_rows"] for r in q["q4_faulty_widths"](spark, SF01).collect()}
    assert wide["device_id"] > 0
    assert q["j2_faulty_devices"](spark, SF01).first()["orphan_devices"] > 1
    row = q["j3_faulty_reconcile"](spark, SF01).first()
    assert row["processed_only"] > 0 and row["raw_only"] > 0


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF01, NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(results, name):
    rec = results[name]
    assert "error" not in rec, rec
    assert rec["rows_match"] and rec["schema_match"] and rec["hash_match"], rec
    assert rec["types_match"], rec


def test_entry_smoke(spark):
    rows = {r["severity"]: r["count"] for r in entry.entry(spark).collect()}
    assert set(rows) <= {"CRITICAL", "HIGH", "MEDIUM"} and sum(rows.values()) > 0


def test_expected_fixture_counts(results, spark):
    """Values stated in FIXTURES.md §3 for sf0.01."""
    q = entry.queries()
    sev = {r["severity"]: r["count"] for r in q["g11_alerts_by_severity"](spark, SF01).collect()}
    assert sev == {"CRITICAL": 90, "HIGH": 3708, "MEDIUM": 2472}
    health = {r["health_status"]: r["events"] for r in q["p6_health_status_counts"](spark, SF01).collect()}
    assert health == {"CRITICAL": 90, "WARNING": 8343, "HEALTHY": 1567}
    top = q["g13_top_devices_by_alerts"](spark, SF01).collect()
    assert [(r["device_id"], r["count"]) for r in top[:3]] == [
        ("SWT-MNS-008", 293), ("RTR-MNS-003", 282), ("RTR-ASW-002", 276)
    ]
    assert top[5]["count"] == top[6]["count"] == 257
    per_event = {r["n_alerts"]: (r["events"], r["anomalous_events"])
                 for r in q["a4_alerts_per_event"](spark, SF01).collect()}
    assert sum(e for n, (e, _) in per_event.items() if n > 0) == 4923
    assert all(a == (e if n > 0 else 0) for n, (e, a) in per_event.items())  # F10 ⇔ ≥1 alert
    assert results["j1_daily_summary"]["spark_rows"] == 780
    assert results["g9_cpu_memory_trend"]["spark_rows"] == 8961
