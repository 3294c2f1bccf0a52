"""Property tests: the Spark rule engine against a brute-force restatement."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telewatch.functions.enrich import enrich
from telewatch.operators.alerts import detect_alerts

HARD = {"cpu_usage": 90.0, "memory_usage": 90.0, "packet_loss": 5.0, "latency_ms": 200.0}
SOFT = {"cpu_usage": 80.0, "memory_usage": 80.0, "packet_loss": 3.0, "latency_ms": 150.0}
NAMES = {"cpu_usage": "CPU_HIGH", "memory_usage": "MEMORY_HIGH", "packet_loss": "PACKET_LOSS_HIGH",
         "latency_ms": "LATENCY_HIGH"}


def metric(points):
    near = st.sampled_from([p + d for p in points for d in (-0.01, 0.0, 0.01)])
    return st.one_of(st.none(), near, st.floats(0, 1000, allow_nan=False).map(lambda x: round(x, 2)))


row = st.fixed_dictionaries(
    {
        "cpu_usage": metric([80.0, 90.0]),
        "memory_usage": metric([80.0, 90.0]),
        "packet_loss": metric([3.0, 5.0, 100.0]),
        "latency_ms": metric([150.0, 200.0]),
        "bandwidth_mbps": metric([850.0, 950.0, 1000.0]),
        "status": st.sampled_from(["UP", "DOWN", None]),
    }
)


def expected(r):
    fired = {NAMES[c] for c, t in HARD.items() if r[c] is not None and r[c] > t}
    pct = None if r["bandwidth_mbps"] is None else r["bandwidth_mbps"] / 1000.0 * 100
    if pct is not None and pct > 95.0:
        fired.add("BANDWIDTH_SATURATION")
    if r["status"] == "DOWN":
        fired.add("DEVICE_DOWN")
    if r["status"] == "DOWN":
        health = "CRITICAL"
    elif any(r[c] is not None and r[c] > t for c, t in SOFT.items()) or (pct is not None and pct > 85.0):
        health = "WARNING"
    else:
        health = "HEALTHY"
    return fired, health


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_rules_match_brute_force(spark, rows):
    data = [
        (str(i), dt.datetime(2024, 1, 1), "D", "router", "Giza", r["cpu_usage"], r["memory_usage"],
         r["bandwidth_mbps"], r["packet_loss"], r["latency_ms"], 40.0, r["status"])
        for i, r in enumerate(rows)
    ]
    schema = (
        "event_id STRING, event_timestamp TIMESTAMP, device_id STRING, device_type STRING, region STRING, "
        "cpu_usage DOUBLE, memory_usage DOUBLE, bandwidth_mbps DOUBLE, packet_loss DOUBLE, latency_ms DOUBLE, "
        "temperature DOUBLE, status STRING"
    )
    enriched = enrich(spark.createDataFrame(data, schema))
    got_alerts: dict[str, set] = {}
    for a in detect_alerts(enriched).collect():
        got_alerts.setdefault(a["event_id"], set()).add(a["alert_type"])
    got_health = {r["event_id"]: r["health_status"] for r in enriched.collect()}
    for i, r in enumerate(rows):
        fired, health = expected(r)
        assert got_alerts.get(str(i), set()) == fired, r
        assert got_health[str(i)] == health, r
