"""Hand-written edge rows (FIXTURES.md §4) through parse → enrich → alerts."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import kafka_rows, payload

from pyspark.sql import functions as F

from telewatch.functions.enrich import enrich
from telewatch.functions.parse import parse_kafka, split_rejects
from telewatch.functions.rules import DEFAULT_RULES, Rule
from telewatch.operators.alerts import detect_alerts


def _parse(spark, values):
    return parse_kafka(kafka_rows(spark, values), provenance=True)


def _alerts(spark, values, rules=DEFAULT_RULES):
    accepted, _ = split_rejects(_parse(spark, values))
    return sorted(r["alert_type"] for r in detect_alerts(enrich(accepted), rules).collect())


def _health(spark, value):
    return enrich(_parse(spark, [value])).first()["health_status"]


@pytest.mark.parametrize(
    "field,hard",
    [("cpu_usage", 90.0), ("memory_usage", 90.0), ("packet_loss", 5.0), ("latency_ms", 200.0)],
)
def test_hard_thresholds_are_strict(spark, field, hard):
    assert _alerts(spark, [payload(**{field: hard})]) == []
    fired = _alerts(spark, [payload(**{field: hard + 0.01})])
    assert len(fired) == 1


def test_bandwidth_rule_uses_percent_of_capacity(spark):
    assert _alerts(spark, [payload(bandwidth_mbps=950.0)]) == []
    assert _alerts(spark, [payload(bandwidth_mbps=950.1)]) == ["BANDWIDTH_SATURATION"]


@pytest.mark.parametrize(
    "field,soft",
    [("cpu_usage", 80.0), ("memory_usage", 80.0), ("packet_loss", 3.0), ("latency_ms", 150.0),
     ("bandwidth_mbps", 850.0)],
)
def test_soft_thresholds_are_strict(spark, field, soft):
    assert _health(spark, payload(**{field: soft})) == "HEALTHY"
    assert _health(spark, payload(**{field: soft + 0.01})) == "WARNING"


def test_down_precedence_and_two_alerts(spark):
    p = payload(status="DOWN", cpu_usage=0.0, memory_usage=0.0, bandwidth_mbps=0.0,
                packet_loss=100.0, latency_ms=0.0)
    assert _health(spark, p) == "CRITICAL"
    assert _alerts(spark, [p]) == ["DEVICE_DOWN", "PACKET_LOSS_HIGH"]


def test_several_rules_at_once(spark):
    p = payload(cpu_usage=95.0, memory_usage=99.0, latency_ms=300.0)
    assert _alerts(spark, [p]) == ["CPU_HIGH", "LATENCY_HIGH", "MEMORY_HIGH"]


def test_null_metrics_fire_nothing_and_stay_healthy(spark):
    p = payload(cpu_usage=None, memory_usage=None, bandwidth_mbps=None, packet_loss=None,
                latency_ms=None, temperature=None)
    assert _alerts(spark, [p]) == []
    assert _health(spark, p) == "HEALTHY"
    # one NULL metric does not hide another breach
    assert _alerts(spark, [payload(cpu_usage=None, memory_usage=95.0)]) == ["MEMORY_HIGH"]


def test_description_templates(spark):
    rows = detect_alerts(enrich(_parse(spark, [payload(cpu_usage=90.5, status="DOWN")]))).collect()
    by_type = {r["alert_type"]: r["description"] for r in rows}
    assert by_type["CPU_HIGH"] == "CPU usage on RTR-ASW-001 reached 90.50%, exceeding the 90% threshold."
    assert by_type["DEVICE_DOWN"] == "Device RTR-ASW-001 is reporting DOWN status."


def test_malformed_and_null_payloads_are_rejected(spark, missing):
    values = [
        payload(),
        '{"event_id": "e-2", "timestamp": ',  # malformed
        None,  # null payload
        payload(event_id=missing),  # missing required field
        payload(timestamp="not a time"),  # unparseable timestamp
    ]
    accepted, rejected = split_rejects(_parse(spark, values))
    assert accepted.count() == 1
    rej = rejected.orderBy("kafka_offset").collect()
    assert [r["kafka_offset"] for r in rej] == [1, 2, 3, 4]
    assert rej[0]["json_value"].startswith('{"event_id"')
    # all-NULL rows from bad payloads are HEALTHY under strict parity
    assert _health(spark, '{"bad json') == "HEALTHY"


def test_extra_field_ignored_and_wrong_type_is_null(spark):
    extra = payload().replace("{", '{"firmware": "1.2", ', 1)
    wrong = payload(cpu_usage="high")
    rows = _parse(spark, [extra, wrong]).orderBy("kafka_offset").collect()
    assert "firmware" not in rows[0].asDict()
    assert rows[0]["event_id"] == "e-1"
    assert rows[1]["cpu_usage"] is None


def test_unknown_device_passes_parse_and_is_flagged_by_fk(spark):
    from telewatch.operators.quality import orphan_devices
    from telewatch.sources.devices import seed_devices

    parsed = _parse(spark, [payload(device_id="XXX-NOPE-001"), payload(event_id="e-2")])
    orphans = orphan_devices(parsed, seed_devices(spark), known_small=True).collect()
    assert [(r["device_id"], r["rows"]) for r in orphans] == [("XXX-NOPE-001", 1)]


def test_duplicate_event_id_unique_append(spark):
    from telewatch.operators.merge import unique_append

    parsed = _parse(spark, [payload(), payload(), payload(event_id="e-2")])
    assert unique_append(parsed, None, ["event_id"]).count() == 2
    target = parsed.filter(F.col("event_id") == "e-2")
    assert [r["event_id"] for r in unique_append(parsed, target, ["event_id"]).collect()] == ["e-1"]


def test_midnight_boundaries_go_to_their_own_day(spark):
    from telewatch.operators.rollup import daily_event_stats

    values = [
        payload(event_id="a", timestamp="2024-03-01T23:59:59.999Z"),
        payload(event_id="b", timestamp="2024-03-02T00:00:00.000Z"),
    ]
    stats = daily_event_stats(_parse(spark, values)).orderBy("summary_date").collect()
    assert [(r["summary_date"], r["total_events"]) for r in stats] == [
        (dt.date(2024, 3, 1), 1),
        (dt.date(2024, 3, 2), 1),
    ]


def test_rule_extension_is_data_only(spark):
    hot = Rule("TEMPERATURE_HIGH", "MEDIUM", "temperature", "Temperature on %s reached %.2f C.", above=85.0)
    fired = _alerts(spark, [payload(temperature=90.0)], rules=(*DEFAULT_RULES, hot))
    assert fired == ["TEMPERATURE_HIGH"]


def test_rule_needs_exactly_one_test():
    with pytest.raises(ValueError):
        Rule("X", "LOW", "cpu_usage", "%s", above=1.0, equals="UP")
