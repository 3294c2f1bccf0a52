"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code (nothing of the package is imported): the alert engine is a UNION ALL of
one SELECT per rule (not an array + explode), the device lookup is a join to
a VALUES table (not an array index), the roll-up uses correlated-free
conditional aggregates.  Double literals are written ``100e0`` (``100.0`` is
DECIMAL in SQL).  Averages are rounded to 6 places, as in the Spark queries.
"""

from __future__ import annotations

# The expected values are written out here, not taken from the package: a wrong
# threshold, text, device or width there shows as a difference.
RULES = [
    ("CPU_HIGH", "HIGH", "cpu_usage > 90e0", "CPU usage on %s reached %.2f%%, exceeding the 90%% threshold.", "cpu_usage"),
    ("MEMORY_HIGH", "HIGH", "memory_usage > 90e0", "Memory usage on %s reached %.2f%%, exceeding the 90%% threshold.", "memory_usage"),
    ("PACKET_LOSS_HIGH", "HIGH", "packet_loss > 5e0", "Packet loss on %s reached %.2f%%, exceeding the 5%% threshold.", "packet_loss"),
    ("LATENCY_HIGH", "MEDIUM", "latency_ms > 200e0", "Latency on %s reached %.2f ms, exceeding the 200 ms threshold.", "latency_ms"),
    ("BANDWIDTH_SATURATION", "MEDIUM", "bandwidth_utilization_pct > 95e0",
     "Bandwidth utilization on %s reached %.2f%%, exceeding the 95%% threshold.", "bandwidth_utilization_pct"),
    ("DEVICE_DOWN", "CRITICAL", "status = 'DOWN'", "Device %s is reporting DOWN status.", None),
]

DEVICES = [
    ("RTR-ASW-001", "router", "Aswan"),
    ("RTR-ASW-002", "router", "Aswan"),
    ("RTR-MNS-003", "router", "Mansoura"),
    ("RTR-SHR-004", "router", "Sharqia"),
    ("RTR-ALX-005", "router", "Alexandria"),
    ("RTR-ALX-006", "router", "Alexandria"),
    ("RTR-SHR-007", "router", "Sharqia"),
    ("RTR-GIZ-008", "router", "Giza"),
    ("SWT-GIZ-001", "switch", "Giza"),
    ("SWT-ALX-002", "switch", "Alexandria"),
    ("SWT-GIZ-003", "switch", "Giza"),
    ("SWT-ASW-004", "switch", "Aswan"),
    ("SWT-CAI-005", "switch", "Cairo"),
    ("SWT-ASW-006", "switch", "Aswan"),
    ("SWT-ALX-007", "switch", "Alexandria"),
    ("SWT-MNS-008", "switch", "Mansoura"),
    ("FWL-CAI-001", "firewall", "Cairo"),
    ("FWL-SHR-002", "firewall", "Sharqia"),
    ("FWL-CAI-003", "firewall", "Cairo"),
    ("FWL-ALX-004", "firewall", "Alexandria"),
    ("BST-ALX-001", "base_station", "Alexandria"),
    ("BST-ASW-002", "base_station", "Aswan"),
    ("BST-MNS-003", "base_station", "Mansoura"),
    ("BST-ALX-004", "base_station", "Alexandria"),
    ("BST-CAI-005", "base_station", "Cairo"),
    ("BST-GIZ-006", "base_station", "Giza"),
]

REQUIRED = {
    "raw_network_events": "event_id event_timestamp device_id device_type region ingested_at",
    "processed_network_events": "event_id event_timestamp device_id device_type region health_status processed_at",
    "alerts": "alert_id alert_timestamp device_id device_type region alert_type severity description created_at",
    "daily_monitoring_summary": "summary_date device_id device_type region total_events total_alerts critical_alerts "
    "high_alerts medium_alerts computed_at",
}

WIDTHS = {
    "raw_network_events": {"event_id": 36, "device_id": 20, "device_type": 20, "region": 30, "status": 10},
    "processed_network_events": {"event_id": 36, "device_id": 20, "device_type": 20, "region": 30, "health_status": 10},
    "alerts": {"alert_id": 36, "device_id": 20, "device_type": 20, "region": 30, "alert_type": 30, "severity": 10},
    "daily_monitoring_summary": {"device_id": 20, "device_type": 20, "region": 30},
}

_DEVICE_ROWS = ",\n        ".join(
    f"({i}, '{d}', '{t}', '{r}')" for i, (d, t, r) in enumerate(DEVICES)
)

BASE = f"""
WITH dev(idx, device_id, device_type, region) AS (
    VALUES
        {_DEVICE_ROWS}
),
ev AS (
    SELECT e.*, CAST(json_extract(e.props, '$.k') AS BIGINT) AS k
    FROM events e
),
ev2 AS (
    SELECT *, (event_type = 'error' AND k < 5) AS down FROM ev
),
tel AS (
    SELECT
        CAST(x.event_id AS VARCHAR) AS event_id,
        x.ts AS event_timestamp,
        d.device_id, d.device_type, d.region,
        CASE WHEN x.down THEN 0e0 WHEN x.k = 98 THEN NULL
             ELSE CAST((x.event_id * 37 + x.k * 101) % 10001 AS DOUBLE) / 100e0 END AS cpu_usage,
        CASE WHEN x.down THEN 0e0
             ELSE CAST((x.event_id * 41 + x.user_id * 7) % 10001 AS DOUBLE) / 100e0 END AS memory_usage,
        CASE WHEN x.down THEN 0e0
             ELSE CAST((x.event_id * 53 + x.user_id * 31) % 10001 AS DOUBLE) / 10e0 END AS bandwidth_mbps,
        CASE WHEN x.down THEN 100e0
             ELSE CAST((x.event_id * 13 + x.k * 7) % 601 AS DOUBLE) / 100e0 END AS packet_loss,
        CASE WHEN x.down THEN 0e0
             ELSE CAST((x.event_id * 29 + x.user_id * 17) % 2501 AS DOUBLE) / 10e0 END AS latency_ms,
        20e0 + CAST((x.event_id * 11) % 8001 AS DOUBLE) / 100e0 AS temperature,
        CASE WHEN x.down THEN 'DOWN' ELSE 'UP' END AS status,
        x.ts AS ingested_at,
        x.k AS fixture_k
    FROM ev2 x LEFT JOIN dev d ON d.idx = x.user_id % 26
),
enr AS (
    SELECT *,
        bandwidth_mbps / 1000e0 * 100 AS bandwidth_utilization_pct,
        CASE WHEN status = 'DOWN' THEN 'CRITICAL'
             WHEN cpu_usage > 80e0 OR memory_usage > 80e0 OR packet_loss > 3e0
               OR latency_ms > 150e0 OR bandwidth_mbps / 1000e0 * 100 > 85e0 THEN 'WARNING'
             ELSE 'HEALTHY' END AS health_status
    FROM tel
),
as_of_t AS (SELECT max(event_timestamp) AS t FROM tel),
"""


def _rule_select(rule, rule_id: str = "") -> str:
    alert_type, severity, condition, template, value = rule
    arguments = f"device_id, {value}" if value else "device_id"
    return f"""SELECT md5(concat_ws('|', event_id, '{rule_id or alert_type}')) AS alert_id, event_id,
           event_timestamp AS alert_timestamp, device_id, device_type, region,
           '{alert_type}' AS alert_type, '{severity}' AS severity, printf('{template}', {arguments}) AS description
    FROM enr WHERE {condition}"""


def _alerts_cte(rules=RULES, name: str = "alerts_t") -> str:
    body = "\n    UNION ALL\n    ".join(_rule_select(r) for r in rules)
    return f"{name} AS (\n    {body}\n)"


ALERTS = _alerts_cte()

SUMMARY = """
evs AS (
    SELECT CAST(event_timestamp AS DATE) AS summary_date, device_id,
           max(device_type) AS device_type, max(region) AS region,
           count(*) AS total_events,
           avg(cpu_usage) AS avg_cpu_usage, avg(memory_usage) AS avg_memory_usage,
           avg(bandwidth_mbps) AS avg_bandwidth_mbps, avg(latency_ms) AS avg_latency_ms,
           avg(packet_loss) AS avg_packet_loss
    FROM tel GROUP BY 1, 2
),
als AS (
    SELECT CAST(alert_timestamp AS DATE) AS summary_date, device_id,
           count(*) AS total_alerts,
           count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
           count(*) FILTER (WHERE severity = 'HIGH') AS high_alerts,
           count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_alerts
    FROM alerts_t GROUP BY 1, 2
),
summ AS (
    SELECT e.summary_date, e.device_id, e.device_type, e.region, e.total_events,
           round(e.avg_cpu_usage, 6) AS avg_cpu_usage, round(e.avg_memory_usage, 6) AS avg_memory_usage,
           round(e.avg_bandwidth_mbps, 6) AS avg_bandwidth_mbps, round(e.avg_latency_ms, 6) AS avg_latency_ms,
           round(e.avg_packet_loss, 6) AS avg_packet_loss,
           coalesce(a.total_alerts, 0) AS total_alerts, coalesce(a.critical_alerts, 0) AS critical_alerts,
           coalesce(a.high_alerts, 0) AS high_alerts, coalesce(a.medium_alerts, 0) AS medium_alerts,
           (SELECT t FROM as_of_t) AS computed_at
    FROM evs e LEFT JOIN als a ON a.summary_date = e.summary_date AND a.device_id = e.device_id
)
"""


def _q(body: str, with_summary: bool = False) -> str:
    ctes = BASE + ALERTS + ("," + SUMMARY if with_summary else "")
    return ctes + "\n" + body


_RULE_SQL = {
    f"r{i}_{r[0].lower()}": BASE + _alerts_cte([r]) + "\nSELECT * FROM alerts_t"
    for i, r in enumerate(RULES, start=1)
}

def _per_column(table: str, source: str, tests: dict[str, str], value: str) -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"count(*) FILTER (WHERE {t}) AS {value} FROM {source}"
        for c, t in tests.items()
    ]
    return "\nUNION ALL\n".join(parts)


def _quality_tables():
    return {
        "raw_network_events": "tel",
        "processed_network_events": "(SELECT *, (SELECT t FROM as_of_t) AS processed_at FROM enr)",
        "alerts": "(SELECT *, (SELECT t FROM as_of_t) AS created_at FROM alerts_t)",
        "daily_monitoring_summary": "summ",
    }


def _q2() -> str:
    keys = {
        "raw_network_events": "event_id",
        "processed_network_events": "event_id",
        "alerts": "alert_id",
        "daily_monitoring_summary": "summary_date, device_id",
    }
    parts = []
    for t, src in _quality_tables().items():
        parts.append(
            f"""SELECT '{t}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows,
       count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT {keys[t]}, count(*) AS n FROM {src} GROUP BY {keys[t]})"""
        )
    return _q("\nUNION ALL\n".join(parts), with_summary=True)


def _q3() -> str:
    parts = [
        _per_column(t, src, {c: f"{c} IS NULL" for c in REQUIRED[t].split()}, "null_rows")
        for t, src in _quality_tables().items()
    ]
    return _q("\nUNION ALL\n".join(parts), with_summary=True)


def _q4() -> str:
    parts = [
        _per_column(t, src, {c: f"length({c}) > {n}" for c, n in WIDTHS[t].items()}, "too_long_rows")
        for t, src in _quality_tables().items()
    ]
    return _q("\nUNION ALL\n".join(parts), with_summary=True)


def _j2() -> str:
    parts = [
        f"""SELECT '{t}' AS table_name, count(*) AS orphan_devices,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows
FROM (SELECT device_id, count(*) AS n FROM {src} GROUP BY device_id) f
WHERE NOT EXISTS (SELECT 1 FROM dev WHERE dev.device_id = f.device_id)"""
        for t, src in _quality_tables().items()
    ]
    return _q("\nUNION ALL\n".join(parts), with_summary=True)


def _report() -> str:
    return _q(
        """
, tot AS (SELECT summary_date, sum(total_events) AS ev, sum(total_alerts) AS al FROM summ GROUP BY 1),
hdr AS (
    SELECT summary_date, 0 AS line_no, '# Daily Network Monitoring Report — ' || strftime(summary_date, '%Y-%m-%d') AS line FROM tot
    UNION ALL SELECT summary_date, 1, '' FROM tot
    UNION ALL SELECT summary_date, 2, '- **Total events:** ' || CAST(ev AS VARCHAR) FROM tot
    UNION ALL SELECT summary_date, 3, '- **Total alerts:** ' || CAST(al AS VARCHAR) FROM tot
    UNION ALL SELECT summary_date, 4, '' FROM tot
    UNION ALL SELECT summary_date, 5, '| Device | Region | Events | Alerts | Critical | High | Medium |' FROM tot
    UNION ALL SELECT summary_date, 6, '|---|---|---|---|---|---|---|' FROM tot
),
rws AS (
    SELECT summary_date,
           CAST(6 + row_number() OVER (PARTITION BY summary_date ORDER BY total_alerts DESC, device_id) AS INTEGER) AS line_no,
           '| ' || device_id || ' | ' || region || ' | ' || total_events || ' | ' || total_alerts || ' | '
             || critical_alerts || ' | ' || high_alerts || ' | ' || medium_alerts || ' |' AS line
    FROM summ
)
SELECT summary_date, CAST(line_no AS INTEGER) AS line_no, line FROM hdr
UNION ALL SELECT summary_date, line_no, line FROM rws
""",
        with_summary=True,
    )


FAULTY = """, marked AS (
    SELECT * REPLACE (
        CASE WHEN fixture_k = 11 THEN NULL ELSE region END AS region,
        CASE WHEN fixture_k = 12 THEN rpad(device_id, 12, '-') || '-overlong-id'
             WHEN fixture_k = 13 THEN 'GHOST-1' ELSE device_id END AS device_id)
    FROM tel),
faulty AS (SELECT * FROM marked UNION ALL SELECT * FROM marked WHERE fixture_k = 10)
"""


def _key_row(table: str, source: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows,
       count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT {key}, count(*) AS n FROM {source} GROUP BY {key})"""


def _stored_queries() -> dict[str, str]:
    good = "(SELECT * FROM tel WHERE fixture_k IS DISTINCT FROM 97)"
    alerts = "(SELECT a.* FROM alerts_t a JOIN tel t USING (event_id) WHERE t.fixture_k IS DISTINCT FROM 97)"
    tables = [
        ("bronze", "tel", "event_id"),
        ("raw_network_events", good, "event_id"),
        ("processed_network_events", good, "event_id"),
        ("rejects", "(SELECT * FROM tel WHERE fixture_k = 97)", "event_id"),
        ("silver_alerts", alerts, "alert_id"),
        ("alerts", alerts, "alert_id"),
    ]
    raw = "raw_network_events"
    return {
        "k9_tables_after_redelivery": _q("\nUNION ALL\n".join(_key_row(*t) for t in tables)),
        "k7_stream_processed_events": _q(
            """SELECT event_id, date_trunc('millisecond', event_timestamp) AS event_timestamp, device_id, device_type,
       region, round(bandwidth_utilization_pct, 6) AS bandwidth_utilization_pct, health_status
FROM enr WHERE fixture_k IS DISTINCT FROM 97"""
        ),
        "k3_stream_silver_alerts": _q(
            f"SELECT * REPLACE (date_trunc('millisecond', alert_timestamp) AS alert_timestamp) FROM {alerts}"
        ),
        "g11_rollup_panels": _q(
            "\nUNION ALL\n".join(
                f"(SELECT '{key}' AS panel, {key} AS value, count(*) AS count FROM alerts_t GROUP BY {key})"
                for key in ("severity", "region", "device_id")
            )
        ),
        "g9_trend_last_hour": _q(
            """SELECT date_trunc('minute', event_timestamp) AS time, round(avg(cpu_usage), 6) AS cpu_usage,
       round(avg(memory_usage), 6) AS memory_usage FROM tel, as_of_t
WHERE event_timestamp BETWEEN t - INTERVAL 1 HOUR AND t GROUP BY 1"""
        ),
        "o2_high_latency_bands": _q(
            """SELECT event_id, device_id, device_type, region, latency_ms, event_timestamp,
       CASE WHEN latency_ms >= 300 THEN 'red' WHEN latency_ms >= 200 THEN 'orange' ELSE 'green' END AS latency_band
FROM tel, as_of_t WHERE latency_ms > 200e0 AND event_timestamp > t - INTERVAL 1 HOUR
ORDER BY event_timestamp DESC, event_id LIMIT 50"""
        ),
        "s5_stored_summary": _q("SELECT * EXCLUDE (computed_at) FROM summ", with_summary=True),
        "s6_stored_devices": _q(
            FAULTY
            + """, seen AS (
    SELECT device_id, arg_min(device_type, r) AS device_type,
           max(CASE WHEN r = 1 THEN region END) AS region, min(event_timestamp) AS first_seen_at,
           max(event_timestamp) AS last_seen_at
    FROM (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY event_timestamp, event_id) AS r FROM marked)
    GROUP BY device_id)
SELECT coalesce(dev.device_id, seen.device_id) AS device_id,
       CASE WHEN dev.device_id IS NULL THEN seen.device_type ELSE dev.device_type END AS device_type,
       CASE WHEN dev.device_id IS NULL THEN seen.region ELSE dev.region END AS region,
       'UP' AS current_status, first_seen_at, last_seen_at
FROM dev FULL JOIN seen ON dev.device_id = seen.device_id"""
        ),
        "k15_report_with_empty_day": _report().replace(
            "SELECT summary_date, CAST(line_no AS INTEGER) AS line_no, line FROM hdr",
            """, every AS (SELECT summary_date, CAST(line_no AS INTEGER) AS line_no, line FROM hdr""",
        )
        + """),
day AS (SELECT CAST(t AS DATE) AS d FROM as_of_t)
SELECT every.* FROM every, day WHERE summary_date = d
UNION ALL SELECT d + 1, 0, '# Daily Network Monitoring Report — ' || strftime(d + 1, '%Y-%m-%d') FROM day
UNION ALL SELECT d + 1, 1, '' FROM day
UNION ALL SELECT d + 1, 2, 'No data recorded for this date.' FROM day""",
        "q8_last_not_null": _q(
            """SELECT device_id, max(CASE WHEN r = 1 THEN cpu_usage END) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY device_id, cpu_usage IS NULL
        ORDER BY event_timestamp DESC, event_id DESC) AS r FROM tel)
GROUP BY device_id"""
        ),
        "g15_freshness_stale": _q("SELECT CAST(0 AS BIGINT) AS recent_rows, 'STALE' AS status"),
        "a6_two_cpu_rules": BASE
        + "alerts_t AS ("
        + _rule_select(RULES[0])
        + "\nUNION ALL\n"
        + _rule_select((*RULES[0][:2], "cpu_usage > 95e0", *RULES[0][3:]), "CPU_HIGH_95")
        + ")\nSELECT * FROM alerts_t",
        "q2_faulty_keys": _q(FAULTY + _key_row(raw, "faulty", "event_id")),
        "q3_faulty_nulls": _q(
            FAULTY + _per_column(raw, "faulty", {c: f"{c} IS NULL" for c in REQUIRED[raw].split()}, "null_rows")
        ),
        "q4_faulty_widths": _q(
            FAULTY + _per_column(raw, "faulty", {c: f"length({c}) > {n}" for c, n in WIDTHS[raw].items()}, "too_long_rows")
        ),
        "q6_faulty_rejects": _q(
            FAULTY + "SELECT fixture_k, count(*) AS rejected FROM faulty WHERE fixture_k IN (11, 12) GROUP BY 1"
        ),
        "j2_faulty_devices": _q(
            FAULTY
            + f"""SELECT '{raw}' AS table_name, count(*) AS orphan_devices, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows
FROM (SELECT device_id, count(*) AS n FROM faulty GROUP BY device_id) f
WHERE NOT EXISTS (SELECT 1 FROM dev WHERE dev.device_id = f.device_id)"""
        ),
        "j3_faulty_reconcile": _q(
            """SELECT count(*) FILTER (WHERE fixture_k IS NULL OR fixture_k NOT IN (14, 15)) AS in_both,
       count(*) FILTER (WHERE fixture_k = 15) AS processed_only,
       count(*) FILTER (WHERE fixture_k = 14) AS raw_only FROM tel"""
        ),
    }


_GHOSTS = """, ghosts AS (
    SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 AND fixture_k IS DISTINCT FROM 97
                           THEN concat('GHOST-', CAST(event_id AS BIGINT) % 2) ELSE device_id END AS device_id)
    FROM enr WHERE fixture_k IS DISTINCT FROM 97),
fired AS (SELECT event_id, count(*) AS n FROM alerts_t GROUP BY event_id),
counted AS (
    SELECT 'raw_network_events' AS table_name, device_id, count(*) AS rows FROM ghosts GROUP BY ALL
    UNION ALL SELECT 'processed_network_events', device_id, count(*) FROM ghosts GROUP BY ALL
    UNION ALL SELECT 'alerts', device_id, CAST(sum(n) AS BIGINT) FROM ghosts JOIN fired USING (event_id) GROUP BY ALL),
held AS (SELECT 'held_events' AS table_name, device_id, rows FROM counted WHERE table_name = 'raw_network_events')
"""

# The versions that win: the first of each id; every seventh event also under a new id.
_VERSIONS = """, won AS (
    SELECT event_id, event_id AS old_id FROM enr WHERE fixture_k IS DISTINCT FROM 97
    UNION ALL
    SELECT concat('n-', event_id), event_id FROM enr
    WHERE fixture_k IS DISTINCT FROM 97 AND CAST(event_id AS BIGINT) % 7 = 0),
versions AS (
    SELECT w.event_id, date_trunc('millisecond', e.event_timestamp) AS event_timestamp, w.old_id, e.cpu_usage, e.health_status
    FROM won w JOIN enr e ON e.event_id = w.old_id)
"""


def _history_queries() -> dict[str, str]:
    alert_rows = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, v.event_id, v.event_timestamp, a.alert_type AS detail FROM versions v JOIN alerts_t a ON a.event_id = v.old_id"
        for t in ("alerts", "silver_alerts")
    )
    device_rows = "\nUNION ALL\n".join(
        [
            "SELECT 'before' AS stage, * FROM counted WHERE device_id NOT LIKE 'GHOST%'",
            "SELECT 'before', * FROM held WHERE device_id LIKE 'GHOST%'",
            "SELECT 'after', * FROM counted WHERE device_id <> 'GHOST-1'",
            "SELECT 'after', * FROM held WHERE device_id = 'GHOST-1'",
        ]
    )
    return {
        "k9_one_version_per_id": _q(
            _VERSIONS
            + f"""SELECT 'raw_network_events' AS table_name, event_id, event_timestamp,
       CASE WHEN cpu_usage IS NULL THEN 'null' ELSE printf('%.2f', cpu_usage) END AS detail FROM versions
UNION ALL SELECT 'processed_network_events', event_id, event_timestamp, health_status FROM versions
UNION ALL {alert_rows}"""
        ),
        "k11_register_devices": _q(
            """SELECT device_id, device_type, region, 'UP' AS current_status FROM dev
UNION ALL SELECT DISTINCT concat('NEW-', device_id), device_type, region, 'UP' FROM tel"""
        ),
        "j2_device_gate": _q(_GHOSTS + device_rows),
        "j3_differing_days": _q(
            """SELECT CAST(event_timestamp AS DATE) AS event_date,
       count(*) FILTER (WHERE fixture_k IS NULL OR fixture_k NOT IN (14, 15)) AS in_both,
       count(*) FILTER (WHERE fixture_k = 15) AS processed_only, count(*) FILTER (WHERE fixture_k = 14) AS raw_only
FROM tel WHERE day(event_timestamp) % 2 = 0 GROUP BY 1 HAVING count(*) FILTER (WHERE fixture_k IN (14, 15)) > 0"""
        ),
        "q6_reject_reasons": _q(
            """, numbered AS (SELECT CAST(event_id AS BIGINT) AS i, fixture_k IS NOT DISTINCT FROM 97 AS broken FROM tel),
reasons AS (
    SELECT 'malformed' AS reason FROM numbered WHERE broken
    UNION ALL SELECT 'missing:region' FROM numbered WHERE NOT broken AND i % 13 = 0
    UNION ALL SELECT 'too_long:device_id' FROM numbered WHERE NOT broken AND i % 17 = 0
    UNION ALL SELECT 'bad:event_timestamp' FROM numbered WHERE NOT broken AND i % 19 = 0
    UNION ALL SELECT 'kept in bronze' FROM numbered WHERE NOT broken AND i % 23 = 0)
SELECT reason, count(*) AS rows FROM reasons GROUP BY 1"""
        ),
        "t6_stream_history": """SELECT 'good' AS query, 'stopped' AS ended, CAST(1 AS BIGINT) AS starts, count(*) AS input_rows,
       false AS reason_kept FROM events
UNION ALL SELECT 'bad', 'failed', CAST(1 AS BIGINT), CAST(0 AS BIGINT), true""",
    }


def oracle_sql() -> dict[str, str]:
    q = {
        "g11_alerts_by_severity": _q(
            "SELECT severity, count(*) AS count FROM alerts_t GROUP BY severity ORDER BY count DESC, severity"
        ),
        "a5_alert_rows": _q("SELECT * FROM alerts_t"),
        **_RULE_SQL,
        "p9_processed_events": _q(
            """SELECT event_id, event_timestamp, device_id, device_type, region,
       round(bandwidth_utilization_pct, 6) AS bandwidth_utilization_pct, health_status FROM enr"""
        ),
        "p6_health_status_counts": _q(
            "SELECT health_status, count(*) AS events FROM enr GROUP BY health_status"
        ),
        "p8_raw_events": _q(
            """SELECT event_id, event_timestamp, device_id, device_type, region, cpu_usage, memory_usage,
       bandwidth_mbps, packet_loss, latency_ms, temperature, status FROM tel"""
        ),
        "a4_alerts_per_event": _q(
            """, per_event AS (
    SELECT e.event_id, count(a.alert_id) AS n_alerts,
           coalesce(e.status = 'DOWN' OR e.cpu_usage > 90e0 OR e.memory_usage > 90e0 OR e.packet_loss > 5e0
                    OR e.latency_ms > 200e0 OR e.bandwidth_mbps > 950e0, false) AS anomalous
    FROM enr e LEFT JOIN alerts_t a ON a.event_id = e.event_id
    GROUP BY e.event_id, e.status, e.cpu_usage, e.memory_usage, e.packet_loss, e.latency_ms, e.bandwidth_mbps
)
SELECT CAST(n_alerts AS INTEGER) AS n_alerts, count(*) AS events, count(*) FILTER (WHERE anomalous) AS anomalous_events
FROM per_event GROUP BY 1"""
        ),
        "p2_parse_kafka_frame": _q(
            """SELECT device_id AS kafka_key,
       CASE WHEN fixture_k = 97 THEN NULL ELSE event_id END AS event_id,
       CASE WHEN fixture_k = 97 THEN NULL ELSE device_id END AS device_id,
       CASE WHEN fixture_k = 97 THEN NULL ELSE device_type END AS device_type,
       CASE WHEN fixture_k = 97 THEN NULL ELSE region END AS region,
       CASE WHEN fixture_k = 97 THEN NULL ELSE cpu_usage END AS cpu_usage,
       CASE WHEN fixture_k = 97 THEN NULL ELSE memory_usage END AS memory_usage,
       CASE WHEN fixture_k = 97 THEN NULL ELSE bandwidth_mbps END AS bandwidth_mbps,
       CASE WHEN fixture_k = 97 THEN NULL ELSE packet_loss END AS packet_loss,
       CASE WHEN fixture_k = 97 THEN NULL ELSE latency_ms END AS latency_ms,
       CASE WHEN fixture_k = 97 THEN NULL ELSE temperature END AS temperature,
       CASE WHEN fixture_k = 97 THEN NULL ELSE status END AS status,
       CASE WHEN fixture_k = 97 THEN NULL ELSE date_trunc('millisecond', event_timestamp) END AS event_timestamp
FROM tel"""
        ),
        "q6_rejected_payloads": _q(
            """SELECT device_id AS kafka_key, CAST(event_id AS BIGINT) AS kafka_offset
FROM tel WHERE fixture_k = 97"""
        ),
        "q6_accepted_enriched": _q(
            """SELECT event_id, date_trunc('millisecond', event_timestamp) AS event_timestamp, device_id, device_type,
       region, round(bandwidth_utilization_pct, 6) AS bandwidth_utilization_pct, health_status
FROM enr WHERE fixture_k IS DISTINCT FROM 97"""
        ),
        "g3_total_events": _q("SELECT count(*) AS value FROM tel"),
        "g4_active_devices_5m": _q(
            "SELECT count(DISTINCT device_id) AS value FROM tel WHERE event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 5 MINUTE"
        ),
        "g5_device_failures_1h": _q(
            "SELECT count(*) AS value FROM tel WHERE status = 'DOWN' AND event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 1 HOUR"
        ),
        "g6_alerts_24h": _q(
            "SELECT count(*) AS value FROM alerts_t WHERE alert_timestamp > (SELECT t FROM as_of_t) - INTERVAL 24 HOUR"
        ),
        "g7_avg_cpu_5m": _q(
            "SELECT round(avg(cpu_usage), 6) AS value FROM tel WHERE event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 5 MINUTE"
        ),
        "g8_avg_memory_5m": _q(
            "SELECT round(avg(memory_usage), 6) AS value FROM tel WHERE event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 5 MINUTE"
        ),
        "g9_cpu_memory_trend": _q(
            """SELECT date_trunc('minute', event_timestamp) AS time, round(avg(cpu_usage), 6) AS cpu_usage,
       round(avg(memory_usage), 6) AS memory_usage FROM tel GROUP BY 1 ORDER BY 1"""
        ),
        "g10_packet_loss_trend": _q(
            """SELECT date_trunc('minute', event_timestamp) AS time, round(avg(packet_loss), 6) AS packet_loss
FROM tel GROUP BY 1 ORDER BY 1"""
        ),
        "o2_high_latency_recent": _q(
            """SELECT event_id, device_id, device_type, region, latency_ms, event_timestamp FROM tel
WHERE latency_ms > 200e0 AND event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 1 HOUR
ORDER BY event_timestamp DESC, event_id LIMIT 50"""
        ),
        "g12_alerts_by_region": _q(
            "SELECT region, count(*) AS count FROM alerts_t GROUP BY region ORDER BY count DESC, region"
        ),
        "g13_top_devices_by_alerts": _q(
            "SELECT device_id, count(*) AS count FROM alerts_t GROUP BY device_id ORDER BY count DESC, device_id LIMIT 10"
        ),
        "w1_severity_share": _q(
            """SELECT severity, count(*) AS count,
       round(count(*) * 100e0 / sum(count(*)) OVER (), 6) AS percent
FROM alerts_t GROUP BY severity ORDER BY count DESC, severity"""
        ),
        "q7_kpi_panel": _q(
            """, k AS (
    SELECT count(*) AS total_events,
           count(DISTINCT device_id) FILTER (WHERE event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 5 MINUTE) AS active_devices,
           count(*) FILTER (WHERE status = 'DOWN' AND event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 1 HOUR) AS device_failures,
           (SELECT count(*) FROM alerts_t WHERE alert_timestamp > (SELECT t FROM as_of_t) - INTERVAL 24 HOUR) AS alerts_24h,
           round(avg(cpu_usage) FILTER (WHERE event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 5 MINUTE), 6) AS avg_cpu,
           round(avg(memory_usage) FILTER (WHERE event_timestamp > (SELECT t FROM as_of_t) - INTERVAL 5 MINUTE), 6) AS avg_memory
    FROM tel
)
SELECT *,
    'blue' AS total_events_band,
    CASE WHEN active_devices >= 24 THEN 'green' WHEN active_devices >= 15 THEN 'orange' ELSE 'red' END AS active_devices_band,
    CASE WHEN device_failures >= 5 THEN 'red' WHEN device_failures >= 1 THEN 'orange' ELSE 'green' END AS device_failures_band,
    CASE WHEN alerts_24h >= 30 THEN 'red' WHEN alerts_24h >= 10 THEN 'orange' ELSE 'green' END AS alerts_24h_band,
    CASE WHEN avg_cpu >= 90 THEN 'red' WHEN avg_cpu >= 70 THEN 'orange' ELSE 'green' END AS avg_cpu_band,
    CASE WHEN avg_memory >= 90 THEN 'red' WHEN avg_memory >= 70 THEN 'orange' ELSE 'green' END AS avg_memory_band
FROM k"""
        ),
        "f10_anomalies_per_hour": _q(
            """SELECT date_trunc('hour', event_timestamp) AS time, count(*) AS events_sent,
       count(*) FILTER (WHERE status = 'DOWN' OR cpu_usage > 90e0 OR memory_usage > 90e0 OR packet_loss > 5e0
                        OR latency_ms > 200e0 OR bandwidth_mbps > 950e0) AS anomalous_readings
FROM tel GROUP BY 1 ORDER BY 1"""
        ),
        "g1_daily_event_stats": _q(
            """, g AS (
    SELECT CAST(event_timestamp AS DATE) AS summary_date, device_id, max(device_type) AS device_type,
           max(region) AS region, count(*) AS total_events,
           round(avg(cpu_usage), 6) AS avg_cpu_usage, round(avg(memory_usage), 6) AS avg_memory_usage,
           round(avg(bandwidth_mbps), 6) AS avg_bandwidth_mbps, round(avg(latency_ms), 6) AS avg_latency_ms,
           round(avg(packet_loss), 6) AS avg_packet_loss
    FROM tel GROUP BY 1, 2
) SELECT * FROM g"""
        ),
        "g2_daily_alert_counts": _q(
            """, g AS (
    SELECT CAST(alert_timestamp AS DATE) AS summary_date, device_id, count(*) AS total_alerts,
           count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_alerts,
           count(*) FILTER (WHERE severity = 'HIGH') AS high_alerts,
           count(*) FILTER (WHERE severity = 'MEDIUM') AS medium_alerts
    FROM alerts_t GROUP BY 1, 2
) SELECT * FROM g"""
        ),
        "j1_daily_summary": _q("SELECT * FROM summ", with_summary=True),
        "j1_last_day_summary": _q(
            "SELECT * FROM summ WHERE summary_date = (SELECT CAST(t AS DATE) FROM as_of_t)", with_summary=True
        ),
        "o1_last_day_report_rows": _q(
            """SELECT device_id, region, total_events, total_alerts, critical_alerts, high_alerts, medium_alerts
FROM summ WHERE summary_date = (SELECT CAST(t AS DATE) FROM as_of_t) ORDER BY total_alerts DESC, device_id""",
            with_summary=True,
        ),
        "k10_upsert_rerun": _q("SELECT * FROM summ", with_summary=True),
        "g14_day_totals": _q(
            """SELECT summary_date, count(*) AS devices, CAST(sum(total_events) AS BIGINT) AS total_events,
       CAST(sum(total_alerts) AS BIGINT) AS total_alerts FROM summ GROUP BY 1""",
            with_summary=True,
        ),
        "k14_report_lines": _report(),
        "q2_key_uniqueness": _q2(),
        "q3_required_columns": _q3(),
        "q4_string_widths": _q4(),
        "j2_device_foreign_keys": _j2(),
        "j3_processed_vs_raw": _q(
            """SELECT count(*) FILTER (WHERE p.event_id IS NOT NULL AND r.event_id IS NOT NULL) AS in_both,
       count(*) FILTER (WHERE r.event_id IS NULL) AS processed_only,
       count(*) FILTER (WHERE p.event_id IS NULL) AS raw_only
FROM (SELECT DISTINCT event_id FROM enr) p FULL OUTER JOIN (SELECT DISTINCT event_id FROM tel) r
  ON p.event_id = r.event_id"""
        ),
        "g15_freshness": _q(
            """SELECT count(*) AS recent_rows, CASE WHEN count(*) > 0 THEN 'OK' ELSE 'STALE' END AS status
FROM tel WHERE ingested_at > (SELECT t FROM as_of_t) - INTERVAL 1 HOUR"""
        ),
        "k9_unique_append": _q(
            """SELECT event_id, event_timestamp, device_id, device_type, region, cpu_usage, memory_usage,
       bandwidth_mbps, packet_loss, latency_ms, temperature, status
FROM tel WHERE event_timestamp >= (SELECT CAST(CAST(t AS DATE) AS TIMESTAMP) FROM as_of_t)"""
        ),
        "t4_stream_raw_events": _q(
            """SELECT event_id, date_trunc('millisecond', event_timestamp) AS event_timestamp, device_id, device_type,
       region, cpu_usage, memory_usage, bandwidth_mbps, packet_loss, latency_ms, temperature, status
FROM tel WHERE fixture_k IS DISTINCT FROM 97"""
        ),
        "t5_stream_alerts_by_severity": _q(
            """SELECT a.severity, count(*) AS count FROM alerts_t a JOIN tel t ON t.event_id = a.event_id
WHERE t.fixture_k IS DISTINCT FROM 97 GROUP BY a.severity ORDER BY count DESC, a.severity"""
        ),
    }
    q["q7_kpi_row_stored"] = q["q7_kpi_panel"]
    q["g15_arrivals"] = q["g15_freshness"]
    q["t1_processing_time_trigger"] = q["t4_stream_raw_events"]
    return q | _stored_queries() | _history_queries()
