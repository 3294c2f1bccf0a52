"""Schemas and column contracts of the telemetry data model."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

METRIC_COLUMNS = (
    "cpu_usage",
    "memory_usage",
    "bandwidth_mbps",
    "packet_loss",
    "latency_ms",
    "temperature",
)

# JSON payload on the wire.  The identity fields are declared non-null, but
# from_json does not enforce that: bad or missing values come out as NULL and
# are routed to the rejects table by ``functions.parse.split_rejects``.
EVENT_WIRE_SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("timestamp", StringType(), False),
        StructField("device_id", StringType(), False),
        StructField("device_type", StringType(), False),
        StructField("region", StringType(), False),
        *[StructField(m, DoubleType(), True) for m in METRIC_COLUMNS],
        StructField("status", StringType(), True),
    ]
)

# Column lists of the three fact tables (the sink projections).
RAW_EVENT_COLUMNS = (
    "event_id",
    "event_timestamp",
    "device_id",
    "device_type",
    "region",
    *METRIC_COLUMNS,
    "status",
)

PROCESSED_EVENT_COLUMNS = (
    "event_id",
    "event_timestamp",
    "device_id",
    "device_type",
    "region",
    "bandwidth_utilization_pct",
    "health_status",
)

ALERT_COLUMNS = (
    "alert_id",
    "event_id",
    "alert_timestamp",
    "device_id",
    "device_type",
    "region",
    "alert_type",
    "severity",
    "description",
)

SUMMARY_KEY = ("summary_date", "device_id")
SUMMARY_COLUMNS = (
    "summary_date",
    "device_id",
    "device_type",
    "region",
    "total_events",
    "avg_cpu_usage",
    "avg_memory_usage",
    "avg_bandwidth_mbps",
    "avg_latency_ms",
    "avg_packet_loss",
    "total_alerts",
    "critical_alerts",
    "high_alerts",
    "medium_alerts",
    "computed_at",
)
# Columns an upsert refreshes; device_type / region keep their first value.
SUMMARY_UPDATE_COLUMNS = SUMMARY_COLUMNS[4:]

# Table constraints of the final relational schema, as data: NOT NULL
# columns and VARCHAR widths (fixed values of the reference DDL).
REQUIRED_COLUMNS = {
    "raw_network_events": (
        "event_id", "event_timestamp", "device_id", "device_type", "region", "ingested_at",
    ),
    "processed_network_events": (
        "event_id", "event_timestamp", "device_id", "device_type", "region",
        "health_status", "processed_at",
    ),
    "alerts": (
        "alert_id", "alert_timestamp", "device_id", "device_type", "region",
        "alert_type", "severity", "description", "created_at",
    ),
    "daily_monitoring_summary": (
        "summary_date", "device_id", "device_type", "region", "total_events",
        "total_alerts", "critical_alerts", "high_alerts", "medium_alerts", "computed_at",
    ),
}

STRING_WIDTHS = {
    "raw_network_events": {
        "event_id": 36, "device_id": 20, "device_type": 20, "region": 30, "status": 10,
    },
    "processed_network_events": {
        "event_id": 36, "device_id": 20, "device_type": 20, "region": 30, "health_status": 10,
    },
    "alerts": {
        "alert_id": 36, "device_id": 20, "device_type": 20, "region": 30,
        "alert_type": 30, "severity": 10,
    },
    "daily_monitoring_summary": {"device_id": 20, "device_type": 20, "region": 30},
}

PRIMARY_KEYS = {
    "raw_network_events": ("event_id",),
    "processed_network_events": ("event_id",),
    "alerts": ("alert_id",),
    "daily_monitoring_summary": SUMMARY_KEY,
    "devices": ("device_id",),
}

SUMMARY_SCHEMA = StructType(
    [
        StructField("summary_date", DateType(), False),
        StructField("device_id", StringType(), False),
        StructField("device_type", StringType(), True),
        StructField("region", StringType(), True),
        StructField("total_events", LongType(), True),
        *[
            StructField(c, DoubleType(), True)
            for c in (
                "avg_cpu_usage", "avg_memory_usage", "avg_bandwidth_mbps", "avg_latency_ms",
                "avg_packet_loss",
            )
        ],
        *[
            StructField(c, LongType(), True)
            for c in ("total_alerts", "critical_alerts", "high_alerts", "medium_alerts")
        ],
        StructField("computed_at", TimestampType(), True),
    ]
)

_DOUBLES = {*METRIC_COLUMNS, "bandwidth_utilization_pct"}


def _column_type(name: str) -> DataType:
    if name in _DOUBLES:
        return DoubleType()
    return TimestampType() if name.endswith(("_timestamp", "_at")) else StringType()


def _fields(*names: str) -> list[StructField]:
    return [StructField(n, _column_type(n)) for n in names]


_KAFKA_FIELDS = [
    StructField("kafka_key", StringType()),
    StructField("kafka_partition", IntegerType()),
    StructField("kafka_offset", LongType()),
    StructField("kafka_timestamp", TimestampType()),
]

# Declared schemas of the stored tables, partition column last: a table reads
# the same whether or not it holds a file yet.
TABLE_SCHEMAS = {
    "bronze": StructType(
        [*_KAFKA_FIELDS, *_fields(*RAW_EVENT_COLUMNS, "bandwidth_utilization_pct", "health_status"),
         StructField("payload", VariantType()), StructField("ingest_date", DateType())]
    ),
    "raw_network_events": StructType(
        [*_fields(*RAW_EVENT_COLUMNS, "ingested_at"), StructField("event_date", DateType())]
    ),
    "processed_network_events": StructType(
        [*_fields(*PROCESSED_EVENT_COLUMNS, "processed_at"), StructField("event_date", DateType())]
    ),
    "silver_alerts": StructType([*_fields(*ALERT_COLUMNS), StructField("alert_date", DateType())]),
    "alerts": StructType([*_fields(*ALERT_COLUMNS, "created_at"), StructField("alert_date", DateType())]),
    "alert_counts": StructType(
        [*_fields("device_id", "region", "severity"), StructField("alerts", LongType()),
         StructField("alert_date", DateType())]
    ),
    "event_counts": StructType([StructField("events", LongType()), StructField("event_date", DateType())]),
    **{
        name: StructType(
            [StructField("rows", LongType()), StructField("bits", LongType()), StructField("total", DecimalType(38, 0)),
             StructField("event_date", DateType())]
        )
        for name in ("raw_digests", "processed_digests")
    },
    "arrivals": StructType(
        [StructField("source", StringType()), StructField("batch_id", LongType()), StructField("arrived_at", TimestampType()),
         StructField("rows", LongType()), StructField("arrival_date", DateType())]
    ),
    "rejects": StructType(
        [*_KAFKA_FIELDS, *_fields("json_value"), StructField("reasons", ArrayType(StringType())), *_fields("rejected_at"),
         StructField("ingest_date", DateType())]
    ),
    "held_events": StructType(
        [*_KAFKA_FIELDS[1:], *_fields(*RAW_EVENT_COLUMNS, "held_at"), StructField("ingest_date", DateType())]
    ),
    "released_events": StructType(
        [*_KAFKA_FIELDS[1:], *_fields("event_id", "released_at"), StructField("ingest_date", DateType())]
    ),
    "daily_monitoring_summary": SUMMARY_SCHEMA,
}
