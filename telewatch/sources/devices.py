"""The device dimension (S6) and its insert-if-absent maintenance input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.operators.merge import insert_if_absent
from telewatch.sources.versions import Versions

# The 26 seeded devices (id, type, region), in seed order.
# The order is part of the test fixture: device number n (0-25) is row n.
SEED_DEVICES = [
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

DEVICE_SCHEMA = "device_id STRING, device_type STRING, region STRING"
DIMENSION_SCHEMA = f"{DEVICE_SCHEMA}, current_status STRING, first_seen_at TIMESTAMP, last_seen_at TIMESTAMP"


def seed_devices(spark: SparkSession) -> DataFrame:
    """The seeded dimension as a local relation (26 rows: a literal, so its
    size bound is proven and it may be broadcast freely)."""
    return spark.createDataFrame(SEED_DEVICES, DEVICE_SCHEMA).select(
        "device_id",
        "device_type",
        "region",
        F.lit("UP").alias("current_status"),
    )


def observed_devices(telemetry: DataFrame) -> DataFrame:
    """Devices as the telemetry shows them: type and region of the first
    reading, and the first and last time seen.  Partial aggregates of fixed
    width; a hot device costs no single task."""
    return telemetry.groupBy("device_id").agg(
        F.min_by(F.struct("device_type", "region"), F.struct("event_timestamp", "event_id")).alias("_first"),
        F.min("event_timestamp").alias("first_seen_at"),
        F.max("event_timestamp").alias("last_seen_at"),
    ).select("device_id", "_first.device_type", "_first.region", "first_seen_at", "last_seen_at")


def register_devices(wh, devices: DataFrame) -> None:
    """Insert devices (id, type, region) that the dimension lacks; known ones
    stay as they are.  Of several rows of one id the least counts."""
    existing = read_devices(wh)
    never = F.lit(None).cast("timestamp")
    rows = devices.select(
        "device_id", "device_type", "region", F.lit("UP").alias("current_status"),
        never.alias("first_seen_at"), never.alias("last_seen_at"),
    )
    _versions(wh).write(existing.unionByName(insert_if_absent(rows, existing, ["device_id"])))


def merge_devices(existing: DataFrame, telemetry: DataFrame) -> DataFrame:
    """Devices of the telemetry that ``existing`` lacks are inserted (K11); known
    ones keep type, region and status, and their times seen widen."""
    seen = observed_devices(telemetry)
    columns = [c.strip().split(" ")[0] for c in DIMENSION_SCHEMA.split(",")]
    new = insert_if_absent(seen.withColumn("current_status", F.lit("UP")), existing, ["device_id"])
    times = seen.select("device_id", F.col("first_seen_at").alias("_first"), F.col("last_seen_at").alias("_last"))
    known = existing.join(times, "device_id", "left").withColumns(
        {"first_seen_at": F.least("first_seen_at", "_first"), "last_seen_at": F.greatest("last_seen_at", "_last")}
    )
    return known.select(*columns).unionByName(new.select(*columns))


def _versions(wh) -> Versions:
    return Versions(wh.spark, f"{wh.root}/devices", DIMENSION_SCHEMA)


def read_devices(wh) -> DataFrame:
    """The stored dimension of a warehouse; before the first update the seed,
    not seen yet."""
    stored = _versions(wh).read()
    if stored is not None:
        return stored
    never = F.lit(None).cast("timestamp")
    return seed_devices(wh.spark).select("*", never.alias("first_seen_at"), never.alias("last_seen_at"))


def update_devices(wh, start=None, end=None) -> None:
    """Merge the raw events of a date range into the stored dimension.  Widening
    is idempotent, so a day may be merged again.  The merged dimension is a new
    version; until it is committed the one before stands."""
    _versions(wh).write(merge_devices(read_devices(wh), wh.read("raw_network_events", start, end)))
