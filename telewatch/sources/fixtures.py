"""Deterministic telemetry derived from the driver's ``events`` table.

The test tables hold no device telemetry, so FIXTURES.md §3 defines an
integer-arithmetic mapping from ``events`` rows to telemetry rows.  It is a
pure projection (no join, no shuffle): the device is looked up by position in
a literal array, so the plan stays inside one whole-stage-codegen span and
scales linearly with the events table.

The mapping is also exposed as a Kafka-shaped frame (key/value bytes plus the
topic/partition/offset/timestamp columns) so the parse layer and the streaming
jobs run over the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.sources.devices import SEED_DEVICES

DEVICE_COUNT = len(SEED_DEVICES)
TOPIC = "network-events"
KAFKA_PARTITIONS = 3

# Payloads whose props carry this k are emitted truncated in the
# Kafka-shaped fixture (malformed JSON), to exercise the rejects path.
MALFORMED_K = 97


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + F.lit(1))


def _ratio(numerator: Column, divisor: float) -> Column:
    """Integer result → double, divided by a double literal (same bits as the
    SQL oracle's ``CAST(x AS DOUBLE) / 100e0``)."""
    return numerator.cast("double") / F.lit(float(divisor))


def props_k(props: Column | None = None) -> Column:
    return F.from_json(F.col("props") if props is None else props, "k BIGINT").getField("k")


def telemetry_from_events(events: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """``events`` → raw telemetry (RAW_EVENT_COLUMNS + ingested_at).

    ``ingested_at`` is the event time in the fixture: arrival time is not in
    the source table, and equal times keep the freshness checks deterministic.
    ``extra`` maps output names to expressions over the narrow base
    (``event_id``, ``ts``, ``user_id``, ``event_type`` and the parsed ``_k``).

    ``k`` is parsed from ``props`` once, in a narrow pre-projection that the
    optimizer collapses into the scan's stage; every metric then refers to it.
    """
    base = events.select("event_id", "ts", "user_id", "event_type", props_k().alias("_k"))
    k = F.col("_k")
    eid = F.col("event_id")
    uid = F.col("user_id")
    down = (F.col("event_type") == F.lit("error")) & (k < F.lit(5))
    idx = (uid % F.lit(DEVICE_COUNT)).cast("int")

    def unless_down(value: Column, down_value: float) -> Column:
        return F.when(down, F.lit(down_value)).otherwise(value)

    cpu = F.when(k == F.lit(98), F.lit(None).cast("double")).otherwise(
        _ratio((eid * 37 + k * 101) % 10001, 100)
    )
    return base.select(
        eid.cast("string").alias("event_id"),
        F.col("ts").alias("event_timestamp"),
        _pick([d[0] for d in SEED_DEVICES], idx).alias("device_id"),
        _pick([d[1] for d in SEED_DEVICES], idx).alias("device_type"),
        _pick([d[2] for d in SEED_DEVICES], idx).alias("region"),
        unless_down(cpu, 0.0).alias("cpu_usage"),
        unless_down(_ratio((eid * 41 + uid * 7) % 10001, 100), 0.0).alias("memory_usage"),
        unless_down(_ratio((eid * 53 + uid * 31) % 10001, 10), 0.0).alias("bandwidth_mbps"),
        unless_down(_ratio((eid * 13 + k * 7) % 601, 100), 100.0).alias("packet_loss"),
        unless_down(_ratio((eid * 29 + uid * 17) % 2501, 10), 0.0).alias("latency_ms"),
        (F.lit(20.0) + _ratio((eid * 11) % 8001, 100)).alias("temperature"),
        F.when(down, F.lit("DOWN")).otherwise(F.lit("UP")).alias("status"),
        F.col("ts").alias("ingested_at"),
        *[c.alias(n) for n, c in (extra or {}).items()],
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def iso_millis(ts: Column) -> Column:
    """Timestamp → ISO-8601 text with milliseconds and a ``Z`` suffix, the
    producer's wire format (session time zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def kafka_frame_from_events(events: DataFrame) -> DataFrame:
    """``events`` → Kafka-shaped frame carrying JSON telemetry payloads.

    key = device id (the producer's message key), value = JSON with the
    12 wire fields, partition = a hash of the key over 3 partitions, offset =
    the event id, timestamp = the event time.  Rows whose props k equals
    MALFORMED_K carry a truncated payload (everything but the closing brace).
    """
    tele = telemetry_from_events(events, extra={"_k": F.col("_k")})
    json_text = F.to_json(
        F.struct(
            "event_id",
            iso_millis(F.col("event_timestamp")).alias("timestamp"),
            "device_id",
            "device_type",
            "region",
            "cpu_usage",
            "memory_usage",
            "bandwidth_mbps",
            "packet_loss",
            "latency_ms",
            "temperature",
            "status",
        )
    )
    payload = F.when(
        F.col("_k") == F.lit(MALFORMED_K),
        F.expr("substring(_json, 1, length(_json) - 1)"),
    ).otherwise(F.col("_json"))
    return tele.withColumn("_json", json_text).select(
        F.col("device_id").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.hash("device_id"), F.lit(KAFKA_PARTITIONS)).alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.col("event_timestamp").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
