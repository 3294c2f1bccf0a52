"""Registered queries: one per inventory ID, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's ``events`` table through the fixture mapping
(FIXTURES.md §3) and runs the library operator over the whole table.
``as_of`` — the dashboard's "now" — is the latest event time, computed as a
scalar subquery.  Averages and percentages are rounded to 6 places so the
comparison with the SQL oracle does not depend on summation order.
"""

from __future__ import annotations

import contextlib
import dataclasses
import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from telewatch.functions.bands import last_not_null
from telewatch.functions.enrich import enrich
from telewatch.functions.parse import is_rejected, parse_kafka, split_rejects
from telewatch.functions.rules import CPU_HIGH, DEFAULT_RULES, anomalous_reading
from telewatch.functions.timecols import Latest
from telewatch.operators import dashboard as dash
from telewatch.operators import quality, report, rollup
from telewatch.operators.alerts import alert_count, detect_alerts
from telewatch.operators.merge import unique_append, upsert_summary, with_defaults
from telewatch.plans import dashboard, health
from telewatch.plans.daily import append_alerts, run_range
from telewatch.schemas import (
    ALERT_COLUMNS,
    EVENT_WIRE_SCHEMA,
    PRIMARY_KEYS,
    PROCESSED_EVENT_COLUMNS,
    RAW_EVENT_COLUMNS,
    REQUIRED_COLUMNS,
    STRING_WIDTHS,
)
from telewatch.session import configure, scratch_path
from telewatch.sources.devices import read_devices, register_devices, seed_devices, update_devices
from telewatch.sources.fixtures import kafka_frame_from_events, read_events, telemetry_from_events
from telewatch.sources.registry import EventRegistry
from telewatch.sources.tables import Warehouse
from telewatch.streaming.jobs import held_events, readmit, run_available, start_alerting, start_ingestion, stream_checkpoint
from telewatch.streaming.sources import KAFKA_SCHEMA, kafka_files_stream
from telewatch.streaming.supervise import append_history, attach_listener, read_history

ROUND_PLACES = 6


def round_doubles(df: DataFrame, places: int = ROUND_PLACES) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Fixture:
    """The derived tables of one scale-factor directory (all lazy)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark)
        self.spark = spark
        self.events = read_events(spark, sf_dir)
        self.raw = telemetry_from_events(self.events)
        self.enriched = enrich(self.raw)
        # the same with the number that the faulty rows are chosen by
        self.marked = telemetry_from_events(self.events, extra={"fixture_k": F.col("_k")})
        self.alerts = detect_alerts(self.enriched)
        self.now = Latest(self.raw, "event_timestamp")
        self.as_of: Column = self.now.column()

    def processed(self) -> DataFrame:
        return self.enriched.select(*PROCESSED_EVENT_COLUMNS)

    def summary(self) -> DataFrame:
        return rollup.daily_summary(self.raw, self.alerts, computed_at=self.as_of)

    def last_day(self) -> Column:
        return F.to_date(self.as_of)


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
        _REGISTRY[name] = lambda spark, sf_dir: fn(Fixture(spark, sf_dir))
        return fn

    return wrap


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- phase 0: alert engine -------------------------------------------------


@register("g11_alerts_by_severity")
def g11(fx: Fixture) -> DataFrame:
    return dash.alerts_by(fx.alerts, "severity")


@register("a5_alert_rows")
def a5(fx: Fixture) -> DataFrame:
    return fx.alerts


def _rule_query(rule):
    def q(fx: Fixture) -> DataFrame:
        return detect_alerts(fx.enriched, rules=[rule])

    return q


for _i, _rule in enumerate(DEFAULT_RULES, start=1):
    register(f"r{_i}_{_rule.alert_type.lower()}")(_rule_query(_rule))


@register("p9_processed_events")
def p9(fx: Fixture) -> DataFrame:
    return round_doubles(fx.processed())


@register("p6_health_status_counts")
def p6(fx: Fixture) -> DataFrame:
    return fx.enriched.groupBy("health_status").agg(F.count(F.lit(1)).alias("events"))


@register("p8_raw_events")
def p8(fx: Fixture) -> DataFrame:
    return fx.raw.select(*RAW_EVENT_COLUMNS)


@register("a4_alerts_per_event")
def a4(fx: Fixture) -> DataFrame:
    """Metamorphic: alerts per event = rules true; F10 ⇔ at least one alert."""
    per_event = fx.enriched.select(
        alert_count().alias("n_alerts"), F.coalesce(anomalous_reading(), F.lit(False)).alias("anomalous")
    )
    return per_event.groupBy("n_alerts").agg(
        F.count(F.lit(1)).alias("events"), F.count_if("anomalous").alias("anomalous_events")
    )


# --- phase 1: parse layer --------------------------------------------------


def _parsed(fx: Fixture, provenance: bool = False) -> DataFrame:
    return parse_kafka(kafka_frame_from_events(fx.events), keep_key=True, provenance=provenance)


@register("p2_parse_kafka_frame")
def p2(fx: Fixture) -> DataFrame:
    parsed = _parsed(fx)
    return parsed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@register("q6_rejected_payloads")
def q6(fx: Fixture) -> DataFrame:
    _, rejected = split_rejects(_parsed(fx, provenance=True))
    return rejected.select("kafka_key", "kafka_offset")


@register("q6_accepted_enriched")
def q6_accepted(fx: Fixture) -> DataFrame:
    accepted, _ = split_rejects(_parsed(fx, provenance=True))
    out = enrich(accepted).select(*PROCESSED_EVENT_COLUMNS)
    return round_doubles(out.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")))


# --- phase 2: dashboard ----------------------------------------------------


@register("g3_total_events")
def g3(fx: Fixture) -> DataFrame:
    return dash.total_events(fx.raw)


@register("g4_active_devices_5m")
def g4(fx: Fixture) -> DataFrame:
    return dash.active_devices(fx.raw, fx.now)


@register("g5_device_failures_1h")
def g5(fx: Fixture) -> DataFrame:
    return dash.device_failures(fx.raw, fx.now)


@register("g6_alerts_24h")
def g6(fx: Fixture) -> DataFrame:
    return dash.recent_alerts(fx.alerts, fx.now)


@register("g7_avg_cpu_5m")
def g7(fx: Fixture) -> DataFrame:
    return round_doubles(dash.recent_average(fx.raw, "cpu_usage", fx.now))


@register("g8_avg_memory_5m")
def g8(fx: Fixture) -> DataFrame:
    return round_doubles(dash.recent_average(fx.raw, "memory_usage", fx.now))


@register("g9_cpu_memory_trend")
def g9(fx: Fixture) -> DataFrame:
    return round_doubles(dash.metric_trend(fx.raw, ("cpu_usage", "memory_usage")))


@register("g10_packet_loss_trend")
def g10(fx: Fixture) -> DataFrame:
    return round_doubles(dash.metric_trend(fx.raw, ("packet_loss",)))


@register("o2_high_latency_recent")
def o2(fx: Fixture) -> DataFrame:
    return dash.high_latency_recent(fx.raw, fx.now)


@register("g12_alerts_by_region")
def g12(fx: Fixture) -> DataFrame:
    return dash.alerts_by(fx.alerts, "region")


@register("g13_top_devices_by_alerts")
def g13(fx: Fixture) -> DataFrame:
    return dash.alerts_by(fx.alerts, "device_id", limit=10)


@register("w1_severity_share")
def w1(fx: Fixture) -> DataFrame:
    return round_doubles(dash.severity_share(fx.alerts))


@register("q7_kpi_panel")
def q7(fx: Fixture) -> DataFrame:
    return round_doubles(dash.kpi_panel(fx.raw, fx.alerts, fx.now))


@register("f10_anomalies_per_hour")
def f10(fx: Fixture) -> DataFrame:
    return dash.anomaly_counts(fx.raw, unit="hour")


# --- phase 3: daily roll-up ------------------------------------------------


@register("g1_daily_event_stats")
def g1(fx: Fixture) -> DataFrame:
    return round_doubles(rollup.daily_event_stats(fx.raw))


@register("g2_daily_alert_counts")
def g2(fx: Fixture) -> DataFrame:
    return rollup.daily_alert_counts(fx.alerts)


@register("j1_daily_summary")
def j1(fx: Fixture) -> DataFrame:
    return round_doubles(fx.summary())


@register("j1_last_day_summary")
def j1_day(fx: Fixture) -> DataFrame:
    """S7 + F5: the reference's single-day form, ``ds`` bound to the last day."""
    return round_doubles(rollup.daily_summary(fx.raw, fx.alerts, ds=fx.last_day(), computed_at=fx.as_of))


@register("o1_last_day_report_rows")
def o1(fx: Fixture) -> DataFrame:
    rows = rollup.summary_for_day(fx.summary(), fx.last_day())
    return rows.select(
        "device_id", "region", "total_events", "total_alerts",
        "critical_alerts", "high_alerts", "medium_alerts",
    )


@register("k10_upsert_rerun")
def k10(fx: Fixture) -> DataFrame:
    """The last day's roll-up ran once an hour before ``as_of`` (stale), then
    reruns on the full day: the upsert must replace that day's rows and keep
    every other day."""
    cutoff = fx.as_of - F.expr("INTERVAL 1 HOUR")
    day = fx.last_day()
    earlier_days = fx.summary().filter(F.col("summary_date") < day)
    stale = rollup.daily_summary(
        fx.raw.filter(F.col("event_timestamp") <= cutoff),
        fx.alerts.filter(F.col("alert_timestamp") <= cutoff),
        ds=day,
        computed_at=cutoff,
    )
    target = earlier_days.unionByName(stale)
    rerun = rollup.daily_summary(fx.raw, fx.alerts, ds=day, computed_at=fx.as_of)
    return round_doubles(upsert_summary(target, rerun, computed_at=fx.as_of))


@register("g14_day_totals")
def g14(fx: Fixture) -> DataFrame:
    return rollup.day_totals(fx.summary())


@register("k14_report_lines")
def k14(fx: Fixture) -> DataFrame:
    return report.report_lines(fx.summary())


# --- phase 4: quality ------------------------------------------------------


def _tables(fx: Fixture) -> dict[str, DataFrame]:
    stamp = fx.as_of
    return {
        "raw_network_events": fx.raw,
        "processed_network_events": with_defaults(fx.processed(), {"processed_at": stamp}),
        "alerts": with_defaults(fx.alerts, {"created_at": stamp}),
        "daily_monitoring_summary": fx.summary(),
    }


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("q2_key_uniqueness")
def q2(fx: Fixture) -> DataFrame:
    return _union([quality.key_report(t, df, PRIMARY_KEYS[t]) for t, df in _tables(fx).items()])


@register("q3_required_columns")
def q3(fx: Fixture) -> DataFrame:
    return _union([quality.null_report(t, df, REQUIRED_COLUMNS[t]) for t, df in _tables(fx).items()])


@register("q4_string_widths")
def q4(fx: Fixture) -> DataFrame:
    return _union([quality.width_report(t, df, STRING_WIDTHS[t]) for t, df in _tables(fx).items()])


@register("j2_device_foreign_keys")
def j2(fx: Fixture) -> DataFrame:
    devices = seed_devices(fx.spark)
    return _union(
        [quality.fk_report(t, df, devices, known_small=True) for t, df in _tables(fx).items()]
    )


@register("j3_processed_vs_raw")
def j3(fx: Fixture) -> DataFrame:
    return quality.reconcile(fx.processed(), fx.raw)


@register("g15_freshness")
def g15(fx: Fixture) -> DataFrame:
    return quality.freshness(fx.raw, fx.now)


@register("k9_unique_append")
def k9(fx: Fixture) -> DataFrame:
    """A full replay with at-least-once delivery: every event arrives twice,
    while the target already holds every day before the last.  Only the
    last day's rows, once each, may be appended."""
    raw = fx.raw.select(*RAW_EVENT_COLUMNS)
    batch = raw.unionByName(raw)
    target = raw.filter(F.col("event_timestamp") < fx.last_day().cast("timestamp_ntz"))
    return unique_append(batch, target, ["event_id"])


@register("g15_freshness_stale")
def g15_stale(fx: Fixture) -> DataFrame:
    """Two hours after the last arrival."""
    return quality.freshness(fx.raw, fx.as_of + F.expr("INTERVAL 2 HOURS"))


@register("a6_two_cpu_rules")
def a6(fx: Fixture) -> DataFrame:
    """Two rules of one alert type raise alerts of different ids."""
    return detect_alerts(fx.enriched, rules=[CPU_HIGH, dataclasses.replace(CPU_HIGH, above=95.0, rule_id="CPU_HIGH_95")])


# --- faulty rows: the checks on tables that break every constraint ---------


def _faulty_raw(fx: Fixture) -> DataFrame:
    """The raw table with faults by ``k``: 10 — the row twice; 11 — no region;
    12 — a device id of 23 characters; 13 — a device that does not exist."""
    k = F.col("fixture_k")
    rows = fx.marked.withColumn("region", F.when(k.eqNullSafe(11), None).otherwise(F.col("region"))).withColumn(
        "device_id",
        F.when(k == 12, F.concat(F.rpad("device_id", 12, "-"), F.lit("-overlong-id")))
        .when(k == 13, F.lit("GHOST-1"))
        .otherwise(F.col("device_id")),
    )
    return rows.unionByName(rows.where(k == 10))


@register("q2_faulty_keys")
def q2_faulty(fx: Fixture) -> DataFrame:
    return quality.key_report("raw_network_events", _faulty_raw(fx), PRIMARY_KEYS["raw_network_events"])


@register("q3_faulty_nulls")
def q3_faulty(fx: Fixture) -> DataFrame:
    return quality.null_report("raw_network_events", _faulty_raw(fx), REQUIRED_COLUMNS["raw_network_events"])


@register("q4_faulty_widths")
def q4_faulty(fx: Fixture) -> DataFrame:
    return quality.width_report("raw_network_events", _faulty_raw(fx), STRING_WIDTHS["raw_network_events"])


@register("q6_faulty_rejects")
def q6_faulty(fx: Fixture) -> DataFrame:
    """Faulty rows that the quarantine must hold back."""
    return _faulty_raw(fx).where(is_rejected()).groupBy("fixture_k").agg(F.count(F.lit(1)).alias("rejected"))


@register("j2_faulty_devices")
def j2_faulty(fx: Fixture) -> DataFrame:
    return quality.fk_report("raw_network_events", _faulty_raw(fx), seed_devices(fx.spark), known_small=True)


@register("j3_faulty_reconcile")
def j3_faulty(fx: Fixture) -> DataFrame:
    """Processed lacks the events of ``k`` = 14, raw those of 15."""
    k = F.col("fixture_k")
    return quality.reconcile(enrich(fx.marked).where(~k.eqNullSafe(14)), fx.marked.where(~k.eqNullSafe(15)))


# --- phase 5: streaming (stream = batch) -----------------------------------


def _kafka_files(fx: Fixture) -> str:
    """The Kafka-shaped frame of ``events`` written as Parquet files under the
    shared checkpoint folder, range-split by offset so the stream sees
    several micro-batches."""
    path = scratch_path(fx.spark, "kafka-frame")
    n = 2 * fx.spark.sparkContext.defaultParallelism
    kafka_frame_from_events(fx.events).repartitionByRange(n, "offset").write.parquet(path)
    return path


def _instants(df: DataFrame) -> DataFrame:
    """Stored tables hold instants; the fixture's times have no zone (UTC)."""
    times = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in times})


def _plain_times(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _warehouse(fx: Fixture) -> Warehouse:
    return Warehouse(fx.spark, scratch_path(fx.spark, "warehouse"))


def _run_stream(fx: Fixture, which: str, wh: Warehouse | None = None, files: str | None = None,
                checkpoint: str = "") -> Warehouse:
    # one file per core per trigger: two micro-batches, each using every core
    source = kafka_files_stream(
        fx.spark, files or _kafka_files(fx), max_files_per_trigger=fx.spark.sparkContext.defaultParallelism
    )
    wh = wh or _warehouse(fx)
    start = start_ingestion if which == "ingestion" else start_alerting
    q = start(source, wh, stream_checkpoint(wh.root, which + checkpoint), trigger={"availableNow": True},
              name=f"{which}{checkpoint}_{id(wh)}")
    run_available(q)
    return wh


def _stored(fx: Fixture) -> tuple[Warehouse, dt.datetime]:
    """A warehouse holding the fixture's events and alerts, and its "now"."""
    wh = _warehouse(fx)
    now = fx.raw.agg(F.max(F.col("event_timestamp").cast("timestamp")).cast("string")).first()[0]
    wh.append_unique("raw_network_events", _instants(fx.raw.select(*RAW_EVENT_COLUMNS, "ingested_at")))
    append_alerts(wh, _instants(fx.alerts))
    return wh, dt.datetime.fromisoformat(now)


@register("t4_stream_raw_events")
def t4_raw(fx: Fixture) -> DataFrame:
    wh = _run_stream(fx, "ingestion")
    raw = wh.read("raw_network_events").select(*RAW_EVENT_COLUMNS)
    return raw.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@register("t5_stream_alerts_by_severity")
def t5(fx: Fixture) -> DataFrame:
    wh = _run_stream(fx, "alerting")
    return dash.alerts_by(wh.read("alerts"), "severity")


@register("k9_tables_after_redelivery")
def k9_tables(fx: Fixture) -> DataFrame:
    """Both streams run, then run again over the same messages from checkpoints
    of their own: every table must hold each key once."""
    wh, files = _warehouse(fx), _kafka_files(fx)
    for checkpoint in ("", "_again"):
        for which in ("ingestion", "alerting"):
            _run_stream(fx, which, wh, files, checkpoint)
    names = ("bronze", "raw_network_events", "processed_network_events", "rejects", "silver_alerts", "alerts")
    return _union([quality.key_report(t, wh.read(t), wh.spec(t).key) for t in names])


@register("k7_stream_processed_events")
def k7(fx: Fixture) -> DataFrame:
    rows = _run_stream(fx, "ingestion").read("processed_network_events").select(*PROCESSED_EVENT_COLUMNS)
    return round_doubles(_plain_times(rows))


@register("k3_stream_silver_alerts")
def k3(fx: Fixture) -> DataFrame:
    return _plain_times(_run_stream(fx, "alerting").read("silver_alerts").select(*ALERT_COLUMNS))


@register("g11_rollup_panels")
def g11_rollup(fx: Fixture) -> DataFrame:
    """All-time panels while the roll-up covers some days only: older days
    predate it, and one covered day has got late alerts since."""
    wh = _warehouse(fx)
    alerts = _instants(fx.alerts)
    late = F.crc32(F.col("event_id").cast("binary")) % 7 == 0
    append_alerts(wh, alerts.where(~late))
    days = wh.days("alerts")
    wh.roll_up("alert_counts", days[len(days) // 2])
    append_alerts(wh, alerts.where(late & (F.to_date("alert_timestamp") == F.lit(days[max(len(days) - 2, 0)]).cast("date"))))
    append_alerts(wh, alerts)
    wh.roll_up("alert_counts", days[-1])
    append_alerts(wh, alerts)  # delivered again: nothing new
    counts = wh.counts("alert_counts")
    panels_ = [
        dash.alerts_by_rollup(counts, key).select(F.lit(key).alias("panel"), F.col(key).alias("value"), "count")
        for key in ("severity", "region", "device_id")
    ]
    return _union(panels_)


@register("q7_kpi_row_stored")
def q7_stored(fx: Fixture) -> DataFrame:
    wh, now = _stored(fx)
    return round_doubles(dashboard.kpi_row(fx.spark, dashboard.panels(fx.spark, wh.root, now)))


@register("g9_trend_last_hour")
def g9_hour(fx: Fixture) -> DataFrame:
    """the panel's default range, from the stored table."""
    wh, now = _stored(fx)
    return round_doubles(_plain_times(dashboard.panels(fx.spark, wh.root, now)["cpu_memory_trend"]))


@register("o2_high_latency_bands")
def o2_bands(fx: Fixture) -> DataFrame:
    """Q7 on the high-latency panel, from the stored table."""
    wh, now = _stored(fx)
    return _plain_times(dashboard.panels(fx.spark, wh.root, now)["high_latency_1h"])


@register("s5_stored_summary")
def s5(fx: Fixture) -> DataFrame:
    """The stored summary after a backfill that ran twice."""
    wh, _ = _stored(fx)
    first, last = (wh.days("raw_network_events")[k] for k in (0, -1))
    for _ in range(2):
        run_range(fx.spark, wh.root, first, last)
    return round_doubles(wh.read("daily_monitoring_summary").drop("computed_at"))


@register("s6_stored_devices")
def s6(fx: Fixture) -> DataFrame:
    """The device dimension, first and last seen, when some devices are new."""
    wh = _warehouse(fx)
    rows = _instants(_faulty_raw(fx).select(*RAW_EVENT_COLUMNS))
    wh.append_unique("raw_network_events", rows.withColumn("ingested_at", F.col("event_timestamp")))
    for _ in range(2):
        update_devices(wh)
    return _plain_times(read_devices(wh))


@register("k15_report_with_empty_day")
def k15(fx: Fixture) -> DataFrame:
    """Reports of the last day and of the day after it, which has no data."""
    day = fx.raw.select(F.to_date(F.max("event_timestamp")).alias("d"))
    days = day.select(F.explode(F.array("d", F.date_add("d", 1))).alias("summary_date"))
    summary = fx.summary()
    return report.report_lines(summary.join(days, "summary_date", "left_semi"), days)


@register("q8_last_not_null")
def q8(fx: Fixture) -> DataFrame:
    """The latest non-null CPU value of each device."""
    order = F.struct("event_timestamp", "event_id")
    return fx.raw.groupBy("device_id").agg(last_not_null(F.col("cpu_usage"), order).alias("value"))


# --- phase 6: histories, gates, versions -------------------------------------


def _resent(frame: DataFrame, shift: int, **changes: Column) -> DataFrame:
    """Well-formed messages once more, at later offsets, with changed fields."""
    parsed = frame.withColumn("d", F.from_json(F.col("value").cast("string"), EVENT_WIRE_SCHEMA)).where("d.event_id IS NOT NULL")
    value = F.to_json(F.struct(*[changes.get(f.name, F.col(f"d.{f.name}")).alias(f.name) for f in EVENT_WIRE_SCHEMA]))
    return parsed.withColumns({"value": value.cast("binary"), "offset": F.col("offset") + shift}).select(*KAFKA_SCHEMA.names)


def _append_messages(messages: DataFrame, files: str) -> None:
    """More files of the stream, one per core: one trigger takes them all.  The
    messages made from one event share a file, so no trigger comes between them."""
    n = messages.sparkSession.sparkContext.defaultParallelism
    messages.repartition(n, F.col("offset") % 10**9).write.mode("append").parquet(files)


@register("k9_one_version_per_id")
def k9_one_version(fx: Fixture) -> DataFrame:
    """Every fifth event comes again later with another payload and on another
    day, and every seventh under a new id twice, with two payloads.  All tables
    hold the first version of each id, and only that."""
    wh, files = _warehouse(fx), _kafka_files(fx)
    for which in ("ingestion", "alerting"):
        _run_stream(fx, which, wh, files)
    EventRegistry(fx.spark, wh.root).fold()
    frame = kafka_frame_from_events(fx.events)
    other = {"timestamp": F.lit("2031-05-05T05:05:05.000Z"), "cpu_usage": F.lit(99.5), "latency_ms": F.lit(1.0), "status": F.lit("UP")}
    fifth, seventh = frame.where("offset % 5 = 0"), frame.where("offset % 7 = 0")
    new_id = F.concat(F.lit("n-"), F.col("d.event_id"))
    later = _resent(fifth, 10**9, **other).unionByName(_resent(fifth, 2 * 10**9, **other))
    later = later.unionByName(_resent(seventh, 3 * 10**9, event_id=new_id)).unionByName(_resent(seventh, 4 * 10**9, event_id=new_id, **other))
    _append_messages(later, files)
    for which in ("ingestion", "alerting"):
        _run_stream(fx, which, wh, files)
    cpu = F.coalesce(F.when(F.col("cpu_usage").isNotNull(), F.format_string("%.2f", "cpu_usage")), F.lit("null"))
    detail = {"raw_network_events": cpu, "processed_network_events": F.col("health_status"),
              "alerts": F.col("alert_type"), "silver_alerts": F.col("alert_type")}
    rows = [
        wh.read(t).select(
            F.lit(t).alias("table_name"), "event_id",
            F.col("alert_timestamp" if "alert" in t else "event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
            c.alias("detail"),
        )
        for t, c in detail.items()
    ]
    return _union(rows)


@register("g15_arrivals")
def g15_arrivals(fx: Fixture) -> DataFrame:
    """The gate over the table of arrivals of a bulk load."""
    wh, now = _stored(fx)
    return health.freshness_status(fx.spark, wh.root, now)


@register("k11_register_devices")
def k11_register(fx: Fixture) -> DataFrame:
    """Devices offered twice over: known ones stay, new ones come in once."""
    wh = _warehouse(fx)
    offered = fx.raw.select("device_id", "device_type", F.lit("Elsewhere").alias("region")).unionByName(
        fx.raw.select(F.concat(F.lit("NEW-"), "device_id").alias("device_id"), "device_type", "region")
    )
    for _ in range(2):
        register_devices(wh, offered)
    return read_devices(wh).drop("first_seen_at", "last_seen_at")


@register("j2_device_gate")
def j2_gate(fx: Fixture) -> DataFrame:
    """Every eleventh event names a device that the dimension lacks: such events
    are held.  One of the two devices then appears, and its events come in."""
    wh, path = _warehouse(fx), scratch_path(fx.spark, "kafka-frame")
    frame, gone = kafka_frame_from_events(fx.events), F.col("offset") % 11 == 0
    ghost = F.concat(F.lit("GHOST-"), (F.col("offset") % 2).cast("string"))
    _resent(frame.where(gone), 0, device_id=ghost).unionByName(frame.where(~gone)).write.parquet(path)
    for which, start in (("ingestion", start_ingestion), ("alerting", start_alerting)):
        source = kafka_files_stream(fx.spark, path)
        run_available(start(source, wh, stream_checkpoint(wh.root, which), trigger={"availableNow": True},
                            name=f"gated_{which}_{id(wh)}", require_known_devices=True))

    def tables(stage: str) -> DataFrame:
        names = ("raw_network_events", "processed_network_events", "alerts")
        frames = [wh.read(t).select(F.lit(t).alias("table_name"), "device_id") for t in names]
        rows = _union([*frames, held_events(wh).select(F.lit("held_events").alias("table_name"), "device_id")])
        return rows.groupBy(F.lit(stage).alias("stage"), "table_name", "device_id").agg(F.count(F.lit(1)).alias("rows"))

    before = scratch_path(fx.spark, "gate-before")
    tables("before").write.parquet(before)
    register_devices(wh, fx.spark.createDataFrame([("GHOST-0", "router", "Cairo")], "device_id STRING, device_type STRING, region STRING"))
    for _ in range(2):
        readmit(wh)
    return fx.spark.read.parquet(before).unionByName(tables("after"))


@register("j3_differing_days")
def j3_days(fx: Fixture) -> DataFrame:
    """On even days processed lacks the events of ``k`` = 14 and raw those of 15;
    the other days agree and are not read."""
    wh, k = _warehouse(fx), F.col("fixture_k")
    even = F.day("event_timestamp") % 2 == 0
    wh.append("raw_network_events", _instants(fx.marked.where(~(k.eqNullSafe(15) & even)).select(*RAW_EVENT_COLUMNS, "ingested_at")))
    processed = enrich(fx.marked).where(~(k.eqNullSafe(14) & even)).select(*PROCESSED_EVENT_COLUMNS, F.col("ingested_at").alias("processed_at"))
    wh.append("processed_network_events", _instants(processed))
    for name in ("raw_digests", "processed_digests"):
        wh.roll_up(name)
    return health.reconcile_tables(wh)


@register("q6_reject_reasons")
def q6_reasons(fx: Fixture) -> DataFrame:
    """Rejects by reason, and what bronze keeps of fields of a wrong type."""
    wh, path, o = _warehouse(fx), scratch_path(fx.spark, "kafka-frame"), F.col("offset")
    text = F.col("value").cast("string")
    text = F.when(o % 13 == 0, F.regexp_replace(text, '"region":"[^"]*",', "")).otherwise(text)
    text = F.when(o % 17 == 0, F.regexp_replace(text, '"device_id":"', '"device_id":"much-too-long-a-name-')).otherwise(text)
    text = F.when(o % 19 == 0, F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"soon"')).otherwise(text)
    text = F.when(o % 23 == 0, F.regexp_replace(text, '"temperature":[0-9.]+', '"temperature":"hot","fan":7')).otherwise(text)
    kafka_frame_from_events(fx.events).withColumn("value", text.cast("binary")).write.parquet(path)
    source = kafka_files_stream(fx.spark, path)
    run_available(start_ingestion(source, wh, stream_checkpoint(wh.root, "ingestion"), trigger={"availableNow": True}, name=f"reasons_{id(wh)}"))
    rejected = wh.read("rejects").select(F.explode("reasons").alias("reason"))
    fan = F.try_variant_get("payload", "$.fan", "int") == 7
    hot = F.col("temperature").isNull() & (F.try_variant_get("payload", "$.temperature", "string") == "hot") & fan
    kept = wh.read("bronze").where(hot).select(F.lit("kept in bronze").alias("reason"))
    return rejected.unionByName(kept).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@register("t1_processing_time_trigger")
def t1_trigger(fx: Fixture) -> DataFrame:
    """The ingestion job under a processing-time trigger, stopped when it has
    caught up, then started again: the second run finds nothing to do."""
    wh, files = _warehouse(fx), _kafka_files(fx)
    for k in range(2):
        source = kafka_files_stream(fx.spark, files, max_files_per_trigger=fx.spark.sparkContext.defaultParallelism)
        query = start_ingestion(source, wh, stream_checkpoint(wh.root, "ingestion"), trigger={"processingTime": "1 second"},
                                name=f"timed_{k}_{id(wh)}")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return _plain_times(wh.read("raw_network_events").select(*RAW_EVENT_COLUMNS))


@register("t6_stream_history")
def t6_history(fx: Fixture) -> DataFrame:
    """The history after one stream that ended well and one that failed."""
    root, files, listener = scratch_path(fx.spark, "history"), _kafka_files(fx), attach_listener(fx.spark)

    def broken(batch: DataFrame, batch_id: int) -> None:
        raise ValueError("the sink is down")

    try:
        for name, sink in (("good", None), ("bad", broken)):
            writer = kafka_files_stream(fx.spark, files).writeStream.queryName(f"{name}_{id(fx)}").trigger(availableNow=True)
            writer = writer.option("checkpointLocation", f"{root}/{name}")
            query = (writer.format("noop") if sink is None else writer.foreachBatch(sink)).start()
            with contextlib.suppress(StreamingQueryException):
                query.awaitTermination()
        until = time.monotonic() + 30
        while time.monotonic() < until and sum(s.get("state") in ("stopped", "failed") for s in listener.snapshot().values()) < 2:
            time.sleep(0.2)  # reports arrive after the queries' ends
    finally:
        fx.spark.streams.removeListener(listener)
    append_history(fx.spark, listener, root)
    history = read_history(fx.spark, root).withColumn("query", F.substring_index("query_name", "_", 1))
    return history.groupBy("query").agg(
        F.max(F.when(F.col("kind").isin("stopped", "failed"), F.col("kind"))).alias("ended"),
        F.count_if(F.col("kind") == "started").alias("starts"),
        F.coalesce(F.sum(F.when(F.col("kind") == "progress", F.col("input_rows"))), F.lit(0).cast("bigint")).alias("input_rows"),
        F.coalesce(F.max(F.col("exception").contains("the sink is down")), F.lit(False)).alias("reason_kept"),
    )
