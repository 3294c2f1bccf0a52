"""Dashboard queries (G3–G13, F4, F7, F8, O2–O5, W1, Q7) and the simulator's
per-cycle counters re-aimed as batch metrics (F10, G16).

Each function takes the telemetry (``events``) and/or ``alerts`` DataFrame and
an ``as_of`` Column for "now" (``current_timestamp()`` in production, the
data's latest event time in tests).  All aggregates are partial + final hash
aggregates: a hot device or minute is pre-combined map-side before the
shuffle, so skew does not concentrate rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telewatch.functions.bands import band
from telewatch.functions.rules import anomalous_reading
from telewatch.functions.timecols import Latest, between, bucket, now, since

AsOf = Column | Latest | None


def _as_of(as_of: AsOf) -> Column | Latest:
    return now() if as_of is None else as_of


def total_events(events: DataFrame) -> DataFrame:
    """``SELECT COUNT(*) AS value FROM raw_network_events``."""
    return events.select(F.count(F.lit(1)).alias("value"))


def active_devices(events: DataFrame, as_of: AsOf = None, window: str = "5 MINUTES") -> DataFrame:
    """Distinct devices reporting in the last 5 minutes (partial distinct
    per task, then a shuffle of the distinct ids only)."""
    recent = events.filter(since(F.col("event_timestamp"), _as_of(as_of), window))
    return recent.select(F.count_distinct("device_id").alias("value"))


def device_failures(events: DataFrame, as_of: AsOf = None, window: str = "1 HOUR") -> DataFrame:
    """DOWN readings (not devices) in the last hour."""
    recent = events.filter(
        (F.col("status") == F.lit("DOWN")) & since(F.col("event_timestamp"), _as_of(as_of), window)
    )
    return recent.select(F.count(F.lit(1)).alias("value"))


def recent_alerts(alerts: DataFrame, as_of: AsOf = None, window: str = "24 HOURS") -> DataFrame:
    """Alerts in the last 24 hours."""
    recent = alerts.filter(since(F.col("alert_timestamp"), _as_of(as_of), window))
    return recent.select(F.count(F.lit(1)).alias("value"))


def recent_average(events: DataFrame, metric: str, as_of: AsOf = None,
                   window: str = "5 MINUTES") -> DataFrame:
    """Average of a metric over the last 5 minutes (NULL if none)."""
    recent = events.filter(since(F.col("event_timestamp"), _as_of(as_of), window))
    return recent.select(F.avg(metric).alias("value"))


def metric_trend(events: DataFrame, metrics: tuple[str, ...], start=None, end=None,
                 unit: str = "minute") -> DataFrame:
    """G9 / G10 (+P18, F7, O5): per-bucket averages within the panel range,
    ordered by bucket.  ``start``/``end`` None leaves that side open."""
    cond = between(F.col("event_timestamp"), start, end)
    df = events if cond is None else events.filter(cond)
    return (
        df.groupBy(bucket(df, "event_timestamp", unit).alias("time"))
        .agg(*[F.avg(m).alias(m) for m in metrics])
        .orderBy("time")
    )


def high_latency_recent(events: DataFrame, as_of: AsOf = None, threshold: float = 200.0,
                        window: str = "1 HOUR", limit: int = 50) -> DataFrame:
    """O2 + F8: the latest ``limit`` readings above ``threshold`` ms in the
    last hour.  Top-k by (time desc, event_id) → TakeOrderedAndProject, a
    per-task top-k merged on one task: no full sort, bounded memory."""
    df = events.filter(
        (F.col("latency_ms") > F.lit(threshold))
        & since(F.col("event_timestamp"), _as_of(as_of), window)
    )
    return (
        df.select("event_id", "device_id", "device_type", "region", "latency_ms", "event_timestamp")
        .orderBy(F.col("event_timestamp").desc(), F.col("event_id"))
        .limit(limit)
    )


def alerts_by(alerts: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """G11 / G12 / G13 + O3 / O4: alert count per ``key``, by count
    descending with ``key`` as tie-breaker; ``limit`` for the top-k panel."""
    out = (
        alerts.groupBy(key)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(key))
    )
    return out if limit is None else out.limit(limit)


def alert_count_partials(alerts: DataFrame) -> DataFrame:
    """Alerts → counts per (day, device, region, severity): the rows of the
    ``alert_counts`` roll-up."""
    return alerts.groupBy(
        F.to_date("alert_timestamp").alias("alert_date"), "device_id", "region", "severity"
    ).agg(F.count(F.lit(1)).alias("alerts"))


def total_events_rollup(counts: DataFrame) -> DataFrame:
    """G3 from per-day event counts."""
    return counts.select(F.coalesce(F.sum("events"), F.lit(0).cast("bigint")).alias("value"))


def latency_bands(readings: DataFrame) -> DataFrame:
    """Q7 on the high-latency panel: each reading with its colour band."""
    return readings.withColumn("latency_band", band(F.col("latency_ms"), "latency_ms"))


def alerts_by_rollup(counts: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """G11–G13 from the ``alert_counts`` roll-up: the same result as
    ``alerts_by`` over the alerts, summing partial counts instead of
    counting rows (the roll-up has about one row per device, day and severity,
    whatever the alert volume)."""
    out = (
        counts.groupBy(key)
        .agg(F.sum("alerts").alias("count"))
        .orderBy(F.col("count").desc(), F.col(key))
    )
    return out if limit is None else out.limit(limit)


def severity_share(alerts: DataFrame) -> DataFrame:
    """Count and percent of total per severity.  The window has no
    partition, but it runs over the 3-row aggregate, not over alerts."""
    counts = alerts.groupBy("severity").agg(F.count(F.lit(1)).alias("count"))
    return _share(counts)


def severity_share_rollup(counts: DataFrame) -> DataFrame:
    """W1 from the ``alert_counts`` roll-up."""
    return _share(counts.groupBy("severity").agg(F.sum("alerts").alias("count")))


def _share(counts: DataFrame) -> DataFrame:
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(
        "severity", "count", (F.col("count") * F.lit(100.0) / total).alias("percent")
    ).orderBy(F.col("count").desc(), F.col("severity"))


def kpi_panel(events: DataFrame, alerts: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Q7: every stat/gauge panel value with its colour band, in one row.

    One conditional-aggregate pass over the telemetry; the alert count joins
    it as a scalar subquery (one value, computed once), so no join is needed.
    """
    t = _as_of(as_of)
    ts = F.col("event_timestamp")
    last5 = since(ts, t, "5 MINUTES")
    last1h = since(ts, t, "1 HOUR")
    alerts_24h = alerts.select(
        F.count_if(since(F.col("alert_timestamp"), t, "24 HOURS"))
    ).scalar()
    row = events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct(F.when(last5, F.col("device_id"))).alias("active_devices"),
        F.count_if((F.col("status") == F.lit("DOWN")) & last1h).alias("device_failures"),
        F.avg(F.when(last5, F.col("cpu_usage"))).alias("avg_cpu"),
        F.avg(F.when(last5, F.col("memory_usage"))).alias("avg_memory"),
    ).select("*", alerts_24h.alias("alerts_24h"))
    kpis = ("total_events", "active_devices", "device_failures", "alerts_24h", "avg_cpu", "avg_memory")
    return row.select(*kpis, *[band(F.col(k), k).alias(f"{k}_band") for k in kpis])


def anomaly_counts(events: DataFrame, unit: str = "hour") -> DataFrame:
    """F10 + G16: per time bucket, readings sent and readings the simulator's
    own predicate calls anomalous (its per-cycle log line, as a table)."""
    return (
        events.groupBy(bucket(events, "event_timestamp", unit).alias("time"))
        .agg(
            F.count(F.lit(1)).alias("events_sent"),
            F.count_if(anomalous_reading()).alias("anomalous_readings"),
        )
        .orderBy("time")
    )
