"""Daily per-device roll-up.

The reference computes four correlated COUNT subqueries per device; Spark
rejects that form.  Here it is one conditional aggregate over the alerts and
one aggregate over the events, both grouped by (summary_date, device_id),
then a left join on that same key.  Both aggregates are already
hash-partitioned on the join key, so the join adds no shuffle of its own,
and each side is at most one row per device-day — raw volume and a hot
device only affect the partial (map-side) aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telewatch.functions.timecols import as_date, day_of, now, on_day

AVG_METRICS = (
    ("avg_cpu_usage", "cpu_usage"),
    ("avg_memory_usage", "memory_usage"),
    ("avg_bandwidth_mbps", "bandwidth_mbps"),
    ("avg_latency_ms", "latency_ms"),
    ("avg_packet_loss", "packet_loss"),
)
ALERT_COUNT_COLUMNS = ("total_alerts", "critical_alerts", "high_alerts", "medium_alerts")


def _days(df: DataFrame, ts_col: str, ds, date_col: str) -> tuple[DataFrame, Column]:
    """Restrict to day ``ds`` (None: every day) and give the day column."""
    if ds is None:
        return df, day_of(F.col(ts_col))
    return on_day(df, ts_col, ds, date_col), as_date(ds)


def daily_event_stats(events: DataFrame, ds=None) -> DataFrame:
    """G1: per device and day — MAX(type), MAX(region), COUNT(*), 5×AVG.
    AVG skips NULL metrics; COUNT(*) counts every reading.

    Two levels: string MAX has no fixed-width buffer, so in one aggregate it
    would force a sort-based aggregate over every raw reading.  Instead the
    raw rows go through a hash aggregate keyed by (day, device, type,
    region) — counts and sums only, combined map-side — and the MAX runs on
    that result, which has about one row per device-day.
    """
    df, day = _days(events, "event_timestamp", ds, "event_date")
    partial = df.groupBy(day.alias("summary_date"), "device_id", "device_type", "region").agg(
        F.count(F.lit(1)).alias("_n"),
        *[agg for _, src in AVG_METRICS
          for agg in (F.sum(src).alias(f"_s_{src}"), F.count(src).alias(f"_c_{src}"))],
    )
    return partial.groupBy("summary_date", "device_id").agg(
        F.max("device_type").alias("device_type"),
        F.max("region").alias("region"),
        F.sum("_n").alias("total_events"),
        *[
            F.when(F.sum(f"_c_{src}") > 0, F.sum(f"_s_{src}") / F.sum(f"_c_{src}")).alias(name)
            for name, src in AVG_METRICS
        ],
    )


def daily_alert_counts(alerts: DataFrame, ds=None) -> DataFrame:
    """G2 + F6: per device and day — total alerts and counts by severity, one
    pass (replaces four scans)."""
    df, day = _days(alerts, "alert_timestamp", ds, "alert_date")
    sev = F.col("severity")
    return df.groupBy(day.alias("summary_date"), "device_id").agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(sev == F.lit("CRITICAL")).alias("critical_alerts"),
        F.count_if(sev == F.lit("HIGH")).alias("high_alerts"),
        F.count_if(sev == F.lit("MEDIUM")).alias("medium_alerts"),
    )


def daily_alert_counts_from_rollup(rollup: DataFrame, ds=None) -> DataFrame:
    """G2 from the ``alert_counts`` roll-up (counts per day, device, region and
    severity): the same rows as ``daily_alert_counts``
    over the alerts, from a table a few rows per device instead of one row
    per alert."""
    df = rollup if ds is None else rollup.filter(F.col("alert_date") == as_date(ds))
    sev, n = F.col("severity"), F.col("alerts")
    zero = F.lit(0).cast("bigint")
    return df.groupBy(F.col("alert_date").alias("summary_date"), "device_id").agg(
        F.sum(n).alias("total_alerts"),
        *[
            F.sum(F.when(sev == F.lit(level), n).otherwise(zero)).alias(f"{level.lower()}_alerts")
            for level in ("CRITICAL", "HIGH", "MEDIUM")
        ],
    )


def daily_summary(events: DataFrame, alerts: DataFrame | None, ds=None, computed_at: Column | None = None,
                  alert_counts: DataFrame | None = None) -> DataFrame:
    """J1 + P16: the daily_monitoring_summary rows for day ``ds`` (every day
    when None).  Only device-days with events get a row; alert counts of
    device-days without alerts are 0.  ``alert_counts`` (the output of
    ``daily_alert_counts[_from_rollup]``) replaces ``alerts`` when given."""
    stats = daily_event_stats(events, ds)
    counts = daily_alert_counts(alerts, ds) if alert_counts is None else alert_counts
    joined = stats.join(counts, ["summary_date", "device_id"], "left")
    return joined.select(
        "summary_date",
        "device_id",
        "device_type",
        "region",
        "total_events",
        *[name for name, _ in AVG_METRICS],
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ALERT_COUNT_COLUMNS],
        (now() if computed_at is None else computed_at).alias("computed_at"),
    )


def day_totals(summary: DataFrame) -> DataFrame:
    """Per day, devices reporting, events and alerts summed over devices."""
    return summary.groupBy("summary_date").agg(
        F.count(F.lit(1)).alias("devices"),
        F.sum("total_events").alias("total_events"),
        F.sum("total_alerts").alias("total_alerts"),
    )


def summary_for_day(summary: DataFrame, ds) -> DataFrame:
    """S5 + F9 + O1: one day's rows, by total alerts descending (device id
    breaks ties).  On a date-partitioned table the filter prunes to one
    partition."""
    return summary.filter(F.col("summary_date") == as_date(ds)).orderBy(
        F.col("total_alerts").desc(), F.col("device_id")
    )
