"""Enrichment columns (P5, P6): bandwidth utilisation and health status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Assumed link capacity of every device, in Mbps.
LINK_CAPACITY_MBPS = 1000.0

# Soft ("warning") thresholds, all strict greater-than.
WARNING_THRESHOLDS = (
    ("cpu_usage", 80.0),
    ("memory_usage", 80.0),
    ("packet_loss", 3.0),
    ("latency_ms", 150.0),
    ("bandwidth_utilization_pct", 85.0),
)


def bandwidth_pct(mbps: Column | None = None) -> Column:
    """P5: divide by capacity, then scale by 100 — this order, for bit
    equality with the reference's stored values."""
    mbps = F.col("bandwidth_mbps") if mbps is None else mbps
    return (mbps / F.lit(LINK_CAPACITY_MBPS)) * F.lit(100)


def any_warning(thresholds=WARNING_THRESHOLDS, columns: dict[str, Column] | None = None) -> Column:
    """three-valued OR of the soft breaches (NULL metrics stay NULL).
    ``columns`` substitutes expressions for column names."""
    cond = None
    for column, limit in thresholds:
        value = (columns or {}).get(column, F.col(column))
        term = value > F.lit(limit)
        cond = term if cond is None else (cond | term)
    return cond


def health_status(thresholds=WARNING_THRESHOLDS, columns: dict[str, Column] | None = None) -> Column:
    """DOWN → CRITICAL, else any soft breach → WARNING, else HEALTHY.
    A NULL breach test falls through to HEALTHY, as in the reference."""
    return (
        F.when(F.col("status") == F.lit("DOWN"), F.lit("CRITICAL"))
        .when(any_warning(thresholds, columns), F.lit("WARNING"))
        .otherwise(F.lit("HEALTHY"))
    )


def with_bandwidth_pct(df: DataFrame) -> DataFrame:
    if "bandwidth_utilization_pct" in df.columns:
        return df
    return df.withColumn("bandwidth_utilization_pct", bandwidth_pct())


def enrich(df: DataFrame) -> DataFrame:
    """Add ``bandwidth_utilization_pct`` and ``health_status`` in one Project."""
    pct = F.col("bandwidth_utilization_pct") if "bandwidth_utilization_pct" in df.columns else bandwidth_pct()
    return df.withColumns(
        {
            "bandwidth_utilization_pct": pct,
            "health_status": health_status(columns={"bandwidth_utilization_pct": pct}),
        }
    )
