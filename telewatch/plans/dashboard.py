"""Dashboard panels over the warehouse tables.

The reference's dashboard re-issues its SQL every 10 seconds.  Here every
recency panel reads only the date partitions its window can touch, from the
window's first day on, so a panel over "the last 5 minutes" lists and scans the
newest day or two however long the history is.  As in the reference, a window
has no upper bound: readings ahead of the clock count.  The all-time panels sum
the per-day roll-ups and count only days without one from the tables
themselves.  Times are instants; naive ones are UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.functions.bands import band
from telewatch.functions.timecols import instant, utc
from telewatch.operators import dashboard as dash
from telewatch.session import configure
from telewatch.sources.tables import Warehouse

WINDOWS = {"5 MINUTES": dt.timedelta(minutes=5), "1 HOUR": dt.timedelta(hours=1),
           "24 HOURS": dt.timedelta(hours=24)}


def _recent(wh: Warehouse, table: str, as_of: dt.datetime, window: str) -> DataFrame:
    return wh.read(table, (as_of - WINDOWS[window]).date())


def panels(spark: SparkSession, root: str, as_of: dt.datetime | None = None,
           start: dt.datetime | None = None, end: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Every panel as a DataFrame.  ``as_of`` defaults to now;
    ``start``/``end`` is the panel time range of the trend charts (default:
    the last hour, as the dashboard's default range)."""
    configure(spark)
    wh = Warehouse(spark, root)
    as_of = utc(as_of or dt.datetime.now(dt.timezone.utc))
    t = instant(as_of)
    end = utc(end or as_of)
    start = utc(start or (end - dt.timedelta(hours=1)))
    trend_rows = wh.read("raw_network_events", start.date(), end.date())
    counts = wh.counts("alert_counts")
    hour = _recent(wh, "raw_network_events", as_of, "1 HOUR")
    minutes = _recent(wh, "raw_network_events", as_of, "5 MINUTES")
    return {
        "total_events": dash.total_events_rollup(wh.counts("event_counts")),
        "active_devices_5m": dash.active_devices(minutes, t),
        "device_failures_1h": dash.device_failures(hour, t),
        "alerts_24h": dash.recent_alerts(_recent(wh, "alerts", as_of, "24 HOURS"), t),
        "avg_cpu_5m": dash.recent_average(minutes, "cpu_usage", t),
        "avg_memory_5m": dash.recent_average(minutes, "memory_usage", t),
        "cpu_memory_trend": dash.metric_trend(trend_rows, ("cpu_usage", "memory_usage"), start, end),
        "packet_loss_trend": dash.metric_trend(trend_rows, ("packet_loss",), start, end),
        "high_latency_1h": dash.latency_bands(dash.high_latency_recent(hour, t)),
        "alerts_by_severity": dash.severity_share_rollup(counts),
        "alerts_by_region": dash.alerts_by_rollup(counts, "region"),
        "top_devices": dash.alerts_by_rollup(counts, "device_id", limit=10),
    }


# panel name -> KPI band name (Q7)
KPI_PANELS = {
    "total_events": "total_events",
    "active_devices_5m": "active_devices",
    "device_failures_1h": "device_failures",
    "alerts_24h": "alerts_24h",
    "avg_cpu_5m": "avg_cpu",
    "avg_memory_5m": "avg_memory",
}


def kpi_row(spark: SparkSession, p: dict[str, DataFrame]) -> DataFrame:
    """Q7 over the stored tables: the stat/gauge values in one row with
    their colour bands.  Each value is its (partition-pruned) panel as a
    scalar subquery; the one-row base only carries them."""
    values = {kpi: p[panel].select("value").scalar() for panel, kpi in KPI_PANELS.items()}
    row = spark.range(1).select(*[v.alias(k) for k, v in values.items()])
    return row.select(*values, *[band(F.col(k), k).alias(f"{k}_band") for k in values])
