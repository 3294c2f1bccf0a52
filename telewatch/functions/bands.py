"""KPI status bands (Q7) and the stat reduction (Q8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dashboard bands as (base colour, [(from value, colour), ...]).
# A value takes the colour of the highest step it reaches.
KPI_BANDS = {
    "total_events": ("blue", []),
    "active_devices": ("red", [(15, "orange"), (24, "green")]),
    "device_failures": ("green", [(1, "orange"), (5, "red")]),
    "alerts_24h": ("green", [(10, "orange"), (30, "red")]),
    "avg_cpu": ("green", [(70, "orange"), (90, "red")]),
    "avg_memory": ("green", [(70, "orange"), (90, "red")]),
    "latency_ms": ("green", [(200, "orange"), (300, "red")]),
}


def band(value: Column, kpi: str) -> Column:
    """Colour of ``value`` for ``kpi``; NULL values take the base colour."""
    base, steps = KPI_BANDS[kpi]
    out = None
    for threshold, colour in sorted(steps, reverse=True):
        cond = value >= F.lit(threshold)
        out = F.when(cond, F.lit(colour)) if out is None else out.when(cond, F.lit(colour))
    return F.lit(base) if out is None else out.otherwise(F.lit(base))


def last_not_null(value: Column, order: Column) -> Column:
    """Q8: the stat panels' ``lastNotNull`` reduction as an aggregate — the
    value at the greatest ``order`` among non-null values."""
    return F.max_by(value, F.when(value.isNotNull(), order))
