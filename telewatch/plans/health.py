"""Hourly health task (Q1, G15): fail when no event *arrived* in the last hour.

The test is on arrival, not on event time: a replay of old events arrives now but
lands in old partitions of the raw table.  Every append to it is noted in
``arrivals``, which is partitioned by arrival date; the gate lists and reads the
days of its window there, two for an hour, and no raw file.  Only in a warehouse
older than that table the raw table itself is read, through the ``ingested_at``
statistics of its row groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.functions.timecols import instant
from telewatch.operators.quality import arrivals_freshness, assert_fresh, differing_days, freshness, reconcile_by_day
from telewatch.session import configure
from telewatch.sources.tables import NULL_DAY, Warehouse


def freshness_status(spark: SparkSession, root: str, as_of: dt.datetime | None = None, hours: int = 1) -> DataFrame:
    """G15 as a one-row status DataFrame (no exception)."""
    configure(spark)
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    wh, window = Warehouse(spark, root), f"{hours} HOUR"
    if not wh.exists("arrivals"):
        return freshness(wh.read("raw_network_events"), instant(as_of), window)
    since_ = as_of if as_of.tzinfo is None else as_of.astimezone(dt.timezone.utc)
    first = (since_ - dt.timedelta(hours=hours)).date()
    return arrivals_freshness(wh.read("arrivals", first), instant(as_of), window)


def check_recent_events(spark: SparkSession, root: str, as_of: dt.datetime | None = None, hours: int = 1) -> int:
    """Q1 gate: raise RuntimeError when nothing arrived in the last ``hours``."""
    return assert_fresh(freshness_status(spark, root, as_of, hours), f"{hours} HOUR")


def reconcile_tables(wh: Warehouse, start=None, end=None) -> DataFrame:
    """J3 over the stored tables: (event_date, in_both, processed_only, raw_only)
    for the days on which the two tables' keys differ; none if they agree.

    Each table's days are compared by their digests, which the daily job stores
    and an append to the day drops; only a day without one is read for it.  Only
    the days that differ are read in full and joined."""
    processed, raw = (wh.counts(f"{name}_digests", start, end) for name in ("processed", "raw"))
    days = differing_days(processed, raw, "event_date").select(F.col("event_date").cast("string")).collect()  # a row a day
    names = {d or NULL_DAY for (d,) in days}
    found = [wh.read_days(t, [d for d in wh.days(t, start, end) if d in names]) for t in ("processed_network_events", "raw_network_events")]
    return reconcile_by_day(*found)
