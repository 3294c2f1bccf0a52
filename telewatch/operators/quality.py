"""Data-quality and freshness checks.

The reference enforces these inside its database (PK, NOT NULL, VARCHAR
widths, foreign keys) and in an hourly freshness task.  Here each check is a
DataFrame of findings computed in one pass per table; every check aggregates
before it shuffles, so a hot device or a duplicated key costs a partial
aggregate, not one overloaded task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from telewatch.functions.timecols import Latest, now, since
from telewatch.operators.joins import join_small
from telewatch.session import scratch_path


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q2: keys that occur more than once, with their row count."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > F.lit(1))
    )


MOST_BROADCAST = 1_000_000  # 8-byte hashes; beyond that the second pass joins by shuffle


def key_report(table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q2 summary row: rows, distinct keys, keys seen more than once, and the
    surplus rows a primary key would have rejected.

    Two passes.  The first counts 64-bit hashes of the keys; a hash that occurs
    once is a key that occurs once.  Only rows of the other hashes, the
    duplicates and a few that collide, are grouped by the keys themselves.  The
    first pass runs here, the second with the result."""
    h = F.xxhash64(*key)
    seen = Observation()
    per_hash = df.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n")).observe(
        seen,
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("rows"),
        F.count_if(F.col("n") == 1).alias("single"),
        F.count_if(F.col("n") > 1).alias("crowded"),
    )
    path = scratch_path(df.sparkSession, "crowded-keys")
    per_hash.where("n > 1").select("h").write.parquet(path)
    found = seen.get
    crowded = df.sparkSession.read.schema("h BIGINT").parquet(path)
    if found["crowded"] <= MOST_BROADCAST:
        crowded = F.broadcast(crowded)
    rows = df.select(*key, h.alias("_h")).join(crowded, F.col("_h") == F.col("h"), "left_semi")
    per_key = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.lit(found["rows"]).cast("bigint").alias("total_rows"),
        (F.count(F.lit(1)) + F.lit(found["single"])).cast("bigint").alias("distinct_keys"),
        F.count_if(F.col("n") > F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - F.lit(1)), F.lit(0).cast("bigint")).alias("surplus_rows"),
    )


def _per_column(table: str, df: DataFrame, tests: Mapping[str, Column], value_name: str) -> DataFrame:
    """One aggregate pass computing ``count_if(test)`` per column, then
    unpivoted to (table_name, column_name, value_name)."""
    wide = df.agg(*[F.count_if(test).alias(col) for col, test in tests.items()])
    return wide.unpivot([], list(tests), "column_name", value_name).select(
        F.lit(table).alias("table_name"), "column_name", value_name
    )


def null_report(table: str, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Q3: NULLs per NOT NULL column."""
    return _per_column(table, df, {c: F.col(c).isNull() for c in required}, "null_rows")


def width_report(table: str, df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Q4: values longer than their VARCHAR width, per column."""
    return _per_column(
        table, df, {c: F.length(F.col(c)) > F.lit(n) for c, n in widths.items()}, "too_long_rows"
    )


def orphan_devices(fact: DataFrame, devices: DataFrame, known_small: bool = False) -> DataFrame:
    """Device ids in ``fact`` missing from ``devices``, with their
    row counts.  The fact is first reduced to one row per device id (partial
    aggregate), so the anti-join sees device cardinality, not fact volume."""
    per_device = fact.groupBy("device_id").agg(F.count(F.lit(1)).alias("rows"))
    return join_small(per_device, devices.select("device_id"), "device_id", "left_anti",
                      known_small=known_small)


def fk_report(table: str, fact: DataFrame, devices: DataFrame, known_small: bool = False) -> DataFrame:
    """J2 summary row: orphan device ids and orphan rows for one table."""
    return orphan_devices(fact, devices, known_small).agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("orphan_devices"),
        F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("orphan_rows"),
    )


def accepted_rows(fact: DataFrame, devices: DataFrame, known_small: bool = False) -> DataFrame:
    """The fact rows whose device exists (left semi join)."""
    return join_small(fact, devices.select("device_id"), "device_id", "left_semi",
                      known_small=known_small)


def reconcile(processed: DataFrame, raw: DataFrame, key: str = "event_id") -> DataFrame:
    """After both streams have landed, which events are in one table but
    not the other.  A full outer join of the two key sets (keys are unique
    per table, so no key is hot), reduced to one summary row."""
    p = processed.select(F.col(key).alias("_p")).distinct()
    r = raw.select(F.col(key).alias("_r")).distinct()
    j = p.join(r, F.col("_p") == F.col("_r"), "full_outer")
    return j.agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_r").isNotNull()).alias("in_both"),
        F.count_if(F.col("_r").isNull()).alias("processed_only"),
        F.count_if(F.col("_p").isNull()).alias("raw_only"),
    )


def reconcile_by_day(processed: DataFrame, raw: DataFrame, day: str = "event_date", key: str = "event_id") -> DataFrame:
    """J3 per day: (day, in_both, processed_only, raw_only); an event that the two
    tables hold on different days counts in both of them, in neither as shared."""
    p = processed.select(F.col(key).alias("_p"), F.col(day).alias("_pd")).distinct()
    r = raw.select(F.col(key).alias("_r"), F.col(day).alias("_rd")).distinct()
    j = p.join(r, (F.col("_p") == F.col("_r")) & F.col("_pd").eqNullSafe(F.col("_rd")), "full_outer")
    return j.groupBy(F.when(F.col("_p").isNotNull(), F.col("_pd")).otherwise(F.col("_rd")).alias(day)).agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_r").isNotNull()).alias("in_both"),
        F.count_if(F.col("_r").isNull()).alias("processed_only"),
        F.count_if(F.col("_p").isNull()).alias("raw_only"),
    )


def key_digests(events: DataFrame, day: str, key: str) -> DataFrame:
    """(day, rows, bits, total): what the keys of a day add up to in any order.
    Days with the same keys agree in all three; the sums are partial aggregates,
    so no key is shuffled."""
    h = F.xxhash64(key)
    return events.groupBy(day).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(h).alias("bits"),
        F.sum(F.xxhash64(F.lit(1), F.col(key)).cast("decimal(38, 0)")).alias("total"),
    )


def differing_days(left: DataFrame, right: DataFrame, day: str) -> DataFrame:
    """(day, left_rows, right_rows) where the digests differ; rows of a side
    without the day count as 0.  One row for each day."""
    a, b = (df.select(F.col(day).alias(f"{s}_day"), *[F.col(c).alias(f"{s}_{c}") for c in ("rows", "bits", "total")]) for s, df in (("a", left), ("b", right)))
    joined = a.join(b, F.col("a_day").eqNullSafe(F.col("b_day")), "full_outer")
    same = F.lit(True)
    for c in ("rows", "bits", "total"):
        same = same & F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    zero = F.lit(0).cast("bigint")
    return joined.where(~same).select(
        F.coalesce("a_day", "b_day").alias(day), F.coalesce("a_rows", zero).alias("left_rows"), F.coalesce("b_rows", zero).alias("right_rows")
    )


def arrivals_freshness(arrivals: DataFrame, as_of: Column | Latest | None = None, window: str = "1 HOUR") -> DataFrame:
    """G15 + Q1 from the table of arrivals: the rows that came in within the window."""
    t = now() if as_of is None else as_of
    recent = arrivals.filter(since(F.col("arrived_at"), t, window))
    return _status(recent.agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("recent_rows")))


def _status(counted: DataFrame) -> DataFrame:
    return counted.select(
        "recent_rows",
        F.when(F.col("recent_rows") > F.lit(0), F.lit("OK")).otherwise(F.lit("STALE")).alias("status"),
    )


def freshness(raw: DataFrame, as_of: Column | Latest | None = None, window: str = "1 HOUR",
              ts_col: str = "ingested_at") -> DataFrame:
    """G15 + Q1: rows that *arrived* (``ingested_at``, not event time) in the
    last hour, with an OK / STALE status."""
    t = now() if as_of is None else as_of
    recent = raw.filter(since(F.col(ts_col), t, window))
    return _status(recent.agg(F.count(F.lit(1)).alias("recent_rows")))


def assert_fresh(status: DataFrame, window: str = "1 HOUR") -> int:
    """Q1 as a gate: raise when nothing arrived in the window."""
    row = status.first()
    if row["recent_rows"] == 0:
        raise RuntimeError(
            f"stale telemetry: not a single row arrived within {window.lower()}; "
            "check that devices still send and that ingestion runs"
        )
    return row["recent_rows"]
