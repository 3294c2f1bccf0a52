"""Write semantics of the relational sinks, as DataFrame operators
(K9, K10, K11, K12, K13).

All of them are joins on the table key.  Keys are unique on both sides (or
made so first), so a hot *device* cannot skew them; the target side is read
only for the partitions the input touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telewatch.functions.timecols import now
from telewatch.schemas import SUMMARY_COLUMNS, SUMMARY_KEY, SUMMARY_UPDATE_COLUMNS


def unique_append(batch: DataFrame, target: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """K9: the rows of ``batch`` a primary key on ``key`` would accept: one of
    each key, and none already in ``target``.

    Of rows with one key the least stays, by the batch's other columns in their
    order, so a replay and every table that gets the same rows choose alike.
    ``target`` should already be restricted to the partitions the batch can
    collide with (same event dates); the anti-join then reads only those.
    """
    others = [c for c in batch.columns if c not in key]
    ordered = [c for c in others if batch.schema[c].dataType.typeName() not in ("map", "variant")]
    if others:
        least = batch.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(F.lit(0), *ordered)).alias("_least"))
    else:
        least = batch.distinct()
    deduped = least.select(*[F.col(c) if c in key else F.col(f"_least.{c}").alias(c) for c in batch.columns])
    if target is None:
        return deduped
    return deduped.join(target.select(*key).dropDuplicates(list(key)), list(key), "left_anti")


def insert_if_absent(new: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """``ON CONFLICT (key) DO NOTHING`` — rows of ``new`` whose key is
    not in ``existing`` (one per key, chosen as in ``unique_append``)."""
    return unique_append(new, existing, key)


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Write-time defaults — fill NULL (or add missing) columns."""
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def upsert_summary(target: DataFrame, updates: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """K10 + K13: ``INSERT … ON CONFLICT (summary_date, device_id) DO UPDATE``.

    Full outer join on the key.  Matched rows take every update column from
    ``updates`` but keep ``device_type``/``region`` from ``target`` and get a
    fresh ``computed_at``; unmatched target rows stay as they were; new keys
    are inserted.  ``target`` is the affected date partitions only.
    """
    stamp = now() if computed_at is None else computed_at
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in SUMMARY_COLUMNS])
    u = updates.select(*[F.col(c).alias(f"u_{c}") for c in SUMMARY_COLUMNS if c != "computed_at"])
    cond = [F.col(f"t_{k}") == F.col(f"u_{k}") for k in SUMMARY_KEY]
    joined = t.join(u, cond[0] & cond[1], "full_outer")
    has_update = F.col("u_device_id").isNotNull()
    has_target = F.col("t_device_id").isNotNull()

    def pick(c: str) -> Column:
        if c in SUMMARY_KEY:
            return F.coalesce(F.col(f"u_{c}"), F.col(f"t_{c}"))
        if c == "computed_at":
            return F.when(has_update, stamp).otherwise(F.col("t_computed_at"))
        if c in SUMMARY_UPDATE_COLUMNS:
            return F.when(has_update, F.col(f"u_{c}")).otherwise(F.col(f"t_{c}"))
        # insert-only columns (device_type, region)
        return F.when(has_target, F.col(f"t_{c}")).otherwise(F.col(f"u_{c}"))

    return joined.select(*[pick(c).alias(c) for c in SUMMARY_COLUMNS])
