"""Parse layer: Kafka-shaped rows → typed telemetry rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telewatch.schemas import EVENT_WIRE_SCHEMA, REQUIRED_COLUMNS, STRING_WIDTHS


PROVENANCE_COLUMNS = ("kafka_partition", "kafka_offset", "kafka_timestamp")


def decode(kafka_df: DataFrame, keep_key: bool = True, provenance: bool = False) -> DataFrame:
    """key/value bytes → text (``json_value``, optionally ``kafka_key``;
    ``provenance`` adds the source partition/offset/time for the rejects
    table)."""
    cols = [F.col("value").cast("string").alias("json_value")]
    if keep_key:
        cols.insert(0, F.col("key").cast("string").alias("kafka_key"))
    if provenance:
        cols += [
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("timestamp").alias("kafka_timestamp"),
        ]
    return kafka_df.select(*cols)


def event_time(text: Column) -> Column:
    """ISO-8601 text → TIMESTAMP.  ``try_to_timestamp`` gives NULL for bad
    text under ANSI mode instead of failing the whole micro-batch."""
    return F.try_to_timestamp(text)


def parse_payload(decoded: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Permissive ``from_json`` by the fixed wire schema, flatten,
    parse the event time and drop the source text timestamp.

    A malformed or null payload yields a row whose wire fields are all NULL
    (kept here; ``split_rejects`` routes it).  ``keep_raw`` keeps the text for
    the rejects table.

    The struct is flattened with ``inline(array(from_json(...)))``: a
    Generate, which filters on the parsed fields cannot be pushed through.
    With a plain ``select("data.*")`` the optimizer pushes such a filter
    below the projection by inlining ``from_json`` into the condition, and
    every payload is then parsed once per referenced field.
    """
    passthrough = [c for c in decoded.columns if c != "json_value"]
    if keep_raw:
        passthrough.append("json_value")
    parsed = decoded.select(
        *passthrough, F.inline(F.array(F.from_json(F.col("json_value"), EVENT_WIRE_SCHEMA)))
    )
    return parsed.withColumn("event_timestamp", event_time(F.col("timestamp"))).drop("timestamp")


def parse_kafka(kafka_df: DataFrame, keep_key: bool = True, provenance: bool = False) -> DataFrame:
    """Kafka frame → parsed telemetry (the bronze row without enrichment).
    ``provenance`` keeps the payload text and partition/offset for Q6."""
    return parse_payload(
        decode(kafka_df, keep_key=keep_key, provenance=provenance), keep_raw=provenance
    )


# Columns of the wire payload that the raw table requires, and their widths.
_WIRE = {f.name for f in EVENT_WIRE_SCHEMA} - {"timestamp"} | {"event_timestamp"}
REQUIRED_WIRE = tuple(c for c in REQUIRED_COLUMNS["raw_network_events"] if c in _WIRE)
WIRE_WIDTHS = {c: n for c, n in STRING_WIDTHS["raw_network_events"].items() if c in _WIRE}


def is_rejected() -> Column:
    """Q6: rows that the keyed fact tables cannot hold: a required column is
    NULL (an event time that does not parse is), or a text is wider than its
    column.  Never NULL itself."""
    bad = F.lit(False)
    for c in REQUIRED_WIRE:
        bad = bad | F.col(c).isNull()
    for c, n in WIRE_WIDTHS.items():
        bad = bad | F.coalesce(F.length(F.col(c)) > F.lit(n), F.lit(False))
    return bad


def reject_reasons() -> Column:
    """Q6: why :func:`is_rejected` holds, as an array: ``malformed`` (not a JSON
    object, or none at all), or ``missing:<column>`` and ``too_long:<column>`` for
    each; a time that does not parse is ``bad:event_timestamp``.  A field of a
    wrong type is missing.  Empty for accepted rows.  Needs ``json_value``."""
    text = F.col("json_value")
    value = F.try_parse_json(text)
    malformed = F.coalesce(~F.schema_of_variant(value).startswith("OBJECT"), F.lit(True))
    reasons = []
    for c in REQUIRED_WIRE:
        if c == "event_timestamp":
            given = F.try_variant_get(value, "$.timestamp", "string").isNotNull()
            name = F.when(given, F.lit(f"bad:{c}")).otherwise(F.lit(f"missing:{c}"))
        else:
            name = F.lit(f"missing:{c}")
        reasons.append(F.when(F.col(c).isNull(), name))
    for c, n in WIRE_WIDTHS.items():
        reasons.append(F.when(F.length(F.col(c)) > F.lit(n), F.lit(f"too_long:{c}")))
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return F.when(malformed, F.array(F.lit("malformed"))).otherwise(found)


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Q6 quarantine split → (accepted, rejected).

    Both sides are filters over the same input; persist the input first when
    both are written (the streaming sink does, once per micro-batch).
    """
    bad = is_rejected()
    extra = [c for c in ("json_value", *PROVENANCE_COLUMNS) if c in parsed.columns]
    return parsed.filter(~bad).drop(*extra), parsed.filter(bad)
