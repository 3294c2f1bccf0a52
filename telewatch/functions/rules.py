"""Alert rules as data, compiled to Column expressions.

A rule is plain data; ``Rule.candidate()`` turns it into one nullable struct
column — the struct when the rule fires, NULL otherwise.  Users extend the
rule set by passing a longer list; no streaming code changes (A6).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """One alert rule.

    Exactly one of ``above`` (strict ``column > above``) or ``equals``
    (``column == equals``) is set.  ``template`` is a Java format string for
    ``format_string``: threshold rules get (device_id, value), equality rules
    get (device_id).  ``rule_id`` (default: the alert type) tells rules of one
    alert type apart in the alert ids.
    """

    alert_type: str
    severity: str
    column: str
    template: str
    above: float | None = None
    equals: str | None = None
    rule_id: str = ""

    def __post_init__(self):
        if (self.above is None) == (self.equals is None):
            raise ValueError(f"rule {self.alert_type}: set exactly one of above/equals")
        if not self.rule_id:
            object.__setattr__(self, "rule_id", self.alert_type)

    def condition(self) -> Column:
        if self.above is not None:
            return F.col(self.column) > F.lit(float(self.above))
        return F.col(self.column) == F.lit(self.equals)

    def description(self) -> Column:
        if self.above is not None:
            return F.format_string(self.template, F.col("device_id"), F.col(self.column))
        return F.format_string(self.template, F.col("device_id"))

    def candidate(self) -> Column:
        """A1/A2: ``when(condition, struct(type, severity, description))``."""
        return F.when(
            self.condition(),
            F.struct(
                F.lit(self.rule_id).alias("rule_id"),
                F.lit(self.alert_type).alias("alert_type"),
                F.lit(self.severity).alias("severity"),
                self.description().alias("description"),
            ),
        )


# The six reference rules — type, severity, tested column,
# threshold (strict >) or equality value, and description template.
CPU_HIGH = Rule(
    "CPU_HIGH", "HIGH", "cpu_usage",
    "CPU usage on %s reached %.2f%%, exceeding the 90%% threshold.", above=90.0,
)
MEMORY_HIGH = Rule(
    "MEMORY_HIGH", "HIGH", "memory_usage",
    "Memory usage on %s reached %.2f%%, exceeding the 90%% threshold.", above=90.0,
)
PACKET_LOSS_HIGH = Rule(
    "PACKET_LOSS_HIGH", "HIGH", "packet_loss",
    "Packet loss on %s reached %.2f%%, exceeding the 5%% threshold.", above=5.0,
)
LATENCY_HIGH = Rule(
    "LATENCY_HIGH", "MEDIUM", "latency_ms",
    "Latency on %s reached %.2f ms, exceeding the 200 ms threshold.", above=200.0,
)
BANDWIDTH_SATURATION = Rule(
    "BANDWIDTH_SATURATION", "MEDIUM", "bandwidth_utilization_pct",
    "Bandwidth utilization on %s reached %.2f%%, exceeding the 95%% threshold.", above=95.0,
)
DEVICE_DOWN = Rule(
    "DEVICE_DOWN", "CRITICAL", "status",
    "Device %s is reporting DOWN status.", equals="DOWN",
)

DEFAULT_RULES: tuple[Rule, ...] = (
    CPU_HIGH,
    MEMORY_HIGH,
    PACKET_LOSS_HIGH,
    LATENCY_HIGH,
    BANDWIDTH_SATURATION,
    DEVICE_DOWN,
)


def candidates(rules=DEFAULT_RULES) -> Column:
    """A3: one nullable struct per rule, in rule order; a NULL element is a
    rule that did not fire (A4 drops them after the explode)."""
    ids = [r.rule_id for r in rules]
    twice = sorted({i for i in ids if ids.count(i) > 1})
    if twice:
        raise ValueError(f"rule ids are not unique: {', '.join(twice)}")
    return F.array(*[r.candidate() for r in rules])


def load_rules(text: str) -> tuple[Rule, ...]:
    """Rules from a JSON list of objects with the fields of ``Rule``."""
    return tuple(Rule(**fields) for fields in json.loads(text))


def anomalous_reading() -> Column:
    """the simulator's own "anomalous reading" test — DOWN, or a metric
    past its hard threshold, with raw bandwidth > 950 Mbps instead of the
    percentage rule.  Kept as an independent restatement of the rules."""
    return (
        (F.col("status") == F.lit("DOWN"))
        | (F.col("cpu_usage") > F.lit(90.0))
        | (F.col("memory_usage") > F.lit(90.0))
        | (F.col("packet_loss") > F.lit(5.0))
        | (F.col("latency_ms") > F.lit(200.0))
        | (F.col("bandwidth_mbps") > F.lit(950.0))
    )
