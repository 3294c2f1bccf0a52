"""telewatch — device-telemetry monitoring expressed as Spark DataFrame transforms.

Every transform here takes and returns a DataFrame, so the same code runs in
batch jobs, in Structured Streaming micro-batches, and under the SQL oracle
tests.  Layout:

* ``sources``    — scans (telemetry tables, device dimension, Kafka, fixtures)
* ``functions``  — column-level building blocks (parse, enrich, rules, time)
* ``operators``  — DataFrame-level operators (alerts, roll-up, merge, quality,
                   dashboard metrics, report lines)
* ``plans``      — batch jobs (daily roll-up, health check) and the query
                   catalogue used by ``__spark_entry__``
* ``streaming``  — streaming jobs, micro-batch sinks, supervision
"""

__version__ = "0.1.0"
