"""Micro-batch sinks.

``foreachBatch`` is at-least-once: after a failure the last micro-batch is
replayed with the same ``batch_id``, and producers may deliver an event twice
at any time.  An event id belongs to its first message (``sources.registry``); a
later message with the id is stored nowhere.  A batch of messages that the job
has never begun is appended; any other one through the tables' keys (K9), against
the days it touches.  What is stored then does not depend on whether a failure
happened.

``BatchLedger`` keeps one marker, the last batch whose sinks were all written,
so a replay of a finished batch is skipped without reading the targets.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.functions.parse import is_rejected
from telewatch.operators.merge import unique_append
from telewatch.session import hadoop_fs
from telewatch.sources.registry import EventRegistry, Positions
from telewatch.sources.tables import Warehouse


class BatchLedger:
    """The last finished batch, kept inside the stream's checkpoint folder: the
    checkpoint is the stream's identity (restarts resume from it whatever the
    query is called), so its ledger lives and dies with it."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark = spark
        self.base = f"{checkpoint.rstrip('/')}/_ledger/done"

    def _finished(self) -> list[int]:
        fs, p = hadoop_fs(self.spark, self.base)
        if not fs.exists(p):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())

    def is_done(self, batch_id: int) -> bool:
        return batch_id in self._finished()

    def mark_done(self, batch_id: int) -> None:
        """Batches end in order, so older markers are not needed any more."""
        fs, p = hadoop_fs(self.spark, f"{self.base}/{batch_id}")
        fs.mkdirs(p)
        for old in self._finished():
            if old < batch_id:
                _, gone = hadoop_fs(self.spark, f"{self.base}/{old}")
                fs.delete(gone, True)


@dataclass
class TableSink:
    """Append a projection of the batch to a warehouse table, by its key;
    ``every`` message of it, or those that the registry admits."""

    table: str
    project: Callable[[DataFrame], DataFrame]
    every: bool = False


@dataclass(frozen=True)
class BatchFacts:
    """What one pass over a batch tells, a row for each Kafka partition."""

    rows: int
    accepted: int = 0
    odd: int = 0  # rejected rows with an event id, which the registry lets pass
    ranges: dict[int, tuple[int, int]] = field(default_factory=dict)
    days: tuple[str, ...] = ()  # of the accepted events
    message_days: tuple[str, ...] = ()


@dataclass
class FanOut:
    """One ``foreachBatch`` function writing several sinks from one persisted
    batch (the batch is parsed once, not once per sink).

    With a ``job`` name, events pass the registry: only the first message of an
    event id goes on, in every job and table alike.  A batch whose positions the
    job has never begun is appended as it is; any other is checked against the
    tables' keys.  ``gate`` marks rows after that (see ``jobs.device_gate``), and
    ``derive`` makes the rows that the sinks project."""

    warehouse: Warehouse
    checkpoint: str
    prepare: Callable[[DataFrame], DataFrame]
    sinks: Sequence[TableSink]
    extra: Sequence[Callable[[DataFrame, int], None]] = field(default_factory=tuple)
    parallel: bool = True
    job: str | None = None
    gate: Callable[[DataFrame], DataFrame] | None = None
    derive: Callable[[DataFrame], DataFrame] | None = None

    # A batch that dies between its sinks and the note of its arrival is replayed
    # as begun before: its rows are there, its arrival stays unnoted.

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        ledger = BatchLedger(batch_df.sparkSession, self.checkpoint)
        if ledger.is_done(batch_id):
            return
        prepared = self.prepare(batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # One job fills the whole cache before the sinks start side by side.
            facts = self._facts(prepared)
            if facts.rows > 0:  # K5
                self._store(prepared, facts, batch_id)
            ledger.mark_done(batch_id)
        finally:
            prepared.unpersist()

    def _facts(self, prepared: DataFrame) -> BatchFacts:
        if self.job is None:
            return BatchFacts(prepared.count())
        good = ~is_rejected()
        parts = prepared.groupBy("kafka_partition").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(good).alias("accepted"),
            F.count_if(~good & F.col("event_id").isNotNull()).alias("odd"),
            F.min("kafka_offset").alias("low"),
            F.max("kafka_offset").alias("high"),
            F.collect_set(F.when(good, F.to_date("event_timestamp").cast("string"))).alias("days"),
            F.collect_set(F.to_date("kafka_timestamp").cast("string")).alias("message_days"),
        ).collect()
        return BatchFacts(
            sum(r.rows for r in parts),
            sum(r.accepted for r in parts),
            sum(r.odd for r in parts),
            {r.kafka_partition: (r.low, r.high) for r in parts},
            tuple(sorted({d for r in parts for d in r.days})),
            tuple(sorted({d for r in parts for d in r.message_days})),
        )

    def _store(self, prepared: DataFrame, facts: BatchFacts, batch_id: int) -> None:
        wh, rows, begun, duplicates = self.warehouse, prepared, True, 0
        if self.job is not None:
            found = {}
            self._run_all([
                lambda: found.update(begun=Positions(wh.spark, wh.root, self.job).begin(facts.ranges)),
                lambda: found.update(admission=EventRegistry(wh.spark, wh.root).admit(prepared, ~is_rejected())),
            ])
            begun, rows, duplicates = found["begun"], found["admission"].rows, found["admission"].duplicates
        stamp = dt.datetime.now(dt.timezone.utc).isoformat()
        rows, all_rows = (df.withColumn("arrived_at", F.lit(stamp).cast("timestamp")) for df in (rows, prepared))
        for step in (self.gate, self.derive):
            rows = step(rows) if step is not None else rows

        def write(sink: TableSink) -> None:
            out = sink.project(all_rows if sink.every else rows)
            if begun or (facts.odd and self.derive is not None):
                wh.append_unique(sink.table, out)
            else:
                # Alerts of admitted events fall on the events' days.
                days = facts.message_days if wh.spec(sink.table).date_col == "ingest_date" else facts.days
                days = list(days)
                wh.append(sink.table, out, days, arrivals=False)
                if sink.table == "raw_network_events":
                    held = rows.where(~is_rejected() & ~F.col("device_known")).count() if self.gate is not None else 0
                    if stored := facts.accepted - duplicates - held:
                        wh.note_arrival(self.checkpoint, batch_id, stamp, stored)

        writers = [lambda s=s: write(s) for s in self.sinks]
        writers += [lambda fn=fn: fn(rows, batch_id) for fn in self.extra]
        self._run_all(writers)

    def _run_all(self, writers) -> None:
        """Run the sink writes; concurrently when ``parallel`` (Spark runs
        jobs from several driver threads at once, so one write's planning and
        commit overlap another's tasks).  ``InheritableThread`` carries the
        streaming query's local properties (job group, cancellation) into
        each thread.  Any failure fails the batch before it is marked done."""
        if not self.parallel or len(writers) < 2:
            for w in writers:
                w()
            return
        from pyspark import InheritableThread

        errors: list[BaseException] = []

        def guarded(w):
            try:
                w()
            except BaseException as exc:  # re-raised on the batch thread below
                errors.append(exc)

        threads = [InheritableThread(target=guarded, args=(w,)) for w in writers]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if errors:
            raise errors[0]

def jdbc_writer(url: str, table: str, user_env: str = "TELEWATCH_DB_USER",
                password_env: str = "TELEWATCH_DB_PASSWORD", driver: str | None = None,
                batch_size: int = 10_000, num_partitions: int | None = None):
    """K4: a ``(df, batch_id)`` function appending to a JDBC table.

    Credentials come from the environment only.  Use it with
    ``jdbc_key_reader`` in an ``ExternalSink``, which keeps rows that the
    target's primary key would reject away from it.  Not exercised here: no
    database runs in this environment.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        if df.isEmpty():  # K5
            return
        out = df if num_partitions is None else df.coalesce(num_partitions)
        w = (
            out.write.format("jdbc")
            .option("url", url)
            .option("dbtable", table)
            .option("user", os.environ.get(user_env, ""))
            .option("password", os.environ.get(password_env, ""))
            .option("batchsize", str(batch_size))
            .mode("append")
        )
        if driver:
            w = w.option("driver", driver)
        w.save()

    return write


def jdbc_key_reader(url: str, table: str, key: Sequence[str], ts_col: str, user_env: str = "TELEWATCH_DB_USER",
                    password_env: str = "TELEWATCH_DB_PASSWORD", driver: str | None = None):
    """A ``(spark, low, high)`` function reading a JDBC table's keys with
    ``ts_col`` between two times; the database applies the range.  The times are
    text with their offset from UTC, so no zone of the driver, the session or the
    database shifts them."""

    def read(spark: SparkSession, low, high) -> DataFrame:
        query = (
            f"SELECT {', '.join(key)} FROM {table} WHERE {ts_col} BETWEEN "
            f"TIMESTAMP WITH TIME ZONE '{low}' AND TIMESTAMP WITH TIME ZONE '{high}'"
        )
        r = (
            spark.read.format("jdbc")
            .option("url", url)
            .option("query", query)
            .option("user", os.environ.get(user_env, ""))
            .option("password", os.environ.get(password_env, ""))
        )
        return (r.option("driver", driver) if driver else r).load()

    return read


@dataclass
class ExternalSink:
    """An extra writer of a ``FanOut``: project the prepared batch, then hand
    it to ``write(df, batch_id)`` (e.g. ``jdbc_writer``).

    With a ``key`` and a ``read_keys`` only rows go out that the target does
    not hold, within the batch's range of ``ts_col``: a replay after a partial
    write, or an event delivered again, passes the target's primary key."""

    project: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame, int], None]
    key: tuple[str, ...] = ()
    ts_col: str = "event_timestamp"
    read_keys: Callable[[SparkSession, object, object], DataFrame] | None = None

    def __call__(self, prepared: DataFrame, batch_id: int) -> None:
        rows = self.project(prepared)
        if self.key:
            target = None
            if self.read_keys is not None:
                text = [F.date_format(f(F.col(self.ts_col).cast("timestamp")), "yyyy-MM-dd HH:mm:ss.SSSSSSxxx") for f in (F.min, F.max)]
                low, high = rows.agg(*text).first()
                if low is None:
                    return
                target = self.read_keys(rows.sparkSession, low, high)
            rows = unique_append(rows, target, self.key)
        self.write(rows, batch_id)


def console_preview(df: DataFrame, trigger: dict | None = None, name: str | None = None):
    """K1: untruncated console output for live checking (debug only, no
    checkpoint — it is not a durable sink).  Trigger defaults to 10 s."""
    w = df.writeStream.format("console").option("truncate", "false").outputMode("append")
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
