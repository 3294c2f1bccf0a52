"""Which message made which event (K9, T7): one id, one row, in all history.

An event id belongs to the first message that carried it: the least (partition,
offset) of the first batch with the id.  The registry keeps that position, so

* a message with a known id and another position is a duplicate, whatever its
  event time or payload, and no table takes it;
* the same message, delivered again by a replay, is recognised by its position
  and may pass: the tables' own keys keep it from being stored twice.

A batch that reads ``recent`` while the daily job folds it may find a file gone;
it fails and is replayed.  Both streaming jobs ask the same registry, before anything is derived from an
event, so all tables hold the same version of it.

New entries are appended to ``recent``, a file or two for each batch; ``fold``
(part of the daily job) moves them to ``base``, which is partitioned by a hash of
the id.  A batch reads ``recent`` and those buckets of ``base`` that its ids fall
in.  An entry is in one of them or, after a crash, in both, with one position.

``Positions`` keeps the range of positions that a job has begun, so that a batch
of new messages need not look for them in the tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.session import hadoop_fs, path_exists, scratch_path
from telewatch.sources.versions import Versions, names_under

BUCKETS = 64
ENTRY = "event_id STRING, kafka_partition INT, kafka_offset BIGINT"
POSITION = ("kafka_partition", "kafka_offset")


@dataclass(frozen=True)
class Admission:
    """``rows`` of a batch that may be stored, and how many were turned away."""

    rows: DataFrame
    duplicates: int


class EventRegistry:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.recent, self.base = f"{root}/_events/recent", f"{root}/_events/base"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int")

    def entries(self, buckets: list[int] | None = None) -> DataFrame:
        """(event_id, kafka_partition, kafka_offset); of these buckets only."""
        out = self.spark.createDataFrame([], ENTRY)
        if path_exists(self.spark, self.recent):
            out = out.unionByName(self.spark.read.schema(ENTRY).parquet(self.recent))
        if path_exists(self.spark, self.base):
            base = self.spark.read.schema(f"{ENTRY}, bucket INT").parquet(self.base)
            if buckets is not None and len(buckets) < self.buckets:
                base = base.where(F.col("bucket").isin(buckets))
            out = out.unionByName(base.drop("bucket"))
        return out

    def add(self, entries: DataFrame) -> None:
        entries.select("event_id", *POSITION).coalesce(2).write.mode("append").parquet(self.recent)

    def admit(self, batch: DataFrame, eligible: Column) -> Admission:
        """Rows of ``batch`` whose event belongs to their message.  Rows that are
        not ``eligible`` (rejects) take no part and stay.  The ids of new events
        are registered; ``batch`` is read several times, so pass it persisted."""
        ids = batch.where(eligible).select("event_id", *POSITION)
        first = ids.groupBy("event_id").agg(F.min(F.struct(*POSITION)).alias("first"), F.count(F.lit(1)).alias("messages"))
        if path_exists(self.spark, self.base):
            touched = [r[0] for r in ids.select(self.bucket()).distinct().collect()]  # ``buckets`` at most
        else:
            touched = None
        held = self.entries(touched).groupBy("event_id").agg(F.min(F.struct(*POSITION)).alias("held"))
        owners = first.join(held, "event_id", "left").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.add(owners.where("held IS NULL").select("event_id", "first.*"))
            doubtful = owners.where("messages > 1 OR held != first").select("event_id", F.coalesce("held", "first").alias("owner"))
            if doubtful.isEmpty():
                return Admission(batch, 0)
            path = scratch_path(self.spark, "duplicates")
            owner = F.struct(*POSITION) != F.col("owner")
            ids.join(doubtful, "event_id").where(owner).select(*POSITION).distinct().write.parquet(path)
        finally:
            owners.unpersist()
        turned = self.spark.read.schema("kafka_partition INT, kafka_offset BIGINT").parquet(path)
        return Admission(batch.join(turned, list(POSITION), "left_anti"), turned.count())

    def fold(self) -> int:
        """Move the entries of ``recent`` to ``base``; the number of files moved."""
        files = [f"{self.recent}/{n}" for n in names_under(self.spark, self.recent) if n.startswith("part-")]
        if not files:
            return 0
        rows = self.spark.read.schema(ENTRY).parquet(*files).withColumn("bucket", self.bucket())
        rows = rows.repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "event_id")
        rows.write.mode("append").partitionBy("bucket").parquet(self.base)
        for f in files:
            fs, p = hadoop_fs(self.spark, f)
            fs.delete(p, False)
        return len(files)


class Positions:
    """The positions that a job has begun to store: one range for each partition."""

    def __init__(self, spark: SparkSession, root: str, job: str):
        self.versions = Versions(spark, f"{root}/_events/positions-{job}", "kafka_partition INT, low BIGINT, high BIGINT")

    def begin(self, ranges: dict[int, tuple[int, int]]) -> bool:
        """Add a batch's ranges; True if a position may have been begun before."""
        known = self.versions.read()
        held = {r.kafka_partition: (r.low, r.high) for r in known.collect()} if known is not None else {}
        again = any(low <= held[p][1] and high >= held[p][0] for p, (low, high) in ranges.items() if p in held)
        merged = dict(held)
        for p, (low, high) in ranges.items():
            merged[p] = (min(low, held[p][0]), max(high, held[p][1])) if p in held else (low, high)
        if merged != held:
            rows = [(p, *span) for p, span in sorted(merged.items())]  # as many as the topic has partitions
            self.versions.write(self.versions.spark.createDataFrame(rows, self.versions.schema).coalesce(1))
        return again
