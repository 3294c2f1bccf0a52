"""Date-partitioned Parquet tables of the telemetry warehouse (S3–S5, K2, K3,
K6–K8, K9, K10 write path).

Every fact table is partitioned by a date column and has a declared schema, so
a table without files reads as empty.  A read lists the table's day folders
and then only the days it was asked for; where the table has a time column,
the range also reaches the Parquet reader as a pushed filter.

``append_unique`` is the append of every writer: it enforces the table's key
within the rows and against the days they touch.  One writer per table at a
time is assumed, as one stream or job owns each table.

Roll-ups hold one partition per day of their source and cover exactly the days
they have a partition for.  An append to a source day drops that day's roll-up
before and after it writes; readers count uncovered days from the source
itself, so a missing roll-up costs time and never an answer.

Tables whose days are rewritten (the summary and the roll-ups) keep versions of
a day: a new one is written beside the old one and holds when its marker file
exists, so a crash at any point leaves each day as it was or as it should be.
The version before stays for readers that have begun.  Other tables' partitions
are staged under the shared checkpoint folder and swapped in with dynamic
partition overwrite, which is not safe against a crash between its delete and
its move; only tests rewrite those.

Every append to the raw table is noted in ``arrivals``, by arrival date: when
rows came in and how many, so the freshness gate opens no raw file.
"""

from __future__ import annotations

import datetime as dt
import json
import math
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telewatch.functions.timecols import as_date
from telewatch.operators.dashboard import alert_count_partials
from telewatch.operators.merge import unique_append
from telewatch.operators.quality import key_digests
from telewatch.schemas import TABLE_SCHEMAS
from telewatch.session import hadoop_fs, path_exists, scratch_path
from telewatch.sources.versions import create_marker, delete, names_under

NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
FEW_DAYS = 4  # appends to more days deal their rows by day


@dataclass(frozen=True)
class TableSpec:
    name: str
    subdir: str
    date_col: str
    ts_col: str | None
    key: tuple[str, ...]
    versioned: bool = False  # days are rewritten as a whole

    @property
    def schema(self) -> StructType:
        return TABLE_SCHEMAS[self.name]


TABLES = {
    spec.name: spec
    for spec in (
        # Bronze archives messages as they arrived: dated by Kafka time, keyed
        # by Kafka position (malformed rows have no event id or event time).
        TableSpec(
            "bronze", "bronze/network_events", "ingest_date", "kafka_timestamp",
            ("kafka_partition", "kafka_offset"),
        ),
        TableSpec("raw_network_events", "raw_network_events", "event_date", "event_timestamp", ("event_id",)),
        TableSpec(
            "processed_network_events", "processed_network_events", "event_date", "event_timestamp",
            ("event_id",),
        ),
        TableSpec("silver_alerts", "silver/alerts", "alert_date", "alert_timestamp", ("alert_id",)),
        TableSpec("alerts", "alerts", "alert_date", "alert_timestamp", ("alert_id",)),
        TableSpec(
            "alert_counts", "gold/alert_counts", "alert_date", None,
            ("alert_date", "device_id", "region", "severity"), True,
        ),
        TableSpec("event_counts", "gold/event_counts", "event_date", None, ("event_date",), True),
        TableSpec("raw_digests", "gold/raw_digests", "event_date", None, ("event_date",), True),
        TableSpec("processed_digests", "gold/processed_digests", "event_date", None, ("event_date",), True),
        # One row for each batch (or arrival time of a bulk load) of the raw table.
        TableSpec("arrivals", "arrivals", "arrival_date", "arrived_at", ("source", "batch_id", "arrived_at")),
        # Events of devices that the dimension lacks, and those of them stored since.
        TableSpec("held_events", "held_events", "ingest_date", "kafka_timestamp", ("kafka_partition", "kafka_offset")),
        TableSpec("released_events", "released_events", "ingest_date", "kafka_timestamp", ("kafka_partition", "kafka_offset")),
        # Rejects are dated by the Kafka message time: stable across replays.
        TableSpec("rejects", "rejects", "ingest_date", "kafka_timestamp", ("kafka_partition", "kafka_offset")),
        TableSpec(
            "daily_monitoring_summary", "daily_monitoring_summary", "summary_date", None,
            ("summary_date", "device_id"), True,
        ),
    )
}


def _event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


def _digests(events: DataFrame) -> DataFrame:
    return key_digests(events, "event_date", "event_id")


# roll-up -> (source table, its rows from the source's rows)
ROLLUPS = {
    "alert_counts": ("alerts", alert_count_partials),
    "event_counts": ("raw_network_events", _event_counts),
    "raw_digests": ("raw_network_events", _digests),
    "processed_digests": ("processed_network_events", _digests),
}


def _day(value) -> str | None:
    return None if value is None else str(value)[:10]


class Warehouse:
    """The telemetry tables under one root folder (local, HDFS, S3, …)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def spec(self, table: str) -> TableSpec:
        return TABLES[table]

    def path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table].subdir}"

    def exists(self, table: str) -> bool:
        return path_exists(self.spark, self.path(table))

    # -- reads ---------------------------------------------------------------

    def days(self, table: str, start=None, end=None) -> list[str]:
        """The table's day partitions within ``start``..``end`` (inclusive,
        either open), oldest first; rows without a day count only when both
        sides are open.  One listing of the table's own folder."""
        found = sorted(self._day_paths(table))
        low, high = _day(start), _day(end)
        if low is None and high is None:
            return found
        return [d for d in found if d != NULL_DAY and (low is None or d >= low) and (high is None or d <= high)]

    def _day_paths(self, table: str) -> dict[str, str]:
        """Where each day's files lie: one listing of the table's folder, and for
        a versioned table one of its markers."""
        spec, root = TABLES[table], self.path(table)
        mark = f"{spec.date_col}="
        out = {n[len(mark):]: f"{root}/{n}" for n in names_under(self.spark, root) if n.startswith(mark)}
        if spec.versioned:
            for day, versions in self._versions(table).items():
                out[day] = f"{root}/v={versions[-1]}/{mark}{day}"
        return out

    def _versions(self, table: str) -> dict[str, list[str]]:
        """The committed versions of each day, oldest first."""
        out: dict[str, list[str]] = {}
        for name in names_under(self.spark, f"{self.path(table)}/_days"):
            day, version = name.split("=")
            out.setdefault(day, []).append(version)
        return out

    def day_path(self, table: str, day: str) -> str:
        return self._day_paths(table).get(day) or f"{self.path(table)}/{TABLES[table].date_col}={day}"

    def read_days(self, table: str, days: Iterable[str]) -> DataFrame:
        """Exactly these day partitions; other days are not listed."""
        spec, days = TABLES[table], list(days)
        if not days:
            return self.spark.createDataFrame([], spec.schema)
        if spec.versioned:
            at = self._day_paths(table)
            paths = [at[d] for d in days]
        else:
            paths = [f"{self.path(table)}/{spec.date_col}={d}" for d in days]
        columns = spec.schema.names
        reader = self.spark.read.schema(spec.schema).option("basePath", self.path(table))
        old = [p for p in paths if "/v=" not in p]
        parts = [reader.parquet(*some).select(*columns) for some in (old, [p for p in paths if p not in old]) if some]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, table: str, start=None, end=None) -> DataFrame:
        """The table, restricted to dates ``start``..``end``
        (inclusive, either open).  A missing or empty table has no rows."""
        spec = TABLES[table]
        df = self.read_days(table, self.days(table, start, end))
        if start is not None and spec.ts_col:
            df = df.filter(F.col(spec.ts_col) >= as_date(_day(start)).cast("timestamp"))
        if end is not None and spec.ts_col:
            df = df.filter(F.col(spec.ts_col) < F.date_add(as_date(_day(end)), 1).cast("timestamp"))
        return df

    def read_day(self, table: str, ds) -> DataFrame:
        return self.read(table, ds, ds)

    # -- writes --------------------------------------------------------------

    def with_date(self, table: str, df: DataFrame) -> DataFrame:
        spec = TABLES[table]
        if spec.date_col in df.columns:
            return df
        if spec.ts_col is None:
            return df.withColumn(spec.date_col, F.current_date())
        return df.withColumn(spec.date_col, F.to_date(F.col(spec.ts_col)))

    def days_of(self, table: str, df: DataFrame) -> list[str]:
        """The day partitions that ``df`` writes to (one row per day)."""
        day = F.coalesce(F.col(TABLES[table].date_col).cast("string"), F.lit(NULL_DAY))
        return sorted(r[0] for r in self.with_date(table, df).select(day).distinct().collect())

    def append(self, table: str, df: DataFrame, days: list[str] | None = None, arrivals: bool = True) -> None:
        """Append rows as new files in their date partitions, whatever the
        table holds.  No shuffle for rows of a few days: each task writes its own;
        file count is tamed by ``compact``.  Arrivals of raw rows are counted before the rows
        are written and noted after, unless the caller notes them itself."""
        spec = TABLES[table]
        of_table = [name for name, (source, _) in ROLLUPS.items() if source == table]
        rows = self.with_date(table, df)
        if of_table and days is None:
            days = self.days_of(table, df)
        counted = None
        if arrivals and table == "raw_network_events" and "ingested_at" in rows.columns:
            counted = scratch_path(self.spark, "arrivals")
            source = f"append-{uuid.uuid4().hex[:12]}"
            rows.where("ingested_at IS NOT NULL").groupBy(F.col("ingested_at").cast("timestamp").alias("arrived_at")).agg(
                F.count(F.lit(1)).alias("rows")
            ).select(F.lit(source).alias("source"), F.lit(-1).cast("bigint").alias("batch_id"), "arrived_at", "rows").write.parquet(counted)
        for name in of_table:
            self.drop_days(name, days)
        self._by_day(spec, rows, days).write.mode("append").partitionBy(spec.date_col).parquet(self.path(table))
        for name in of_table:
            self.drop_days(name, days)
        if counted is not None:
            self.append("arrivals", self.spark.read.parquet(counted).coalesce(1))
            delete(self.spark, counted)

    def _by_day(self, spec: TableSpec, rows: DataFrame, days: list[str] | None) -> DataFrame:
        """Rows of many days are dealt by day first, or every task would write a
        small file into every day; a day's rows go to several tasks by their key,
        so a day that holds most of them is no task of its own."""
        if days is None or len(days) <= FEW_DAYS:
            return rows
        tasks = 2 * self.spark.sparkContext.defaultParallelism
        salt = F.pmod(F.xxhash64(*spec.key), F.lit(max(1, tasks // len(days))))
        return rows.repartition(max(tasks, min(len(days), 2 * tasks)), spec.date_col, salt)

    def note_arrival(self, source: str, batch_id: int, arrived_at: str, rows: int) -> None:
        """One row for a finished batch, once: ``arrived_at`` is an instant as text
        with its offset from UTC."""
        row = self.spark.createDataFrame([(source, batch_id, rows)], "source STRING, batch_id BIGINT, rows BIGINT")
        row = row.withColumn("arrived_at", F.lit(arrived_at).cast("timestamp"))
        self.append_unique("arrivals", row, [arrived_at[:10]])

    def append_unique(self, table: str, df: DataFrame, days: list[str] | None = None, arrivals: bool = True) -> None:
        """K9: append the rows that a primary key on the table's key accepts:
        the first of each key (by the remaining columns, so that every run
        chooses alike), and none that the days touched already hold.  The target
        is read for its key columns alone.  Rows with a NULL in the key have no
        identity and are all kept.  ``days``, if known, saves a pass."""
        spec = TABLES[table]
        rows = self.with_date(table, df)
        if days is None:
            days = self.days_of(table, rows)
        if not days:
            return
        present = set(self.days(table))
        target = self.read_days(table, [d for d in days if d in present]).select(*spec.key)
        keyed = F.lit(True)
        for k in spec.key:
            keyed = keyed & F.col(k).isNotNull()
        new = unique_append(rows.filter(keyed), target, spec.key).unionByName(rows.filter(~keyed))
        self.append(table, new, days, arrivals)

    def drop_days(self, table: str, days: Iterable[str]) -> None:
        """Remove days; of a versioned table first their markers, then the rows."""
        spec, root, at = TABLES[table], self.path(table), self._day_paths(table)
        versions = self._versions(table) if spec.versioned else {}
        for d in days:
            if d not in at:
                continue
            for version in versions.get(d, ()):
                delete(self.spark, f"{root}/_days/{d}={version}")
            for version in versions.get(d, ()):
                delete(self.spark, f"{root}/v={version}/{spec.date_col}={d}")
            delete(self.spark, f"{root}/{spec.date_col}={d}")

    def overwrite_partitions(self, table: str, df: DataFrame) -> None:
        """Replace exactly the date partitions present in ``df`` (others are
        untouched); ``df`` may read the table itself."""
        spec, root = TABLES[table], self.path(table)
        if not spec.versioned:
            return self._swap_partitions(table, df)
        version = f"{time.time_ns() // 1000:017d}-{uuid.uuid4().hex[:6]}"
        before = self._versions(table)
        self.with_date(table, df).write.partitionBy(spec.date_col).parquet(f"{root}/v={version}")
        mark = f"{spec.date_col}="
        for name in names_under(self.spark, f"{root}/v={version}"):
            if name.startswith(mark):
                self._hold(table, name[len(mark):], version)
                for old in before.get(name[len(mark):], [])[:-1]:
                    delete(self.spark, f"{root}/_days/{name[len(mark):]}={old}")
                    delete(self.spark, f"{root}/v={old}/{name}")

    def _hold(self, table: str, day: str, version: str) -> None:
        """From here on the day is this version."""
        create_marker(self.spark, f"{self.path(table)}/_days/{day}={version}")

    def _swap_partitions(self, table: str, df: DataFrame) -> None:
        spec = TABLES[table]
        staged = scratch_path(self.spark, f"stage-{table}")
        self.with_date(table, df).write.mode("overwrite").partitionBy(spec.date_col).parquet(staged)
        fs, p = hadoop_fs(self.spark, staged)
        if any(s.getPath().getName().startswith(f"{spec.date_col}=") for s in fs.listStatus(p)):
            (
                self.spark.read.schema(spec.schema)
                .parquet(staged)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(spec.date_col)
                .parquet(self.path(table))
            )
        fs.delete(p, True)  # our own uniquely named staging folder

    # -- roll-ups --------------------------------------------------------------

    def roll_up(self, name: str, start=None, end=None) -> list[str]:
        """Write the roll-up of the source's days in the range and return the
        days covered.  A day whose files changed meanwhile is dropped again."""
        source, aggregate = ROLLUPS[name]
        days = [d for d in self.days(source, start, end) if d != NULL_DAY]
        before = {d: self._files(source, d) for d in days}
        self.overwrite_partitions(name, aggregate(self.read_days(source, days)))
        changed = [d for d in days if self._files(source, d) != before[d]]
        self.drop_days(name, changed)
        return [d for d in days if d not in changed]

    def counts(self, name: str, start=None, end=None) -> DataFrame:
        """The roll-up's rows for every day of its source: read where the
        roll-up covers the day, else counted from the source."""
        source, aggregate = ROLLUPS[name]
        days = self.days(source, start, end)
        covered = set(self.days(name, start, end))
        stored = self.read_days(name, [d for d in days if d in covered])
        return stored.unionByName(aggregate(self.read_days(source, [d for d in days if d not in covered])))

    def _files(self, table: str, day: str) -> list[str]:
        fs, p = hadoop_fs(self.spark, self.day_path(table, day))
        if not fs.exists(p):
            return []
        names = (s.getPath() for s in fs.listStatus(p))
        return sorted(str(f) for f in names if not f.getName().startswith(("_", ".")))

    # -- compaction ------------------------------------------------------------

    def compact(self, table: str, start, end=None, rows_per_file: int = 2_000_000,
                min_age_days: int = 2) -> int:
        """Rewrite the files that the days ``start``..``end`` hold now into
        files of about ``rows_per_file`` rows, range-partitioned and sorted by
        (date, device, time, key) so a device filter skips row groups.  Range
        partitioning samples the keys and cuts one hot device's rows across
        several tasks.  Returns the number of files written.

        Only the listed files go; files that a stream appends meanwhile stay.
        The new files are written once, beside the table; a manifest then
        records both lists, so a rewrite that dies between moving the new
        files in and removing the old ones is finished by the next call.
        Days younger than ``min_age_days`` are refused: they still fill with
        small files (0 to force)."""
        last = dt.date.fromisoformat(_day(end if end is not None else start))
        newest_allowed = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=min_age_days)
        if min_age_days and last > newest_allowed:
            raise ValueError(
                f"refusing to compact {table} up to {last}: days after {newest_allowed} still "
                "fill with small files (pass min_age_days=0 to force)"
            )
        self.finish_compactions(table)
        spec = TABLES[table]
        days = self.days(table, start, end if end is not None else start)
        old = [f for d in days for f in self._files(table, d)]
        if not old:
            return 0
        df = self.spark.read.schema(spec.schema).option("basePath", self.path(table)).parquet(*old)
        rows = df.count()  # from the file footers
        n = max(1, math.ceil(rows / rows_per_file))
        order = [spec.date_col]
        if "device_id" in df.columns:
            order.append("device_id")
        if spec.ts_col:
            order.append(spec.ts_col)
        order += [k for k in spec.key if k not in order]
        name = uuid.uuid4().hex[:12]
        staged = f"{self.path(table)}/_compaction/{name}"
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.partitionBy(spec.date_col).parquet(staged)
        fs, p = hadoop_fs(self.spark, staged)
        moves = []
        for folder in (s.getPath() for s in fs.listStatus(p)):
            if folder.getName().startswith(f"{spec.date_col}="):
                for f in (s.getPath() for s in fs.listStatus(folder)):
                    if f.getName().startswith("part-"):
                        moves.append([str(f), f"{self.path(table)}/{folder.getName()}/{name}-{f.getName()}"])
        self._write_text(f"{staged}.json", json.dumps({"old": old, "moves": moves}))
        self.finish_compactions(table)
        return len(moves)

    def finish_compactions(self, table: str) -> None:
        """Carry out the manifests left under the table; repeatable."""
        fs, p = hadoop_fs(self.spark, f"{self.path(table)}/_compaction")
        if not fs.exists(p):
            return
        for status in fs.listStatus(p):
            manifest = status.getPath()
            if not manifest.getName().endswith(".json"):
                continue
            todo = json.loads(self.spark.read.text(str(manifest), wholetext=True).first()[0])
            for source, target in todo["moves"]:
                fs_out, out = hadoop_fs(self.spark, target)
                _, here = hadoop_fs(self.spark, source)
                if not fs_out.exists(out) and not fs_out.rename(here, out):
                    raise RuntimeError(f"could not move {source} to {target}")
            for f in todo["old"]:
                fs_old, gone = hadoop_fs(self.spark, f)
                fs_old.delete(gone, False)
            fs.delete(manifest, False)
            _, staged = hadoop_fs(self.spark, str(manifest)[: -len(".json")])
            fs.delete(staged, True)

    def _write_text(self, path: str, text: str) -> None:
        fs, p = hadoop_fs(self.spark, path)
        out = fs.create(p, True)
        out.write(bytearray(text.encode()))
        out.close()
