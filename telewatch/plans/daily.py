"""Daily roll-up job: summary upsert + Markdown report.

``run_daily(spark, root, ds)`` is the scheduled task body: it reads only the
``ds`` partitions of the raw and alert tables, upserts that day's summary
rows (a new version of the day, committed by a marker) and writes
the day's report.  ``run_range`` backfills many days in one job — the same
plan, grouped by (date, device) instead of one date at a time.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.operators.merge import upsert_summary
from telewatch.operators.report import report_lines, write_reports
from telewatch.operators.rollup import daily_alert_counts_from_rollup, daily_summary
from telewatch.schemas import SUMMARY_COLUMNS
from telewatch.session import configure
from telewatch.sources.devices import update_devices
from telewatch.sources.registry import EventRegistry
from telewatch.sources.tables import ROLLUPS, Warehouse

SUMMARY = "daily_monitoring_summary"


def compute_summary(wh: Warehouse, start, end=None, computed_at=None) -> DataFrame:
    """Merged summary rows for the days ``start``..``end`` (not written)."""
    end = start if end is None else end
    events = wh.read("raw_network_events", start, end)
    ds = start if start == end else None
    # From the roll-up where it covers the day, else from the day's alerts.
    counts = daily_alert_counts_from_rollup(wh.counts("alert_counts", start, end))
    updates = daily_summary(events, None, ds=ds, computed_at=computed_at, alert_counts=counts)
    target = wh.read(SUMMARY, start, end).select(*SUMMARY_COLUMNS)
    return upsert_summary(target, updates, computed_at=computed_at)


def upsert_days(wh: Warehouse, start, end=None, computed_at=None) -> None:
    """Write the merged rows over those days' partitions only."""
    wh.overwrite_partitions(SUMMARY, compute_summary(wh, start, end, computed_at))


def report_for_day(wh: Warehouse, ds) -> DataFrame:
    """The day's report lines (the empty-day text when no rows)."""
    summary = wh.read(SUMMARY, ds, ds)
    day = wh.spark.range(1).select(F.lit(str(ds)).cast("date").alias("summary_date"))
    return report_lines(summary, days=day)


def _publish_reports(wh: Warehouse, lines: DataFrame, out_dir: str) -> list[str]:
    """Write every day's report in one job (one task and one file per day),
    staged, then move each day's file to ``out_dir/daily_report_<ds>.md``
    (one rename per day on the file system)."""
    from telewatch.session import scratch_path
    from telewatch.sources.tables import hadoop_fs

    staged = scratch_path(wh.spark, "reports")
    write_reports(lines, staged)
    fs, staged_path = hadoop_fs(wh.spark, staged)
    out = []
    for day_dir in fs.listStatus(staged_path):
        name = day_dir.getPath().getName()
        if not name.startswith("summary_date="):
            continue
        parts = [s.getPath() for s in fs.listStatus(day_dir.getPath()) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one report file in {day_dir.getPath()}, found {len(parts)}")
        target = f"{out_dir.rstrip('/')}/daily_report_{name.split('=', 1)[1]}.md"
        fs_out, target_path = hadoop_fs(wh.spark, target)
        fs_out.mkdirs(target_path.getParent())
        if fs_out.exists(target_path):
            fs_out.delete(target_path, False)
        if not fs.rename(parts[0], target_path):
            raise RuntimeError(f"could not move a report to {target}")
        out.append(target)
    fs.delete(staged_path, True)  # our own uniquely named staging folder
    return sorted(out)


def write_report(wh: Warehouse, ds, out_dir: str) -> str:
    """The day's report as ONE file, ``out_dir/daily_report_<ds>.md``.

    A day's report is one document (one line per reporting device), so a
    single writer task is intended.  Spark writes a folder with one part
    file; the part file is then renamed to the report's name (a metadata
    operation on the file system, no data through the driver).
    """
    from telewatch.session import scratch_path
    from telewatch.sources.tables import hadoop_fs

    staged = scratch_path(wh.spark, f"report-{ds}")
    (
        report_for_day(wh, ds)
        .coalesce(1)
        .sortWithinPartitions("line_no")
        .select("line")
        .write.mode("overwrite")
        .text(staged)
    )
    fs, staged_path = hadoop_fs(wh.spark, staged)
    parts = [s.getPath() for s in fs.listStatus(staged_path) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one report part file in {staged}, found {len(parts)}")
    target = f"{out_dir.rstrip('/')}/daily_report_{ds}.md"
    fs_out, target_path = hadoop_fs(wh.spark, target)
    fs_out.mkdirs(target_path.getParent())
    if fs_out.exists(target_path):
        fs_out.delete(target_path, False)
    if not fs.rename(parts[0], target_path):
        raise RuntimeError(f"could not move the report to {target}")
    fs.delete(staged_path, True)  # our own uniquely named staging folder
    return target


def run_daily(spark: SparkSession, root: str, ds, report_dir: str | None = None) -> dict:
    """The scheduled task: merge the day's devices, roll its counts up, upsert
    its summary, then write its report."""
    configure(spark)
    wh = Warehouse(spark, root)
    EventRegistry(spark, wh.root).fold()
    update_devices(wh, ds, ds)
    roll_up_days(wh, ds, ds)
    upsert_days(wh, ds)
    rows = wh.read_day(SUMMARY, ds).count()
    out = {"ds": str(ds), "device_rows": rows}
    if report_dir:
        out["report"] = write_report(wh, ds, report_dir)
    return out


def run_range(spark: SparkSession, root: str, start, end, report_dir: str | None = None) -> None:
    """Backfill ``start``..``end`` in one job; optionally write every day's
    report in one more job (one file per day, days without data included)."""
    configure(spark)
    wh = Warehouse(spark, root)
    update_devices(wh, start, end)
    roll_up_days(wh, start, end)
    upsert_days(wh, start, end)
    if report_dir:
        days = spark.sql(
            "SELECT explode(sequence(to_date(:start), to_date(:end), interval 1 day)) AS summary_date",
            args={"start": str(start), "end": str(end)},
        )
        lines = report_lines(wh.read(SUMMARY, start, end), days)
        _publish_reports(wh, lines, report_dir)


def roll_up_days(wh: Warehouse, start=None, end=None) -> dict[str, list[str]]:
    """Build every roll-up for the days of the range; the days covered."""
    return {name: wh.roll_up(name, start, end) for name in ROLLUPS}


def append_alerts(wh: Warehouse, alerts: DataFrame) -> None:
    """Batch writer for alerts (e.g. a backfill with new rules): appends the
    rows whose ids ``alerts`` lacks.  Running it twice adds nothing.  The input is
    read more than once, so it is kept meanwhile."""
    rows = alerts.withColumn("created_at", F.current_timestamp()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        wh.append_unique("alerts", rows)
    finally:
        rows.unpersist()
