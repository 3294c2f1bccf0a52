"""Daily report as Markdown lines.

The report is a DataFrame of ``(summary_date, line_no, line)`` built with
``format_string`` — header and totals from a per-day aggregate, one table row
per device — so any number of days is produced by one distributed job.  The
device rows are numbered with ``row_number`` over a window partitioned by
day: a day's window holds one row per device that reported that day (the
summary is already one row per device-day), never the raw readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Report text.
TITLE = "# Daily Network Monitoring Report — %s"
EMPTY_DAY = "No data recorded for this date."
TOTAL_EVENTS = "- **Total events:** %d"
TOTAL_ALERTS = "- **Total alerts:** %d"
TABLE_HEADER = "| Device | Region | Events | Alerts | Critical | High | Medium |"
TABLE_RULE = "|---|---|---|---|---|---|---|"
TABLE_ROW = "| %s | %s | %d | %d | %d | %d | %d |"

FIRST_ROW_LINE = 7  # line number of the first device row


def report_lines(summary: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Report lines for every day in ``summary`` (plus every day listed in
    ``days``, a one-column ``summary_date`` frame, which gets the empty-day
    text when it has no rows)."""
    totals = summary.groupBy("summary_date").agg(
        F.sum("total_events").alias("events"),
        F.sum("total_alerts").alias("alerts"),
    )
    if days is not None:
        totals = days.select("summary_date").distinct().join(totals, "summary_date", "left")
    has_rows = F.col("events").isNotNull()
    title = F.format_string(TITLE, F.date_format("summary_date", "yyyy-MM-dd"))
    header = totals.select(
        "summary_date",
        F.when(
            has_rows,
            F.array(
                title,
                F.lit(""),
                F.format_string(TOTAL_EVENTS, F.col("events")),
                F.format_string(TOTAL_ALERTS, F.col("alerts")),
                F.lit(""),
                F.lit(TABLE_HEADER),
                F.lit(TABLE_RULE),
            ),
        ).otherwise(F.array(title, F.lit(""), F.lit(EMPTY_DAY))).alias("lines"),
    ).select("summary_date", F.posexplode("lines").alias("line_no", "line"))

    order = Window.partitionBy("summary_date").orderBy(
        F.col("total_alerts").desc(), F.col("device_id")
    )
    rows = summary.select(
        "summary_date",
        (F.row_number().over(order) + F.lit(FIRST_ROW_LINE - 1)).alias("line_no"),
        F.format_string(
            TABLE_ROW,
            "device_id", "region", "total_events", "total_alerts",
            "critical_alerts", "high_alerts", "medium_alerts",
        ).alias("line"),
    )
    return header.select(
        "summary_date", F.col("line_no").cast("int").alias("line_no"), "line"
    ).unionByName(rows.select("summary_date", F.col("line_no").cast("int").alias("line_no"), "line"))


def write_reports(lines: DataFrame, path: str) -> None:
    """Write one text file per day under ``path/summary_date=…/``: rows are
    hash-partitioned by day (one writer per day, as one report is one file)
    and sorted by line number within it."""
    (
        lines.repartition("summary_date")
        .sortWithinPartitions("summary_date", "line_no")
        .select("summary_date", "line")
        .write.mode("overwrite")
        .partitionBy("summary_date")
        .text(path)
    )
