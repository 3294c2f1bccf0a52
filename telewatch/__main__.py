"""Command line: ``spark-submit -m telewatch <command> …`` or ``python -m telewatch``.

Commands mirror the reference's processes: the two streaming jobs, the daily
roll-up task, the hourly health task, plus backfill and compaction.
"""

from __future__ import annotations

import argparse
import json
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="telewatch")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    sub = p.add_subparsers(dest="cmd", required=True)

    def stream_args(sp, offsets):
        sp.add_argument("--root", required=True, help="warehouse root (shared storage)")
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--bootstrap", help="Kafka bootstrap servers")
        src.add_argument("--files", help="folder of Parquet files with Kafka's columns")
        sp.add_argument("--topic", default="network-events")
        sp.add_argument("--starting-offsets", default=offsets)
        sp.add_argument("--trigger", default="10 seconds", help="processing-time interval, or 'available-now'")
        sp.add_argument("--checkpoint", default=None)
        sp.add_argument("--min-partitions", type=int, default=None)
        sp.add_argument("--max-offsets-per-trigger", type=int, default=None)
        sp.add_argument("--jdbc-url", default=None,
                        help="also append the fact rows to these JDBC tables (credentials from env)")
        sp.add_argument("--jdbc-driver", default=None)
        sp.add_argument("--known-devices-only", action="store_true",
                        help="hold events of devices that the dimension lacks (see readmit)")

    ing = sub.add_parser("ingest", help="raw ingestion stream (bronze, raw, processed, rejects)")
    stream_args(ing, "earliest")
    ing.add_argument("--no-bronze", action="store_true")
    ing.add_argument("--console", action="store_true", help="also print the parsed rows (debugging)")

    alr = sub.add_parser("alerts", help="alert detection stream (silver alerts, alerts)")
    stream_args(alr, "latest")
    alr.add_argument("--rules", default=None, help="JSON file with the rule list; default: the built-in six")

    d = sub.add_parser("daily", help="upsert one day's summary and write its report")
    d.add_argument("--root", required=True)
    d.add_argument("--ds", required=True)
    d.add_argument("--report-dir", default=None)

    b = sub.add_parser("backfill", help="upsert the summaries of a date range in one job")
    b.add_argument("--root", required=True)
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    b.add_argument("--report-dir", default=None)

    h = sub.add_parser("health", help="fail when nothing arrived in the last hours")
    h.add_argument("--root", required=True)
    h.add_argument("--hours", type=int, default=1)

    db = sub.add_parser("dashboard", help="print every panel as JSON")
    db.add_argument("--root", required=True)
    db.add_argument("--as-of", default=None, help="ISO time, UTC unless it names a zone; default now")
    db.add_argument("--from", dest="start", default=None, help="start of the trend panels' range (ISO)")
    db.add_argument("--to", dest="end", default=None, help="end of the trend panels' range (ISO)")

    ru = sub.add_parser("rollup", help="build the per-day counts that the all-time panels sum")
    ru.add_argument("--root", required=True)
    ru.add_argument("--start", default=None)
    ru.add_argument("--end", default=None)

    rd = sub.add_parser("register-devices", help="insert devices that the dimension lacks, from a CSV file with a header")
    rd.add_argument("--root", required=True)
    rd.add_argument("--csv", required=True, help="device_id, device_type, region")

    ra = sub.add_parser("readmit", help="store the held events whose device is known by now")
    ra.add_argument("--root", required=True)

    rc = sub.add_parser("reconcile", help="days on which raw and processed events differ")
    rc.add_argument("--root", required=True)
    rc.add_argument("--start", default=None)
    rc.add_argument("--end", default=None)

    hi = sub.add_parser("history", help="starts and ends of the streams, and failures, newest last")
    hi.add_argument("--root", required=True)
    hi.add_argument("--last", type=int, default=50)

    c = sub.add_parser("compact", help="rewrite date partitions into larger, device-sorted files")
    c.add_argument("--root", required=True)
    c.add_argument("--table", required=True)
    c.add_argument("--start", required=True)
    c.add_argument("--end", default=None)
    c.add_argument("--rows-per-file", type=int, default=2_000_000)
    return p


def _source(spark, args):
    from telewatch.streaming.sources import kafka_files_stream, kafka_stream

    if args.files:
        return kafka_files_stream(spark, args.files)
    return kafka_stream(
        spark,
        args.bootstrap,
        topic=args.topic,
        starting_offsets=args.starting_offsets,
        min_partitions=args.min_partitions or "auto",
        max_offsets_per_trigger=args.max_offsets_per_trigger,
    )


def _text(spark, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def _trigger(text: str) -> dict:
    return {"availableNow": True} if text == "available-now" else {"processingTime": text}


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from telewatch.session import build_session

    spark = build_session(args.master, app_name=f"telewatch-{args.cmd}")

    if args.cmd in ("ingest", "alerts"):
        from telewatch.sources.tables import Warehouse
        from telewatch.functions.rules import DEFAULT_RULES, load_rules
        from telewatch.streaming.jobs import (
            jdbc_fact_sinks,
            parsed_stream,
            start_alerting,
            start_ingestion,
            stream_checkpoint,
        )
        from telewatch.streaming.sinks import console_preview
        from telewatch.streaming.supervise import attach_listener, supervise, write_status

        wh = Warehouse(spark, args.root)
        name = "raw_ingestion" if args.cmd == "ingest" else "alert_detection"
        ckpt = args.checkpoint or stream_checkpoint(wh.root, name)
        listener = attach_listener(spark)
        job = "ingestion" if args.cmd == "ingest" else "alerts"
        extras = jdbc_fact_sinks(args.jdbc_url, job, driver=args.jdbc_driver) if args.jdbc_url else ()
        if args.cmd == "ingest":
            q = start_ingestion(_source(spark, args), wh, ckpt, _trigger(args.trigger),
                                include_bronze=not args.no_bronze, extra_writers=extras,
                                require_known_devices=args.known_devices_only)
        else:
            rules = load_rules(_text(spark, args.rules)) if args.rules else DEFAULT_RULES
            q = start_alerting(_source(spark, args), wh, ckpt, _trigger(args.trigger), rules, extra_writers=extras,
                               require_known_devices=args.known_devices_only)
        running = [q]
        if args.cmd == "ingest" and args.console:
            running.append(console_preview(parsed_stream(_source(spark, args)), _trigger(args.trigger)))
        try:
            supervise(spark, running, on_poll=lambda: write_status(spark, listener, wh.root))
        finally:
            write_status(spark, listener, wh.root, settle_s=5.0)
        return 0

    if args.cmd == "daily":
        from telewatch.plans.daily import run_daily

        print(json.dumps(run_daily(spark, args.root, args.ds, args.report_dir)))
    elif args.cmd == "backfill":
        from telewatch.plans.daily import run_range

        run_range(spark, args.root, args.start, args.end, args.report_dir)
    elif args.cmd == "health":
        from telewatch.plans.health import check_recent_events

        n = check_recent_events(spark, args.root, hours=args.hours)
        print(json.dumps({"recent_rows": n, "status": "OK"}))
    elif args.cmd == "dashboard":
        import datetime as dt

        from telewatch.plans.dashboard import kpi_row, panels

        as_of, start, end = (dt.datetime.fromisoformat(x) if x else None for x in (args.as_of, args.start, args.end))
        p = panels(spark, args.root, as_of, start, end)
        # aggregates, top-k lists, and one row per minute of the panel range
        out = {k: [r.asDict() for r in df.collect()] for k, df in p.items()}
        out["kpis"] = kpi_row(spark, p).first().asDict()
        print(json.dumps(out, default=str))
    elif args.cmd == "rollup":
        from telewatch.plans.daily import roll_up_days
        from telewatch.sources.tables import Warehouse

        print(json.dumps(roll_up_days(Warehouse(spark, args.root), args.start, args.end)))
    elif args.cmd == "register-devices":
        from telewatch.sources.devices import DEVICE_SCHEMA, read_devices, register_devices
        from telewatch.sources.tables import Warehouse

        wh = Warehouse(spark, args.root)
        register_devices(wh, spark.read.schema(DEVICE_SCHEMA).option("header", "true").csv(args.csv))
        print(json.dumps({"devices": read_devices(wh).count()}))
    elif args.cmd == "readmit":
        from telewatch.sources.tables import Warehouse
        from telewatch.streaming.jobs import held_events, readmit

        wh = Warehouse(spark, args.root)
        print(json.dumps({"released": readmit(wh), "held": held_events(wh).count()}))
    elif args.cmd == "reconcile":
        from telewatch.plans.health import reconcile_tables
        from telewatch.sources.tables import Warehouse

        days = reconcile_tables(Warehouse(spark, args.root), args.start, args.end).orderBy("event_date").collect()  # a row a day
        print(json.dumps([r.asDict() for r in days], default=str))
    elif args.cmd == "history":
        from telewatch.streaming.supervise import read_history

        rows = read_history(spark, args.root).where("kind != 'progress'").orderBy("reported_at", ascending=False).limit(args.last)
        print(json.dumps([r.asDict() for r in reversed(rows.collect())], default=str))
    elif args.cmd == "compact":
        from telewatch.sources.tables import Warehouse

        n = Warehouse(spark, args.root).compact(args.table, args.start, args.end, args.rows_per_file)
        print(json.dumps({"table": args.table, "files_written": n}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
