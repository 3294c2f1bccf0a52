"""Streaming: replay safety of the fan-out sink, empty batches, supervision."""

from __future__ import annotations

import pytest
from conftest import kafka_rows, payload

from pyspark.sql import functions as F

from telewatch.functions.enrich import enrich
from telewatch.sources.tables import Warehouse
from telewatch.streaming.jobs import _ingestion_sinks, parsed_stream, run_available, start_alerting
from telewatch.streaming.sinks import BatchLedger, FanOut
from telewatch.streaming.sources import kafka_files_stream
from telewatch.streaming.supervise import attach_listener, supervise


def _batch(spark, n=5):
    values = [payload(event_id=f"e-{i}", cpu_usage=95.0) for i in range(n)] + ["{broken"]
    return parsed_stream(kafka_rows(spark, values), provenance=True)


def test_fanout_replay_is_effectively_once(spark, scratch):
    wh = Warehouse(spark, scratch)
    fan = FanOut(wh, f"{scratch}/ckpt", enrich, _ingestion_sinks(include_bronze=True))
    batch = _batch(spark)
    fan(batch, 0)
    counts = {t: wh.read(t).count() for t in ("bronze", "raw_network_events", "rejects")}
    assert counts == {"bronze": 6, "raw_network_events": 5, "rejects": 1}
    fan(batch, 0)  # replay of a completed batch: skipped by the ledger
    assert wh.read("raw_network_events").count() == 5
    # the same messages under the next batch id (or after a crash): nothing is added
    ledger = BatchLedger(spark, f"{scratch}/ckpt")
    assert not ledger.is_done(1)
    fan(batch, 1)
    assert wh.read("raw_network_events").count() == 5
    assert wh.read("rejects").count() == 1 and wh.read("bronze").count() == 6
    assert ledger.is_done(1) and not ledger.is_done(0)  # older markers are purged
    # an event delivered twice in one batch is stored once
    twice = parsed_stream(kafka_rows(spark, [payload(event_id="e-t"), payload(event_id="e-t")]), provenance=True)
    fan(twice, 10)
    assert wh.read("raw_network_events").count() == 6 and wh.read("bronze").count() == 6
    spark_rows = wh.read("raw_network_events").where("event_id = 'e-t'").count()
    assert spark_rows == 1
    # a genuinely new batch appends
    fan(parsed_stream(kafka_rows(spark, [payload(event_id="e-new")]), provenance=True), 12)
    assert wh.read("raw_network_events").count() == 7


def test_empty_batch_writes_nothing(spark, scratch):
    wh = Warehouse(spark, scratch)
    fan = FanOut(wh, f"{scratch}/ckpt", enrich, _ingestion_sinks(include_bronze=True))
    fan(_batch(spark).limit(0), 0)
    assert not wh.exists("raw_network_events")
    assert BatchLedger(spark, f"{scratch}/ckpt").is_done(0)


def test_alert_stream_matches_batch_and_supervisor_returns(spark, scratch):
    from telewatch.functions.parse import parse_kafka, split_rejects
    from telewatch.operators.alerts import detect_alerts

    frame = kafka_rows(spark, [payload(event_id=f"e-{i}", latency_ms=250.0 + i) for i in range(4)] + [None])
    frame.write.parquet(f"{scratch}/frame")
    wh = Warehouse(spark, f"{scratch}/wh")
    listener = attach_listener(spark)
    q = start_alerting(kafka_files_stream(spark, f"{scratch}/frame"), wh, f"{scratch}/ckpt",
                       trigger={"availableNow": True}, name="alerts_test")
    supervise(spark, [q], poll_s=0.2)
    run_available(q)
    streamed = sorted(r["alert_id"] for r in wh.read("alerts").collect())
    accepted, _ = split_rejects(parse_kafka(frame, provenance=True))
    batch = sorted(r["alert_id"] for r in detect_alerts(enrich(accepted)).collect())
    assert streamed == batch and len(batch) == 4
    assert "created_at" in wh.read("alerts").columns
    import time

    for _ in range(50):  # listener events arrive asynchronously
        st = listener.snapshot().get("alerts_test", {})
        if st.get("state") == "stopped":
            break
        time.sleep(0.1)
    assert st.get("state") == "stopped" and st.get("exception") is None
    assert st.get("input_rows") is not None
    row = listener.status_frame(spark).filter("query_name = 'alerts_test'").first()
    assert row["state"] == "stopped" and row["batch_id"] is not None


def test_supervise_raises_named_failure(spark, scratch):
    frame = kafka_rows(spark, [payload()])
    frame.write.parquet(f"{scratch}/frame")

    def boom(df, batch_id):
        raise ValueError("sink down")

    q = (
        parsed_stream(kafka_files_stream(spark, f"{scratch}/frame"))
        .writeStream.queryName("failing_sink")
        .foreachBatch(boom)
        .option("checkpointLocation", f"{scratch}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    with pytest.raises(RuntimeError, match="failing_sink"):
        supervise(spark, [q], poll_s=0.2)


def test_late_events_and_rejects_are_all_kept(spark, scratch):
    from telewatch.streaming.jobs import start_ingestion

    late = payload(event_id="late", timestamp="2024-02-29T12:30:00.000Z")
    ahead = payload(event_id="ahead", timestamp="2034-03-01T12:00:00.000Z")
    frames = [[payload(event_id="dup"), ahead], [payload(event_id="dup"), late, "{bad", None]]
    offset = 0
    for k, values in enumerate(frames):
        rows = kafka_rows(spark, values).withColumn("offset", F.col("offset") + offset)
        offset += len(values)
        rows.coalesce(1).write.parquet(f"{scratch}/frame/f{k}")
    wh = Warehouse(spark, f"{scratch}/wh")
    q = start_ingestion(kafka_files_stream(spark, f"{scratch}/frame/*", max_files_per_trigger=1), wh, f"{scratch}/ckpt",
                        trigger={"availableNow": True}, name="late_test")
    run_available(q)
    assert sorted(r["event_id"] for r in wh.read("raw_network_events").collect()) == ["ahead", "dup", "late"]
    assert wh.read("rejects").count() == 2 and wh.read("bronze").count() == 6


def test_quarantine_holds_rows_the_table_cannot(spark, scratch):
    wh = Warehouse(spark, scratch)
    fan = FanOut(wh, f"{scratch}/ckpt", enrich, _ingestion_sinks(include_bronze=False))
    values = [payload(event_id="ok"), payload(event_id="x" * 37), payload(event_id="r", region=None), payload(event_id="w", device_id="d" * 21)]
    fan(parsed_stream(kafka_rows(spark, values), provenance=True), 0)
    assert [r["event_id"] for r in wh.read("raw_network_events").collect()] == ["ok"]
    assert wh.read("rejects").count() == 3


def test_alerts_of_events_without_a_time_stay_in_silver(spark, scratch):
    frame = kafka_rows(spark, [payload(event_id="a", cpu_usage=99.0), payload(event_id="b", cpu_usage=99.0, timestamp="soon")])
    frame.write.parquet(f"{scratch}/frame")
    wh = Warehouse(spark, f"{scratch}/wh")
    run_available(start_alerting(kafka_files_stream(spark, f"{scratch}/frame"), wh, f"{scratch}/ckpt",
                                 trigger={"availableNow": True}, name="timeless_test"))
    assert sorted(r["event_id"] for r in wh.read("silver_alerts").collect()) == ["a", "b"]
    assert [r["event_id"] for r in wh.read("alerts").collect()] == ["a"]


def test_timeout_is_a_failure(spark, scratch):
    frame = kafka_rows(spark, [payload()])
    frame.write.parquet(f"{scratch}/frame")
    q = parsed_stream(kafka_files_stream(spark, f"{scratch}/frame")).writeStream.format("noop").option(
        "checkpointLocation", f"{scratch}/ckpt").trigger(processingTime="1 second").start()
    try:
        with pytest.raises(TimeoutError):
            run_available(q, timeout_s=1)
    finally:
        q.stop()


def test_external_sink_passes_a_primary_key(spark, scratch):
    """A target that rejects keys it holds: a replay after a partial write, and
    an event delivered again later, must both go through."""
    from telewatch.streaming.sinks import ExternalSink

    stored = {}

    def write(df, batch_id):
        for r in df.collect():
            if r["event_id"] in stored:
                raise ValueError(f"duplicate key {r['event_id']}")
            stored[r["event_id"]] = batch_id
            if fail_after and len(stored) == fail_after[0]:
                fail_after.clear()
                raise ValueError("connection lost")

    def read_keys(session, low, high):
        return session.createDataFrame([(k,) for k in stored], "event_id STRING")

    sink = ExternalSink(lambda df: df.where("event_id IS NOT NULL"), write, ("event_id",), "event_timestamp", read_keys)
    fan = FanOut(Warehouse(spark, scratch), f"{scratch}/ckpt", enrich, _ingestion_sinks(False), [sink])
    batch, fail_after = _batch(spark), [3]
    with pytest.raises(ValueError, match="connection lost"):
        fan(batch, 0)
    fan(batch, 0)
    fan(batch, 1)
    assert sorted(stored) == [f"e-{i}" for i in range(5)]
    assert Warehouse(spark, scratch).read("raw_network_events").count() == 5


def test_status_table(spark, scratch):
    from telewatch.streaming.supervise import write_status

    kafka_rows(spark, [payload()]).write.parquet(f"{scratch}/frame")
    listener = attach_listener(spark)
    q = start_alerting(kafka_files_stream(spark, f"{scratch}/frame"), Warehouse(spark, f"{scratch}/wh"), f"{scratch}/ckpt",
                       trigger={"availableNow": True}, name="status_test")
    supervise(spark, [q], poll_s=0.2, on_poll=lambda: write_status(spark, listener, scratch))
    write_status(spark, listener, scratch, settle_s=5.0)
    row = spark.read.parquet(f"{scratch}/stream_status").where("query_name = 'status_test'").first()
    assert row["state"] == "stopped" and row["exception"] is None


def test_external_sinks_run_once_per_batch_with_fact_projection(spark, scratch):
    from telewatch.schemas import PROCESSED_EVENT_COLUMNS, RAW_EVENT_COLUMNS
    from telewatch.streaming import jobs
    from telewatch.streaming.sinks import ExternalSink

    seen = []
    extras = [
        ExternalSink(s.project, lambda df, bid: seen.append((bid, tuple(df.columns), df.count())))
        for s in jobs.jdbc_fact_sinks("jdbc:none://nowhere/db", "ingestion")
    ]
    fan = FanOut(Warehouse(spark, scratch), f"{scratch}/ckpt", enrich, _ingestion_sinks(False), extras)
    batch = _batch(spark)
    fan(batch, 0)
    fan(batch, 0)  # replay of a completed batch: extras not called again
    assert sorted(seen) == sorted([(0, RAW_EVENT_COLUMNS, 5), (0, PROCESSED_EVENT_COLUMNS, 5)])


def test_restart_after_lost_commit_writes_nothing_twice(spark, scratch):
    """Remove the last commit from the checkpoint: Spark replays that
    micro-batch on restart; the ledger must skip it."""
    import os

    from telewatch.streaming.jobs import start_ingestion

    values = [payload(event_id=f"e-{i}") for i in range(6)]
    for i in range(3):  # three files -> three micro-batches
        rows = kafka_rows(spark, values[2 * i: 2 * i + 2]).withColumn("offset", F.col("offset") + 2 * i)
        rows.coalesce(1).write.parquet(f"{scratch}/frame/f{i}")
    src_glob = f"{scratch}/frame/*"
    wh = Warehouse(spark, f"{scratch}/wh")
    ckpt = f"{scratch}/ckpt"

    def run():
        q = start_ingestion(kafka_files_stream(spark, src_glob, max_files_per_trigger=1), wh, ckpt,
                            trigger={"availableNow": True}, name=f"replay_{len(os.listdir(ckpt + '/commits')) if os.path.exists(ckpt + '/commits') else 0}")
        run_available(q)

    run()
    assert wh.read("raw_network_events").count() == 6
    commits = sorted(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    assert commits == [0, 1, 2]
    os.remove(f"{ckpt}/commits/{commits[-1]}")
    crc = f"{ckpt}/commits/.{commits[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert sorted(os.listdir(f"{ckpt}/commits")).count(str(commits[-1])) == 1  # batch 2 re-ran
    assert wh.read("raw_network_events").count() == 6
    assert wh.read("bronze").count() == 6


def test_console_preview_runs(spark, scratch, capfd):
    from telewatch.streaming.sinks import console_preview

    kafka_rows(spark, [payload()]).write.parquet(f"{scratch}/frame")
    q = console_preview(parsed_stream(kafka_files_stream(spark, f"{scratch}/frame")),
                        trigger={"availableNow": True}, name="preview_test")
    run_available(q)


def test_kafka_source_needs_only_the_connector(spark):
    """No Kafka connector ships here: the source is built up to Spark's
    data-source lookup, which is the only thing that fails."""
    from telewatch.streaming.sources import kafka_stream

    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_stream(spark, "localhost:1", starting_offsets="latest")


def test_alerts_of_two_streams_are_counted_once(spark, scratch):
    from telewatch.operators.alerts import detect_alerts
    from telewatch.streaming.sinks import TableSink

    wh = Warehouse(spark, scratch)
    batch = _batch(spark)  # five CPU_HIGH events
    for ckpt in ("one", "two"):
        FanOut(wh, f"{scratch}/{ckpt}", detect_alerts, [TableSink("alerts", lambda df: df)])(batch, 0)
        wh.roll_up("alert_counts")
    assert wh.read("alerts").count() == 5
    assert wh.counts("alert_counts").groupBy().sum("alerts").first()[0] == 5


def test_fixture_frame_has_kafka_shape(spark):
    from conftest import SF001

    from telewatch.sources.fixtures import kafka_frame_from_events, read_events
    from telewatch.streaming.sources import KAFKA_SCHEMA

    frame = kafka_frame_from_events(read_events(spark, SF001))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in KAFKA_SCHEMA]
    row = frame.filter("offset = 0").first()
    assert row["key"].decode() == row["value"].decode().split('"device_id":"')[1].split('"')[0]
    assert 0 <= row["partition"] < 3
