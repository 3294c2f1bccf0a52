"""Registry of events, versions, arrivals, digests, gate, reasons, history."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from conftest import kafka_rows, payload

from pyspark.sql import functions as F

from telewatch.functions.enrich import enrich
from telewatch.functions.parse import is_rejected, reject_reasons
from telewatch.operators import quality
from telewatch.plans import catalog, daily, health
from telewatch.sources import devices as dimension
from telewatch.sources.registry import EventRegistry, Positions
from telewatch.sources.tables import Warehouse
from telewatch.sources.versions import Versions
from telewatch.streaming import jobs, sinks, supervise
from telewatch.streaming.sinks import ExternalSink, FanOut


def _batch(spark, messages, first=0):
    rows = kafka_rows(spark, messages).withColumn("offset", F.col("offset") + first)
    return jobs.parsed_stream(rows, provenance=True)


def _ingestion(spark, root, **more):
    return FanOut(Warehouse(spark, root), f"{root}/ckpt", enrich, jobs._ingestion_sinks(True), job="ingestion", **more)


def _stored(wh):
    return sorted((r.event_id, r.cpu_usage, str(r.event_timestamp)[:10]) for r in wh.read("raw_network_events").collect())


# --- one id, one row ---------------------------------------------------------


def test_first_message_of_an_id_wins(spark, scratch):
    fan, wh = _ingestion(spark, scratch), Warehouse(spark, scratch)
    later = {"timestamp": "2024-03-09T12:00:00.000Z"}
    # in one batch the least offset counts, whatever the payload and the day
    fan(_batch(spark, [payload(event_id="a", cpu_usage=70.0), payload(event_id="a", cpu_usage=5.0, **later)]), 0)
    fan(_batch(spark, [payload(event_id="a", cpu_usage=1.0, **later), payload(event_id="b")], 2), 1)
    expected = [("a", 70.0, "2024-03-01"), ("b", 10.0, "2024-03-01")]
    assert _stored(wh) == expected
    EventRegistry(spark, scratch).fold()
    fan(_batch(spark, [payload(event_id="b", cpu_usage=2.0, **later), payload(event_id="c")], 4), 2)
    assert _stored(wh) == [*expected, ("c", 10.0, "2024-03-01")]
    assert wh.read("bronze").count() == 6  # the archive keeps every message
    assert [r.event_id for r in wh.read("processed_network_events").orderBy("event_id").collect()] == ["a", "b", "c"]


def test_a_rejected_message_does_not_own_the_id(spark, scratch):
    fan, wh = _ingestion(spark, scratch), Warehouse(spark, scratch)
    fan(_batch(spark, [payload(event_id="a", region=None), payload(event_id="a")]), 0)
    assert [r.event_id for r in wh.read("raw_network_events").collect()] == ["a"] and wh.read("rejects").count() == 1


@pytest.mark.parametrize("dies_in", ["raw_network_events", "rejects"])
def test_a_batch_that_died_half_way_is_completed(spark, scratch, monkeypatch, dies_in):
    """The ids are registered, some tables written: the replay adds the rest."""
    fan, wh = _ingestion(spark, scratch, parallel=False), Warehouse(spark, scratch)
    batch = _batch(spark, [payload(event_id="a"), payload(event_id="a", cpu_usage=1.0), payload(event_id="b"), "{bad"])
    append = Warehouse.append

    def failing(self, table, *rest, **more):
        if table == dies_in:
            raise OSError("lost")
        return append(self, table, *rest, **more)

    monkeypatch.setattr(Warehouse, "append", failing)
    with pytest.raises(OSError):
        fan(batch, 0)
    monkeypatch.undo()
    fan(batch, 0)
    assert [x[0] for x in _stored(wh)] == ["a", "b"]
    assert wh.read("bronze").count() == 4 and wh.read("rejects").count() == 1 and wh.read("processed_network_events").count() == 2


def test_both_jobs_choose_the_same_version(spark, scratch):
    messages = [payload(event_id="a", cpu_usage=95.0), payload(event_id="a", memory_usage=95.0), payload(event_id="b", latency_ms=250.0)]
    kafka_rows(spark, messages).write.parquet(f"{scratch}/frame")
    wh = Warehouse(spark, f"{scratch}/wh")
    for which, start in (("alerting", jobs.start_alerting), ("ingestion", jobs.start_ingestion)):
        stream = sinks_source(spark, f"{scratch}/frame")
        jobs.run_available(start(stream, wh, f"{scratch}/{which}", trigger={"availableNow": True}, name=f"same_{which}"))
    assert [r.alert_type for r in wh.read("alerts").orderBy("alert_type").collect()] == ["CPU_HIGH", "LATENCY_HIGH"]
    assert {r.event_id: r.cpu_usage for r in wh.read("raw_network_events").collect()} == {"a": 95.0, "b": 10.0}


def sinks_source(spark, path):
    from telewatch.streaming.sources import kafka_files_stream

    return kafka_files_stream(spark, path)


def test_later_messages_come_in_a_file_per_core_and_one_trigger(spark, scratch, monkeypatch):
    """k9_one_version_per_id: no single task writes or reads all the messages that
    come later, and those of one event never fall into two triggers."""
    rows = [(k, dt.datetime(2024, 1, 1 + k % 3), k, "view", 1.0, '{"k": 5}') for k in range(350)]
    events = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, events).write.parquet(f"{scratch}/events.parquet")
    run, seen = catalog._run_stream, []
    monkeypatch.setattr(catalog, "_run_stream", lambda fx, which, wh, files: seen.append((wh, files)) or run(fx, which, wh, files))
    got = catalog.queries()["k9_one_version_per_id"](spark, scratch).where("table_name = 'raw_network_events'")
    assert got.count() == got.select("event_id").distinct().count() == 350 + 50
    assert got.where("event_timestamp >= '2031-01-01'").count() == 0
    (wh, files) = seen[0]
    later = spark.read.parquet(files).where(F.col("offset") >= 10**9)
    later = later.select((F.col("offset") % 10**9).alias("event"), F.input_file_name().alias("file"))
    cores = spark.sparkContext.defaultParallelism
    assert min(cores, 2) <= later.select("file").distinct().count() <= cores
    assert later.count() == 2 * 70 + 2 * 50
    assert later.groupBy("event").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0
    triggers = os.listdir(f"{wh.root}/_checkpoints/ingestion/commits")
    assert len([t for t in triggers if t.isdigit()]) == 3  # two of the first run, one of the later messages


def test_registry_reads_only_touched_buckets(spark, scratch):
    registry = EventRegistry(spark, scratch, buckets=8)
    rows = spark.range(400).selectExpr("concat('e', id) AS event_id", "0 AS kafka_partition", "id AS kafka_offset")
    registry.add(rows)
    assert registry.fold() > 0 and registry.fold() == 0
    assert registry.entries().count() == 400
    some = registry.entries([3])
    assert 0 < some.count() < 200
    assert "PartitionFilters: [isnotnull(bucket" in some._jdf.queryExecution().executedPlan().toString()
    admitted = registry.admit(rows.withColumn("kafka_offset", F.col("kafka_offset") + F.col("kafka_offset") % 2 * 1001).persist(), F.lit(True))
    assert admitted.duplicates == 200 and admitted.rows.count() == 200


def test_positions_know_what_was_begun(spark, scratch):
    p = Positions(spark, scratch, "job")
    assert not p.begin({0: (0, 9), 1: (5, 6)})
    assert not p.begin({0: (10, 19), 2: (0, 3)})
    assert p.begin({0: (19, 25)}) and p.begin({1: (6, 6)}) and not p.begin({0: (26, 26)})
    assert not Positions(spark, scratch, "other").begin({0: (0, 9)})


def test_rows_of_one_key_choose_alike(spark):
    from telewatch.operators.merge import unique_append

    rows = spark.range(2000).selectExpr("concat('k', id % 1000) AS k", "id AS v", "concat('x', id) AS w", "parse_json('{}') AS j")
    one = unique_append(rows.repartition(7), None, ["k"]).select("k", "v")
    two = unique_append(rows.repartition(3).select("k", "v"), None, ["k"])
    assert sorted(one.collect()) == sorted(two.collect())


# --- versions ------------------------------------------------------------------


def test_a_version_counts_when_committed(spark, scratch, monkeypatch):
    table = Versions(spark, f"{scratch}/t", "a INT")
    assert table.read() is None
    for k in (1, 2, 3):
        table.write(spark.createDataFrame([(k,)], "a INT"))
    monkeypatch.setattr(Versions, "commit", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.write(spark.createDataFrame([(9,)], "a INT"))
    monkeypatch.undo()
    assert [r.a for r in table.read().collect()] == [3]
    table.write(table.read().selectExpr("a + 1 AS a"))  # it may read itself
    assert [r.a for r in table.read().collect()] == [4] and len(table.committed()) == 2


def test_devices_survive_a_crash_between_the_steps(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    new = spark.createDataFrame([("NEW-1", "router", "Giza")], "device_id STRING, device_type STRING, region STRING")
    dimension.register_devices(wh, new)
    before = sorted(map(str, dimension.read_devices(wh).collect()))
    monkeypatch.setattr(Versions, "commit", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        dimension.register_devices(wh, new.withColumn("device_id", F.lit("NEW-2")))
    monkeypatch.undo()
    assert sorted(map(str, dimension.read_devices(wh).collect())) == before and len(before) == 27
    dimension.register_devices(wh, new.withColumn("region", F.lit("Cairo")))
    assert dimension.read_devices(wh).where("device_id = 'NEW-1'").first().region == "Giza"


def _summary(spark, days, events):
    rows = [(dt.date(2024, 3, d), f"d-{i}", events) for d in days for i in range(3)]
    out = spark.createDataFrame(rows, "summary_date DATE, device_id STRING, total_events BIGINT")
    return out.select(*[F.col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in Warehouse(spark, "x").spec(daily.SUMMARY).schema])


def test_a_day_is_old_or_new_after_a_crash(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    wh.overwrite_partitions(daily.SUMMARY, _summary(spark, [1, 2], 5))

    def total():
        return {r[0].day: r[1] for r in wh.read(daily.SUMMARY).groupBy("summary_date").sum("total_events").collect()}

    assert total() == {1: 15, 2: 15}
    hold = Warehouse._hold

    def second_fails(self, table, day, version):
        if day.endswith("02"):
            raise OSError("lost")
        hold(self, table, day, version)

    monkeypatch.setattr(Warehouse, "_hold", second_fails)
    with pytest.raises(OSError):
        wh.overwrite_partitions(daily.SUMMARY, _summary(spark, [1, 2, 3], 7))
    monkeypatch.undo()
    assert total() == {1: 21, 2: 15}
    for _ in range(3):
        wh.overwrite_partitions(daily.SUMMARY, _summary(spark, [1, 2, 3], 7))
    assert total() == {1: 21, 2: 21, 3: 21}
    assert max(len(v) for v in wh._versions(daily.SUMMARY).values()) == 2  # older versions go
    wh.drop_days(daily.SUMMARY, ["2024-03-02"])
    assert total() == {1: 21, 3: 21} and wh.days(daily.SUMMARY) == ["2024-03-01", "2024-03-03"]


def test_days_written_before_versions_still_read(spark, scratch):
    wh = Warehouse(spark, scratch)
    _summary(spark, [1, 2], 5).write.partitionBy("summary_date").parquet(wh.path(daily.SUMMARY))
    wh.overwrite_partitions(daily.SUMMARY, _summary(spark, [2], 7))
    assert {(r.summary_date.day, r.total_events) for r in wh.read(daily.SUMMARY).collect()} == {(1, 5), (2, 7)}


# --- arrivals and digests --------------------------------------------------------


def _events(spark, n, day=1, at="2024-03-05 10:00:00"):
    rows = spark.range(n).selectExpr(f"concat('e{day}-', id) AS event_id", f"timestamp'2024-03-0{day} 01:00:00' AS event_timestamp", "'d' AS device_id")
    return rows.withColumn("ingested_at", F.lit(at).cast("timestamp"))


def _days_read(monkeypatch) -> list[tuple[str, str]]:
    """(table, day) of every day that is read from here on."""
    read, read_days = [], Warehouse.read_days

    def noting(self, table, days):
        days = list(days)
        read.extend((table, d) for d in days)
        return read_days(self, table, days)

    monkeypatch.setattr(Warehouse, "read_days", noting)
    return read


def test_the_gate_opens_no_raw_file(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    for hour in range(0, 24, 6):
        for day in (1, 5, 7):
            wh.append("raw_network_events", _events(spark, 10, 1, f"2024-03-0{day} {hour:02d}:30:00"))
    read = _days_read(monkeypatch)
    as_of = dt.datetime(2024, 3, 7, 19, 0, tzinfo=dt.UTC)
    assert health.check_recent_events(spark, scratch, as_of) == 10
    assert read == [("arrivals", "2024-03-07")]
    with pytest.raises(RuntimeError, match="stale"):
        health.check_recent_events(spark, scratch, as_of + dt.timedelta(hours=3))
    assert health.freshness_status(spark, scratch, as_of, hours=30).first().recent_rows == 40


def test_arrivals_are_noted_once(spark, scratch):
    fan, wh = _ingestion(spark, scratch), Warehouse(spark, scratch)
    batch = _batch(spark, [payload(event_id=f"e-{i}") for i in range(5)] + ["{bad"] + [payload(event_id="e-0")])
    fan(batch, 0)
    fan(batch, 1)  # the same messages once more
    assert wh.read("arrivals").groupBy().sum("rows").first()[0] == 5
    assert health.check_recent_events(spark, scratch) == 5


def test_equal_days_are_not_read_again(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    for day in (1, 2, 3):
        rows = _events(spark, 50, day)
        wh.append("raw_network_events", rows.where("event_id != 'e2-7'"))
        wh.append("processed_network_events", rows.where("event_id NOT IN ('e2-8', 'e2-9')").drop("ingested_at").withColumn("processed_at", F.now()))
    for name in ("raw_digests", "processed_digests"):
        wh.roll_up(name)
    read = _days_read(monkeypatch)
    rows = [tuple(r) for r in health.reconcile_tables(wh).collect()]
    assert rows == [(dt.date(2024, 3, 2), 47, 1, 2)]
    full = [x for x in read if not x[0].endswith("_digests")]
    assert sorted(full) == [("processed_network_events", "2024-03-02"), ("raw_network_events", "2024-03-02")]


def test_two_pass_keys_equal_grouping(spark):
    rows = spark.range(1000).selectExpr("if(id % 10 = 0, NULL, concat('k', id % 400)) AS k", "id % 3 AS j")
    for key in (["k"], ["k", "j"], ["j"]):
        counts = [r.n for r in rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).collect()]
        got = quality.key_report("t", rows, key).first()
        assert tuple(got) == ("t", 1000, len(counts), sum(n > 1 for n in counts), 1000 - len(counts))
    assert tuple(quality.key_report("t", rows.limit(0), ["k"]).first()) == ("t", 0, 0, 0, 0)


# --- gate, reasons, sinks, history ------------------------------------------------


def test_held_events_come_in_once_their_device_is_known(spark, scratch):
    wh = Warehouse(spark, scratch)
    fan = FanOut(wh, f"{scratch}/ckpt", enrich, jobs._ingestion_sinks(True, True), job="ingestion", gate=jobs.device_gate(wh))
    fan(_batch(spark, [payload(event_id="a"), payload(event_id="b", device_id="NEW-1", cpu_usage=95.0), payload(event_id="c", device_id="NEW-2")]), 0)
    assert [x[0] for x in _stored(wh)] == ["a"] and jobs.held_events(wh).count() == 2 and wh.read("bronze").count() == 3
    assert wh.read("arrivals").groupBy().sum("rows").first()[0] == 1
    assert jobs.readmit(wh) == 0
    dimension.register_devices(wh, spark.createDataFrame([("NEW-1", "router", "Giza")], "device_id STRING, device_type STRING, region STRING"))
    assert jobs.readmit(wh) == 1 and jobs.readmit(wh) == 0
    assert [x[0] for x in _stored(wh)] == ["a", "b"] and [r.event_id for r in jobs.held_events(wh).collect()] == ["c"]
    assert [r.alert_type for r in wh.read("alerts").collect()] == ["CPU_HIGH"]


def test_reject_reasons(spark, missing):
    cases = [
        (payload(), []), ("{broken", ["malformed"]), (None, ["malformed"]), ("[1]", ["malformed"]),
        (payload(region=missing), ["missing:region"]), (payload(region=7.5), []),
        (payload(timestamp="soon"), ["bad:event_timestamp"]), (payload(timestamp=missing), ["missing:event_timestamp"]),
        (payload(event_id="x" * 37, device_id=None), ["missing:device_id", "too_long:event_id"]), (payload(cpu_usage="hot"), []),
    ]
    rows = _batch(spark, [m for m, _ in cases]).select("kafka_offset", is_rejected().alias("bad"), reject_reasons().alias("why")).collect()
    for r in rows:
        assert sorted(r.why) == sorted(cases[r.kafka_offset][1]) and r.bad == bool(r.why), cases[r.kafka_offset]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_external_key_range_does_not_depend_on_the_zone(spark, scratch, monkeypatch, zone):
    asked, before = [], os.environ.get("TZ")
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        def read_keys(session, low, high):
            asked.append((low, high))
            return session.createDataFrame([], "event_id STRING")

        sink = ExternalSink(lambda df: df.where(~is_rejected()), lambda df, batch: df.count(), ("event_id",), "event_timestamp", read_keys)
        sink(_batch(spark, [payload(event_id="a"), payload(event_id="b", timestamp="2024-03-01T12:00:05.250Z")]), 0)
    finally:
        monkeypatch.undo()
        time.tzset()
    assert asked == [("2024-03-01 12:00:00.000000+00:00", "2024-03-01 12:00:05.250000+00:00")] and os.environ.get("TZ") == before


class _Event:
    def __init__(self, **values):
        self.__dict__.update(values)


def test_history_outlives_restarts_and_failed_writes(spark, scratch, monkeypatch):
    first = supervise.StatusListener()
    first.onQueryStarted(_Event(name="q", id="1", runId="r1", timestamp="2024-03-01T10:00:00.000Z"))
    first.onQueryTerminated(_Event(id="1", runId="r1", exception="boom"))
    assert supervise.read_history(spark, scratch).count() == 0
    with pytest.raises(Exception):
        supervise.append_history(spark, first, "nowhere://x")
    assert supervise.append_history(spark, first, scratch) == 2 and supervise.append_history(spark, first, scratch) == 0
    second = supervise.StatusListener()  # another process
    second.onQueryStarted(_Event(name="q", id="1", runId="r2", timestamp="2024-03-02T10:00:00.000Z"))
    supervise.append_history(spark, second, scratch)
    second.put_back([("started", "q", "1", "r2", None, None, None, None, "2024-03-02T10:00:00.000Z")])  # written twice
    supervise.append_history(spark, second, scratch)
    rows = [(r.query_name, r.run_id, r.kind, r.exception) for r in supervise.read_history(spark, scratch).orderBy("run_id", "kind").collect()]
    assert rows == [("q", "r1", "failed", "boom"), ("q", "r1", "started", None), ("q", "r2", "started", None)]
