"""Warehouse reads and writes: pruned ranges, missing tables, staged overwrite."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from telewatch.schemas import TABLE_SCHEMAS
from telewatch.sources.tables import Warehouse


def _events(spark, days):
    rows = [(f"e{d}-{h}", dt.datetime(2024, 3, d, h)) for d in days for h in (0, 23)]
    return spark.createDataFrame(rows, "event_id STRING, event_timestamp TIMESTAMP")


def test_open_ended_ranges(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.append("raw_network_events", _events(spark, [1, 2, 3, 4]))
    ids = lambda df: sorted(r["event_id"] for r in df.collect())
    assert ids(wh.read("raw_network_events", start="2024-03-03")) == ["e3-0", "e3-23", "e4-0", "e4-23"]
    assert ids(wh.read("raw_network_events", end="2024-03-01")) == ["e1-0", "e1-23"]
    assert ids(wh.read("raw_network_events", dt.date(2024, 3, 2), dt.date(2024, 3, 2))) == ["e2-0", "e2-23"]
    assert wh.read("raw_network_events").count() == 8


def test_missing_and_empty_tables_read(spark, scratch):
    wh = Warehouse(spark, scratch)
    assert wh.read("alerts").count() == 0
    wh.append("raw_network_events", _events(spark, [1]).limit(0))  # a folder without a file
    assert wh.read("raw_network_events").columns == TABLE_SCHEMAS["raw_network_events"].names
    wh.append_unique("raw_network_events", _events(spark, [1]).limit(0))
    assert wh.read("raw_network_events").count() == 0
    wh.append_unique("raw_network_events", _events(spark, [1]))
    assert wh.read("raw_network_events").count() == 2


def test_append_enforces_the_key(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = _events(spark, [1, 2])
    wh.append_unique("raw_network_events", rows.unionByName(rows))
    wh.append_unique("raw_network_events", rows.unionByName(_events(spark, [3])))
    assert sorted(r["event_id"] for r in wh.read("raw_network_events").collect()) == ["e1-0", "e1-23", "e2-0", "e2-23", "e3-0", "e3-23"]


def test_rows_without_a_key_or_a_day_are_kept(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = spark.createDataFrame([(None, None, "d"), (None, None, "d"), ("a", None, "d")], "alert_id STRING, alert_timestamp TIMESTAMP, device_id STRING")
    wh.append_unique("silver_alerts", rows)
    wh.append_unique("silver_alerts", rows.where("alert_id = 'a'"))
    assert wh.read("silver_alerts").count() == 3
    assert wh.read("silver_alerts", start="2000-01-01").count() == 0


def test_reads_list_only_the_days_asked_for(spark, scratch):
    wh = Warehouse(spark, scratch)
    for _ in range(3):
        wh.append("raw_network_events", _events(spark, range(1, 21)).coalesce(1))
    assert len(wh.read("raw_network_events").inputFiles()) == 60
    one = wh.read_day("raw_network_events", "2024-03-07")
    assert len(one.inputFiles()) == 3 and one.count() == 6
    paths = one._jdf.queryExecution().analyzed().toString()
    assert "2024-03-08" not in paths


def test_overwrite_partitions_replaces_only_given_days(spark, scratch):
    wh = Warehouse(spark, scratch)
    wh.append("raw_network_events", _events(spark, [1, 2, 3]))
    day2 = wh.read_day("raw_network_events", "2024-03-02").filter("event_id = 'e2-0'")
    wh.overwrite_partitions("raw_network_events", day2)  # reads the table it rewrites: staged
    got = sorted(r["event_id"] for r in wh.read("raw_network_events").collect())
    assert got == ["e1-0", "e1-23", "e2-0", "e3-0", "e3-23"]


def _alerts(spark, ids, day=1):
    rows = [(f"a{i}", f"e{i}", dt.datetime(2024, 3, day, i % 24), "D", "router", "Giza", "CPU_HIGH", "HIGH", "x") for i in ids]
    return spark.createDataFrame(
        rows,
        "alert_id STRING, event_id STRING, alert_timestamp TIMESTAMP, device_id STRING, device_type STRING, "
        "region STRING, alert_type STRING, severity STRING, description STRING",
    )


def test_append_alerts_is_idempotent_and_counts_follow(spark, scratch):
    from telewatch.plans.daily import append_alerts, roll_up_days

    wh = Warehouse(spark, scratch)

    def total():
        return wh.counts("alert_counts").groupBy().sum("alerts").first()[0]

    append_alerts(wh, _alerts(spark, range(5)))
    append_alerts(wh, _alerts(spark, range(5)))
    assert wh.read("alerts").count() == total() == 5  # no roll-up yet
    append_alerts(wh, _alerts(spark, range(100, 103), day=2))
    assert wh.roll_up("alert_counts", "2024-03-02", "2024-03-02") == ["2024-03-02"]
    assert wh.days("alert_counts") == ["2024-03-02"] and total() == 8  # older days predate the roll-up
    append_alerts(wh, _alerts(spark, [200], day=2))  # late, on a covered day
    assert wh.days("alert_counts") == [] and total() == 9
    roll_up_days(wh)
    assert wh.days("alert_counts") == ["2024-03-01", "2024-03-02"] and total() == 9


def test_rollup_of_a_day_that_changes_meanwhile_is_dropped(spark, scratch, monkeypatch):
    from telewatch.plans.daily import append_alerts

    wh = Warehouse(spark, scratch)
    append_alerts(wh, _alerts(spark, range(5)))
    plain = Warehouse.overwrite_partitions

    def late(self, table, df):
        plain(self, table, df)
        _alerts(spark, [50]).withColumn("alert_date", F.to_date("alert_timestamp")).write.mode("append").partitionBy("alert_date").parquet(wh.path("alerts"))

    monkeypatch.setattr(Warehouse, "overwrite_partitions", late)
    assert wh.roll_up("alert_counts") == []
    assert wh.counts("alert_counts").groupBy().sum("alerts").first()[0] == 6


def test_compaction_layout(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = spark.range(4000).selectExpr(
        "CAST(id AS STRING) AS event_id", "TIMESTAMP '2024-03-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 86400) AS event_timestamp",
        "concat('D', id % 40) AS device_id",
    )
    for k in range(5):
        wh.append("raw_network_events", rows.where(f"id % 5 = {k}").repartition(3))
    n = wh.compact("raw_network_events", "2024-03-01", rows_per_file=1000)
    files = wh.read("raw_network_events").inputFiles()
    assert n == len(files) == 4
    ranges = []
    for f in files:
        got = [r["device_id"] for r in spark.read.parquet(f).select("device_id").collect()]
        assert got == sorted(got)  # one sorted run
        ranges.append((got[0], got[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert wh.read("raw_network_events").select("event_id").distinct().count() == 4000


def test_compaction_keeps_rows_appended_meanwhile(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    wh.append("raw_network_events", _events(spark, [1]))
    plain = Warehouse._write_text

    def append_first(self, path, text):
        wh.append("raw_network_events", _events(spark, [1]).selectExpr("concat('late-', event_id) AS event_id", "event_timestamp"))
        plain(self, path, text)

    monkeypatch.setattr(Warehouse, "_write_text", append_first)
    wh.compact("raw_network_events", "2024-03-01")
    assert wh.read("raw_network_events").count() == 4


def test_compaction_that_died_is_finished(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    wh.append("raw_network_events", _events(spark, [1, 2]))
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "finish_compactions", lambda self, table: None)  # dies after the manifest
        wh.compact("raw_network_events", "2024-03-01", "2024-03-02")
    assert wh.read("raw_network_events").count() == 4
    wh.finish_compactions("raw_network_events")
    wh.finish_compactions("raw_network_events")
    assert sorted(r["event_id"] for r in wh.read("raw_network_events").collect()) == ["e1-0", "e1-23", "e2-0", "e2-23"]
