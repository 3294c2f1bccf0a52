from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from telewatch.session import build_session

    s = build_session("local[*]", app_name="telewatch-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="telewatch-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from telewatch.session import scratch_path

    return scratch_path(spark, "test")


def payload(**fields) -> str:
    base = {
        "event_id": "e-1",
        "timestamp": "2024-03-01T12:00:00.000Z",
        "device_id": "RTR-ASW-001",
        "device_type": "router",
        "region": "Aswan",
        "cpu_usage": 10.0,
        "memory_usage": 10.0,
        "bandwidth_mbps": 100.0,
        "packet_loss": 0.1,
        "latency_ms": 10.0,
        "temperature": 40.0,
        "status": "UP",
    }
    base.update(fields)
    return json.dumps({k: v for k, v in base.items() if v is not _MISSING})


_MISSING = object()


@pytest.fixture()
def missing():
    return _MISSING


def kafka_rows(spark, values: list[str | None], key: str = "RTR-ASW-001"):
    import datetime as dt

    from telewatch.streaming.sources import KAFKA_SCHEMA

    rows = [
        (key.encode(), None if v is None else v.encode(), "network-events", 0, i,
         dt.datetime(2024, 3, 1, 12, 0, 0), 0)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)
