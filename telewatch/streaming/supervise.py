"""Stream supervision (T6): named queries, a listener that records every
progress and termination, and a wait that surfaces the first failure.

The reference polled unnamed queries every 5 s and remembered failures by
``q.name`` (always None), so only the first failure was ever reported.  Here
every query is named, the listener keeps one status entry per query, and
``supervise`` re-raises the failure of whichever query stops first.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from telewatch.operators.merge import unique_append
from telewatch.session import path_exists


class StatusListener(StreamingQueryListener):
    """Latest progress and terminal state per query name."""

    def __init__(self):
        self._lock = threading.Lock()
        self.status: dict[str, dict] = {}
        self._news: list[tuple] = []  # reports not yet in the history
        self._runs: dict[str, str | None] = {}

    def _report(self, kind: str, name, query_id, run_id, batch_id=None, rows=None, rate=None, exception=None, at=None):
        at = at or dt.datetime.now(dt.timezone.utc).isoformat()
        with self._lock:
            self._runs.setdefault(str(run_id), name)
            self._news.append((kind, self._runs[str(run_id)], str(query_id), str(run_id), batch_id, rows, rate, exception, at))

    def take_news(self) -> list[tuple]:
        with self._lock:
            news, self._news = self._news, []
        return news

    def put_back(self, news: list[tuple]) -> None:
        with self._lock:
            self._news = news + self._news

    def _put(self, name, **fields):
        with self._lock:
            self.status.setdefault(name or "<unnamed>", {}).update(fields)

    def onQueryStarted(self, event):
        self._put(event.name, id=str(event.id), state="running")
        self._report("started", event.name, event.id, event.runId, at=event.timestamp)

    def onQueryProgress(self, event):
        p = event.progress
        self._report("progress", p.name, p.id, p.runId, p.batchId, p.numInputRows, p.processedRowsPerSecond, at=p.timestamp)
        self._put(
            p.name,
            batch_id=p.batchId,
            input_rows=p.numInputRows,
            rows_per_second=p.processedRowsPerSecond,
        )

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._report("failed" if event.exception else "stopped", None, event.id, event.runId, exception=event.exception)
        with self._lock:
            for st in self.status.values():
                if st.get("id") == str(event.id):
                    st["state"] = "failed" if event.exception else "stopped"
                    st["exception"] = event.exception

    def snapshot(self) -> dict[str, dict]:
        with self._lock:
            return {k: dict(v) for k, v in self.status.items()}

    def status_frame(self, spark: SparkSession):
        """The status table: one row per query (name, id, state, last batch,
        input rows, rows/s, failure text).  A handful of rows — one per
        running query — built on the driver from the listener's record."""
        rows = [
            (name, st.get("id"), st.get("state"), st.get("batch_id"), st.get("input_rows"),
             None if st.get("rows_per_second") is None else float(st["rows_per_second"]),
             st.get("exception"))
            for name, st in sorted(self.snapshot().items())
        ]
        return spark.createDataFrame(
            rows,
            "query_name STRING, query_id STRING, state STRING, batch_id BIGINT, input_rows BIGINT, "
            "rows_per_second DOUBLE, exception STRING",
        )


def attach_listener(spark: SparkSession) -> StatusListener:
    listener = StatusListener()
    spark.streams.addListener(listener)
    return listener


def supervise(spark: SparkSession, queries: Sequence[StreamingQuery], stop_all_on_failure: bool = True,
              poll_s: float = 5.0, on_poll: Callable[[], None] | None = None) -> None:
    """Block until a query ends; on a failure stop the others (optional) and
    raise with the failing query's name.  Ctrl-C stops every query.
    ``on_poll`` runs between two looks (e.g. ``write_status``)."""
    try:
        while True:
            if on_poll is not None:
                on_poll()
            for q in queries:
                if not q.isActive:
                    exc = q.exception()
                    if exc is not None:
                        if stop_all_on_failure:
                            for other in queries:
                                if other.isActive:
                                    other.stop()
                        raise RuntimeError(f"stream '{q.name}' failed: {exc}")
            if not any(q.isActive for q in queries):
                return
            time.sleep(poll_s)
    except KeyboardInterrupt:
        for q in queries:
            if q.isActive:
                q.stop()


def write_status(spark: SparkSession, listener: StatusListener, root: str, settle_s: float = 0.0) -> None:
    """The status table, one row per query, as Parquet under ``root``.

    Listener events arrive late; with ``settle_s`` the write waits up to so
    long for every query's end to be reported."""
    until = time.monotonic() + settle_s
    while time.monotonic() < until and any(s.get("state") != "stopped" for s in listener.snapshot().values()):
        time.sleep(0.1)
    append_history(spark, listener, root)
    listener.status_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{root}/stream_status")


HISTORY_KEY = ("query_id", "run_id", "kind", "batch_id")
HISTORY = (
    "kind STRING, query_name STRING, query_id STRING, run_id STRING, batch_id BIGINT, input_rows BIGINT, "
    "rows_per_second DOUBLE, exception STRING, reported_at STRING"
)


def append_history(spark: SparkSession, listener: StatusListener, root: str) -> int:
    """Append what the listener has heard since the last call to the history,
    one row for each start, batch and end of a query's run; the number of rows.

    Rows are never rewritten, so failures outlive a restart of the process that
    had them.  What could not be written is kept for the next call; a report that
    was written twice (a crash between write and return) is one row in
    ``read_history``."""
    news = listener.take_news()
    if not news:
        return 0
    try:
        rows = [(k, n, q, r, -1 if b is None else b, i, None if v is None else float(v), e, t) for k, n, q, r, b, i, v, e, t in news]
        df = spark.createDataFrame(rows, HISTORY).withColumn("reported_at", F.col("reported_at").cast("timestamp"))
        df.withColumn("report_date", F.to_date("reported_at")).coalesce(1).write.mode("append").partitionBy("report_date").parquet(
            f"{root}/stream_history"
        )
    except BaseException:
        listener.put_back(news)
        raise
    return len(news)


def read_history(spark: SparkSession, root: str):
    """The history, one row for each (query, run, kind, batch); ``batch_id`` is -1
    for starts and ends.  Empty before the first report."""
    path = f"{root}/stream_history"
    schema = HISTORY.replace("reported_at STRING", "reported_at TIMESTAMP") + ", report_date DATE"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return unique_append(spark.read.schema(schema).parquet(path), None, HISTORY_KEY)
