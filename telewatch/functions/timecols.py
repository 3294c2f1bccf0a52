"""Time helpers: day ranges, buckets, recency windows.

Date predicates are written as half-open timestamp ranges so they reach the
Parquet scan as pushed filters (and prune ``*_date`` partitions when the
table has them); ``to_date(ts) = d`` alone does neither.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def as_date(ds) -> Column:
    """A bound ``ds`` parameter (str/date/Column) as a DATE column."""
    if isinstance(ds, Column):
        return ds.cast("date")
    if isinstance(ds, dt.datetime):
        ds = ds.date()
    return F.lit(str(ds)).cast("date")


def day_of(ts: Column) -> Column:
    """Calendar day (UTC session zone)."""
    return F.to_date(ts)


def _like(ts_type, value: Column) -> Column:
    return value.cast("timestamp_ntz") if isinstance(ts_type, TimestampNTZType) else value.cast(
        "timestamp"
    )


def on_day(df: DataFrame, ts_col: str, ds, date_col: str | None = None) -> DataFrame:
    """rows whose ``ts_col`` falls on day ``ds``: ``ds <= ts < ds + 1``.

    When the table carries a date partition column (``date_col``), the same
    day is also asserted on it so the scan prunes to one partition.
    """
    ts_type = df.schema[ts_col].dataType
    start = _like(ts_type, as_date(ds))
    end = _like(ts_type, F.date_add(as_date(ds), 1))
    out = df.filter((F.col(ts_col) >= start) & (F.col(ts_col) < end))
    if date_col and date_col in df.columns:
        out = out.filter(F.col(date_col) == as_date(ds))
    return out


class Latest:
    """``(SELECT max(ts_col) FROM df)``: "now" derived from the data."""

    def __init__(self, df: DataFrame, ts_col: str):
        self._df, self._ts_col = df, ts_col

    def column(self) -> Column:
        """The value, as a scalar subquery evaluated once."""
        return self._df.select(F.max(self._ts_col)).scalar()

    def minus(self, interval: str) -> Column:
        """The value less an interval.  The subtraction is inside the subquery,
        so that a comparison with it is pushed to the Parquet scan."""
        return self._df.select(F.max(self._ts_col) - F.expr(f"INTERVAL {interval}")).scalar()


def since(ts: Column, as_of: Column | Latest, interval: str) -> Column:
    """``ts > as_of - INTERVAL …`` (strict, as the dashboard)."""
    if isinstance(as_of, Latest):
        return ts > as_of.minus(interval)
    return ts > (as_of - F.expr(f"INTERVAL {interval}"))


def utc(moment: dt.datetime) -> dt.datetime:
    """A naive time is UTC.  Literals of aware times are instants, whatever
    the driver's own time zone."""
    return moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)


def instant(moment: dt.datetime) -> Column:
    return F.lit(utc(moment)).cast("timestamp")


def between(ts: Column, start=None, end=None) -> Column | None:
    """the panel time filter ``ts BETWEEN start AND end`` (either side
    open when None)."""
    cond = None
    if start is not None:
        cond = ts >= (start if isinstance(start, Column) else instant(start))
    if end is not None:
        term = ts <= (end if isinstance(end, Column) else instant(end))
        cond = term if cond is None else (cond & term)
    return cond


def bucket(df: DataFrame, ts_col: str, unit: str = "minute") -> Column:
    """``date_trunc(unit, ts)`` keeping the input's timestamp flavour
    (``date_trunc`` alone turns TIMESTAMP_NTZ into TIMESTAMP)."""
    return _like(df.schema[ts_col].dataType, F.date_trunc(unit, F.col(ts_col)))


def latest(df: DataFrame, ts_col: str) -> Column:
    """``as_of`` derived from data, as a Column."""
    return Latest(df, ts_col).column()


def now() -> Column:
    """P19 default: the query's start instant."""
    return F.current_timestamp()
