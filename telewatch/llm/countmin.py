"""A count-min sketch of 64-bit keys, built by tasks and broadcast.

Counts stop at a limit, so a cell is one byte and the whole sketch has a size
that its width fixes.  An estimate never lies below the true count (up to the
limit); a fuller sketch estimates higher.  Users must stay right when it does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

SEGMENT = 1 << 16
PARTIAL = "segment int, cells binary, counts binary"
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def width_for(keys: int, least: int = 1 << 16, most: int = 1 << 24) -> int:
    """A power of two of at least ``keys`` cells, within the bounds."""
    return int(min(most, max(least, 1 << max(0, int(keys) - 1).bit_length())))


def cells(keys: np.ndarray, width: int, row: int) -> np.ndarray:
    """The cell of every key (uint64) in one row of the sketch."""
    x = (keys ^ (keys >> np.uint64(29 + row))) * np.uint64(_MIX[row])
    x ^= x >> np.uint64(32)
    return ((x * np.uint64(_MIX[-1 - row])) >> np.uint64(40)) & np.uint64(width - 1)


def estimate(sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The least of a key's cells, per key; ``sketch`` is (rows, width)."""
    out = np.full(keys.size, 255, dtype=np.uint8)
    for row in range(sketch.shape[0]):
        np.minimum(out, sketch[row][cells(keys, sketch.shape[1], row)], out=out)
    return out


class Counter:
    """One task's part of the sketch."""

    def __init__(self, width: int, rows: int, limit: int) -> None:
        if not 0 < limit < 256 or not 0 < rows <= len(_MIX):
            raise ValueError("limit must be below 256 and rows at most 4")
        self.width, self.rows, self.limit = width, rows, limit
        self.counts = np.zeros((rows, width), dtype=np.uint32)

    def add(self, keys: np.ndarray, times: np.ndarray | None = None) -> None:
        """Count keys; ``times`` for keys that are already aggregated."""
        add = np.uint32(1) if times is None else np.minimum(times, self.limit).astype(np.uint32)
        for row in range(self.rows):
            np.add.at(self.counts[row], cells(keys, self.width, row), add)

    def partials(self) -> Iterator[pa.RecordBatch]:
        """The cells that are not zero, a row for each segment of the whole sketch."""
        for row in range(self.rows):
            at = np.flatnonzero(self.counts[row])
            if not at.size:
                continue
            values = np.minimum(self.counts[row][at], self.limit).astype(np.uint8)
            at += row * self.width
            segment = at // SEGMENT
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            ends = np.append(starts[1:], at.size)
            inside = (at % SEGMENT).astype("<u2")
            for k in range(0, starts.size, 64):
                some = list(zip(starts[k : k + 64].tolist(), ends[k : k + 64].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment[starts[k : k + 64]].astype(np.int32)),
                        pa.array([inside[s:e].tobytes() for s, e in some], pa.binary()),
                        pa.array([values[s:e].tobytes() for s, e in some], pa.binary()),
                    ],
                    ["segment", "cells", "counts"],
                )


def merged(partials: DataFrame, width: int, rows: int, limit: int) -> Broadcast:
    """The sketch of all tasks: ``rows * width`` bytes, as broadcast bytes.

    The parts meet segment by segment in tasks; only finished segments reach
    the driver."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, at, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                total = sums.setdefault(segment, np.zeros(SEGMENT, dtype=np.uint8))
                where = np.frombuffer(at, "<u2")
                more = total[where].astype(np.uint16) + np.frombuffer(counts, np.uint8)
                total[where] = np.minimum(more, limit)
        for segment, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["segment", "counts"]
            )

    spark = partials.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    summed = partials.repartition(parts, "segment").mapInArrow(add_up, "segment int, counts binary")
    out = np.zeros(-(-rows * width // SEGMENT) * SEGMENT, dtype=np.uint8)
    for r in summed.toLocalIterator():
        out[r.segment * SEGMENT : (r.segment + 1) * SEGMENT] = np.frombuffer(bytes(r.counts), np.uint8)
    return spark.sparkContext.broadcast(out[: rows * width].tobytes())


def opened(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(rows, -1)
