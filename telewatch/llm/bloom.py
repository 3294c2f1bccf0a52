"""A Bloom filter of fixed size over 64-bit keys, built by tasks and broadcast.

It only thins out what a later, exact join sees: a fuller filter lets more rows
through, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

FILTER_BITS = 1 << 28  # 32 MB, whatever the input
SEGMENT_BITS = 1 << 17
PROBES = 3
_SEGMENT_BYTES = SEGMENT_BITS // 8


def positions(keys: np.ndarray) -> np.ndarray:
    """(n, PROBES) bit positions of uint64 keys; a key's bits lie in one segment."""
    a = keys * np.uint64(0x9E3779B97F4A7C15)
    a ^= a >> np.uint64(32)
    b = a * np.uint64(0xC2B2AE3D27D4EB4F)
    segment = (a % np.uint64(FILTER_BITS // SEGMENT_BITS)) * np.uint64(SEGMENT_BITS)
    step = (b >> np.uint64(32)) | np.uint64(1)
    return np.stack([segment + ((b + np.uint64(k) * step) % np.uint64(SEGMENT_BITS)) for k in range(PROBES)], axis=1)


def may_contain(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = positions(keys)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def key_filter(keys: DataFrame) -> Broadcast:
    """The filter of the one ``long`` column of ``keys``, as broadcast bytes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One row per segment met: the positions of its bits.
        for batch in batches:
            flat = np.unique(positions(batch.column(0).to_numpy().view(np.uint64)))
            segment = (flat // np.uint64(SEGMENT_BITS)).astype(np.int32)
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1]))) if flat.size else []
            inside = (flat % np.uint64(SEGMENT_BITS)).astype("<u4")
            parts = np.split(inside, starts[1:]) if flat.size else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment[starts] if flat.size else [], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["segment", "bits"],
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits = segments.setdefault(s, np.zeros(_SEGMENT_BYTES, dtype=np.uint8))
                at = np.frombuffer(data, dtype="<u4")
                np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        ids = sorted(segments)
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([segments[s].tobytes() for s in part], pa.binary())],
                ["segment", "bits"],
            )

    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = keys.mapInArrow(build, "segment int, bits binary").repartition(parts, "segment").mapInArrow(merge, "segment int, bits binary")
    bits = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():
        bits[row.segment * _SEGMENT_BYTES : (row.segment + 1) * _SEGMENT_BYTES] = np.frombuffer(bytes(row.bits), np.uint8)
    return spark.sparkContext.broadcast(bits.tobytes())
