"""Line de-duplication with two Bloom filters.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased.  Keys of at least ``min_chars`` code points that at least
``min_docs`` documents hold lose all their lines, except in the largest
document id that holds them.

Three passes over the texts, none of which shuffles a text before the last:

1. every task keeps two Bloom filters of its own, for keys seen once and keys
   seen again; the filters meet segment by segment, where bits set in two
   "once" filters become "twice" bits;
2. the merged "twice" filter, whose size is fixed by ``filter_bits``, is
   broadcast; only keys that it suspects leave their task, as 16-byte digests,
   and are confirmed by exact counts of document ids;
3. documents get the confirmed digests to drop by a join on their id, and drop
   these lines.

A fuller filter suspects more keys; the result stays the same at any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm.common import WHITE_SPACE, col, fresh, table

MIN_CHARS = 40
MIN_DOCS = 5
FILTER_BITS = 1 << 28  # 32 MB: the broadcast filter never grows beyond this
SEGMENT_BITS = 1 << 17
PROBES = 3
_STRIP = WHITE_SPACE.encode()
_PARTIAL = "segment int, once binary, twice binary"


def line_digest(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte digest of a line's key; None for keys that are too short."""
    key = line.strip(_STRIP)
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key.lower(), digest_size=16).digest()


def bit_positions(digests: np.ndarray, filter_bits: int, segment_bits: int) -> np.ndarray:
    """(n, PROBES) bit positions; a key's bits lie in one segment."""
    a, b = digests[:, 0], digests[:, 1]
    segment = (a % np.uint64(filter_bits // segment_bits)) * np.uint64(segment_bits)
    step = (a >> np.uint64(32)) | np.uint64(1)
    return np.stack(
        [segment + ((b + np.uint64(k) * step) % np.uint64(segment_bits)) for k in range(PROBES)], axis=1
    )


def _test(bits: np.ndarray, positions: np.ndarray) -> np.ndarray:
    hit = (bits[positions >> np.uint64(3)] >> (positions & np.uint64(7)).astype(np.uint8)) & 1
    return hit.all(axis=1)


def _set(bits: np.ndarray, positions: np.ndarray) -> None:
    flat = positions.ravel()
    np.bitwise_or.at(bits, flat >> np.uint64(3), np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))


def _pack(bits: np.ndarray) -> bytes:
    """A segment's bits, as positions while that is shorter."""
    where = np.flatnonzero(np.unpackbits(bits, bitorder="little")).astype("<u4")
    return b"P" + where.tobytes() if where.nbytes < bits.nbytes else b"B" + bits.tobytes()


def _unpack(data: bytes, segment_bits: int) -> np.ndarray:
    if data[:1] == b"B":
        return np.frombuffer(data, dtype=np.uint8, offset=1).copy()
    bits = np.zeros(segment_bits // 8, dtype=np.uint8)
    where = np.frombuffer(data, dtype="<u4", offset=1)
    np.bitwise_or.at(bits, where >> 3, np.uint8(1) << (where & 7).astype(np.uint8))
    return bits


def _rows(segments: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    ids = sorted(segments)
    for at in range(0, len(ids), 256):
        part = ids[at : at + 256]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array([_pack(segments[s][0]) for s in part], pa.binary()),
                pa.array([_pack(segments[s][1]) for s in part], pa.binary()),
            ],
            ["segment", "once", "twice"],
        )


def _doc_digests(text: pa.Scalar, min_chars: int) -> set[bytes]:
    data = text.as_py()
    if not data:
        return set()
    found = {line_digest(x, min_chars) for x in data.encode().split(b"\n")}
    found.discard(None)
    return found


def _matrix(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def twice_filter(
    docs: DataFrame, text_col: str, min_chars: int, filter_bits: int, segment_bits: int
) -> bytes:
    """The merged filter of keys seen twice: ``filter_bits`` bits, whatever the input."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.zeros(filter_bits // 8, dtype=np.uint8)
        twice = np.zeros(filter_bits // 8, dtype=np.uint8)
        for batch in batches:
            keys = [d for text in batch.column(0) for d in _doc_digests(text, min_chars)]
            if not keys:
                continue
            values, counts = np.unique(_matrix(keys), axis=0, return_counts=True)
            positions = bit_positions(values, filter_bits, segment_bits)
            again = _test(once, positions) | (counts > 1)
            _set(once, positions)
            _set(twice, positions[again])
        size = segment_bits // 8
        touched = np.flatnonzero(once.reshape(-1, size).any(axis=1))
        yield from _rows({int(s): (once[s * size : (s + 1) * size], twice[s * size : (s + 1) * size]) for s in touched})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for s, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                a, b = _unpack(a, segment_bits), _unpack(b, segment_bits)
                if s in segments:
                    once, twice = segments[s]
                    segments[s] = (once | a, twice | b | (once & a))
                else:
                    segments[s] = (a, b)
        yield from _rows({s: v for s, v in segments.items() if v[1].any()})

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = (
        docs.select(col(text_col))
        .mapInArrow(build, _PARTIAL)
        .repartition(parts, "segment")
        .mapInArrow(merge, _PARTIAL)
        .select("segment", "twice")
    )
    bits = np.zeros(filter_bits // 8, dtype=np.uint8)
    size = segment_bits // 8
    for row in merged.toLocalIterator():
        bits[row.segment * size : (row.segment + 1) * size] = _unpack(bytes(row.twice), segment_bits)
    return bits.tobytes()


def repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    filter_bits: int = FILTER_BITS,
    segment_bits: int = SEGMENT_BITS,
) -> DataFrame:
    """(id, drops): for each document id the digests of the lines it loses."""
    spark = docs.sparkSession
    segment_bits = min(segment_bits, filter_bits)
    twice = spark.sparkContext.broadcast(twice_filter(docs, text_col, min_chars, filter_bits, segment_bits))
    id_type = docs.schema[id_col].dataType

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(twice.value, dtype=np.uint8)
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(batch.column(1)):
                found = _doc_digests(text, min_chars)
                rows += [i] * len(found)
                keys += found
            if not keys:
                continue
            hit = np.flatnonzero(_test(bits, bit_positions(_matrix(keys), filter_bits, segment_bits)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.asarray(rows)[hit])),
                    pa.array([keys[k] for k in hit], pa.binary()),
                ],
                ["id", "digest"],
            )

    schema = T.StructType([T.StructField("id", id_type), T.StructField("digest", T.BinaryType())])
    suspects = docs.select(col(id_col).alias("id"), col(text_col)).mapInArrow(suspect, schema)
    suspects = suspects.distinct()
    confirmed = (
        suspects.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep"))
        .where(F.col("n") >= min_docs)
        .select("digest", "keep")
    )
    return (
        suspects.join(confirmed, "digest")
        .where(~F.col("id").eqNullSafe(F.col("keep")))
        .groupBy("id")
        .agg(F.collect_list("digest").alias("drops"))
    )


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    filter_bits: int = FILTER_BITS,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """``docs`` with the text less its repeated lines, and two counts.

    Every row comes back, extra columns untouched (columns named like the two
    counts are replaced).  A null text is one empty line and stays null, an
    empty text stays empty.  Rows that share an id count as one document; a
    null id is a document below all others.  A tie cannot arise: a key is kept
    by one id.  An empty table gives an empty table.
    """
    drops = repeated_lines(docs, id_col, text_col, min_chars, min_docs, filter_bits)
    id_, dropped, cut = fresh(docs, "ld_id", "ld_drops", "ld_cut")
    drops = drops.select(F.col("id").alias(id_), F.col("drops").alias(dropped))

    @F.pandas_udf("text string, n long")
    def drop(texts: pd.Series, digests: pd.Series) -> pd.DataFrame:
        out, counts = [], []
        for text, gone in zip(texts, digests, strict=True):
            if text is None or gone is None:
                out.append(None)
                counts.append(0)
                continue
            gone = {bytes(x) for x in gone}
            lines = text.encode().split(b"\n")
            kept = [x for x in lines if line_digest(x, min_chars) not in gone]
            out.append(b"\n".join(kept).decode())
            counts.append(len(lines) - len(kept))
        return pd.DataFrame({"text": out, "n": counts})

    text = col(text_col)
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    joined = docs.join(drops, col(id_col).eqNullSafe(col(id_)), "left").withColumn(
        cut, drop(F.when(col(dropped).isNotNull(), text), col(dropped))
    )
    keep = [c for c in docs.columns if c.lower() not in (n_lines.lower(), n_dropped.lower())]
    hit = col(dropped).isNotNull() & text.isNotNull()
    return joined.select(
        *[(F.when(hit, col(cut)["text"]).otherwise(text).alias(c) if c == text_col else col(c)) for c in keep],
        F.coalesce(lines, F.lit(1)).cast("long").alias(n_lines),
        F.when(hit, col(cut)["n"]).otherwise(F.lit(0)).cast("long").alias(n_dropped),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every document."""
    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT r, doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
),
c AS (SELECT k, max(doc_id) AS keep FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, (c.k IS NOT NULL AND l.doc_id <> c.keep) AS dropped FROM l LEFT JOIN c ON l.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
