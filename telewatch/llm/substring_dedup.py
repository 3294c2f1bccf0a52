"""Repeated-substring removal with a run-length BWT index.

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else in
the corpus goes.  Strings are bytes of UTF-8 and never cross texts.

Which texts can share a window is found first.  Each window has an anchor, its
``GRAM``-byte gram of the least hash; equal windows have equal anchors.  A span is
a run of neighbouring windows with one anchor, so every window lies in one
span, and spans without another span of the same anchor hold no repeat.
Equal spans are counted as one before anything moves.

The distinct spans of an anchor then meet in one index.  Its text is the spans,
each with an end of its own; the index sorts the suffixes, takes the BWT, and
keeps the ends of its runs only: at the head of a run, a text position j, the
position that precedes it in suffix order, and the length L of their match.
Matching statistics stream from there: a position inside a run has the match of
the position before it, one byte shorter.  So the matches at run heads cover
all others, and [j, j + L) and its counterpart are marked wherever L >= WINDOW.
In repetitive text there are few runs.

An anchor with more than ``CROWDED`` distinct spans does not go to one task: its
windows are keyed by themselves and counted instead, which marks the same bytes.

Marks return to all texts that hold a span by a join, thinned out before by a
Bloom filter of fixed size, and the marked bytes are cut out of each text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm import bloom
from telewatch.llm.common import col, fresh, stored, table

WINDOW = 200
GRAM = 32
CROWDED = 16_384
INDEX_BYTES = 1 << 20  # spans go to one index until they are so many bytes
_BLOCK = 1 << 20  # windows of one text that are cut at a time
_SYMBOL_BITS, _SYMBOLS = 9, 7  # symbols in the first sort key: bytes + 1, 0 past a span's end

_random = np.random.RandomState(20)
_BYTE = _random.randint(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = [_random.randint(0, 1 << 63, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(8)]
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)

Spans = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _windowed_min(keys: np.ndarray, n: int) -> np.ndarray:
    size = 1
    while 2 * size <= n:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (n - size)], keys[n - size :]) if n > size else keys


def spans(data: bytes, window: int = WINDOW, gram: int = GRAM) -> Spans:
    """(anchor hash, span hash, start, end) of each span of a text."""
    found: list[Spans] = []
    for low in range(0, max(len(data) - window + 1, 0), _BLOCK):
        part = data[low : low + _BLOCK + window - 1]
        hashes = _BYTE[np.frombuffer(part, dtype=np.uint8)]
        for k in range(gram.bit_length() - 1):
            hashes = hashes[: -(1 << k)] * _MIX[k] + hashes[1 << k :]
        hashes ^= hashes >> np.uint64(29)
        hashes *= _MIX[7]
        # The least hash, and of equal ones the leftmost.
        keys = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
        at = (_windowed_min(keys, window - gram + 1) & _LOW).astype(np.int64)
        start = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        end = np.concatenate((start[1:], [len(at)])) - 1 + window
        own = [xxhash.xxh3_64_intdigest(part[s:e]) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        found.append((hashes[at[start]], np.array(own, dtype=np.uint64), start + low, end + low))
    if not found:
        none = np.empty(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class RunIndex:
    """A run-length BWT over texts that each have an end of their own.

    ``heads``, ``before`` and ``length`` are the samples: the text position at
    the head of each run, its predecessor in suffix order, and their match."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.ends = np.cumsum(sizes + 1)  # one position past each text is its end
        self.starts = self.ends - sizes - 1
        n = int(self.ends[-1]) if len(texts) else 0
        symbol = np.zeros(n + _SYMBOLS, dtype=np.int64)
        real = np.ones(n, dtype=bool)
        real[self.ends - 1] = False
        symbol[:n][real] = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int64) + 1
        self.symbol, self.n = symbol[:n], n
        order, levels = self._sort(int(sizes.max(initial=0)), real)
        self.order = order
        # The symbol before each suffix; a text's first suffix has one of its own.
        previous = np.where(order > 0, symbol[order - 1], 0)
        head = np.ones(order.size, dtype=bool)
        head[1:] = (previous[1:] != previous[:-1]) | (previous[1:] == 0)
        at = np.flatnonzero(head[1:]) + 1
        self.n_runs = int(head.sum())
        self.heads, self.before = order[at], order[at - 1]
        self.length = self._match(self.heads, self.before, levels)

    def _sort(self, longest: int, real: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Suffixes in order, by prefix doubling, and the ranks at each depth."""
        n = self.n
        if not n:
            return np.empty(0, np.int64), []
        padded = np.concatenate((self.symbol, np.zeros(_SYMBOLS, np.int64)))
        # Symbols past the text's end read as 0 whatever the next text holds.
        left = np.repeat(self.ends, np.diff(np.concatenate(([0], self.ends)))) - 1 - np.arange(n)
        key = np.zeros(n, dtype=np.int64)
        for k in range(_SYMBOLS):
            key <<= _SYMBOL_BITS
            key |= np.where(left > k, padded[k : n + k], 0)
        self.left = left
        order = np.argsort(key)
        rank = np.empty(n + 1, dtype=np.int64)
        rank[n] = 0

        def number(sorted_key: np.ndarray) -> None:
            new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
            rank[order] = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))

        number(key[order])
        depth, levels = _SYMBOLS, [(_SYMBOLS, rank.astype(np.int32))]
        while depth < longest:
            beyond = np.where(left > depth, np.minimum(np.arange(n) + depth, n), n)
            key = rank[:n] << 32 | rank[beyond]
            order = np.argsort(key)
            sorted_key = key[order]
            number(sorted_key)
            depth *= 2
            levels.append((depth, rank.astype(np.int32)))
            if n == 1 or (sorted_key[1:] != sorted_key[:-1]).all():
                break
        # Suffixes alike to their ends: in the order of their texts, as if the ends differed.
        order = np.argsort(rank[:n] << 32 | np.arange(n))
        return order[real[order]], levels

    def _match(self, a: np.ndarray, b: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        most = np.minimum(self.left[a], self.left[b])
        length = np.zeros(a.size, dtype=np.int64)
        for depth, rank in reversed(levels):
            for _ in range(2):
                x, y = np.minimum(a + length, self.n - 1), np.minimum(b + length, self.n - 1)
                same = (length < most) & (rank[x] == rank[y])
                length = np.where(same, length + depth, length)
        # Less than one key's symbols remain.
        for _ in range(_SYMBOLS):
            x, y = np.minimum(a + length, self.n - 1), np.minimum(b + length, self.n - 1)
            length += (length < most) & (self.symbol[x] == self.symbol[y])
        return np.minimum(length, most)

    def repeats(self, at_least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, start, end) of the maximal runs of bytes covered by
        matches of ``at_least`` bytes with another place of the index."""
        long = self.length >= at_least
        change = np.zeros(self.n + 1, dtype=np.int64)
        for at in (self.heads[long], self.before[long]):
            np.add.at(change, at, 1)
            np.add.at(change, at + self.length[long], -1)
        marked = np.concatenate(([False], np.cumsum(change[: self.n]) > 0))
        edge = np.flatnonzero(marked[1:] != marked[:-1])
        if marked[-1]:
            edge = np.append(edge, self.n)
        low, high = edge[::2], edge[1::2]
        text = np.searchsorted(self.ends, low, side="right")
        return text, low - self.starts[text], high - self.starts[text]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _pair(anchor: np.ndarray, span: np.ndarray) -> np.ndarray:
    return anchor * _MIX[0] ^ span


def _span_rows(window: int, gram: int, known: Callable[[], np.ndarray] | None) -> Callable:
    """Rows of all spans of (row, text); with ``known``, those a filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known() if known else None
        for batch in batches:
            rows: list[int] = []
            found: list[Spans] = []
            size = 0
            texts = list(zip(batch.column(0).to_pylist(), batch.column(1), strict=True))
            for k, (row, text) in enumerate(texts):
                own = spans((text.as_py() or "").encode(), window, gram)
                found.append(own)
                rows.append(row)
                size += len(own[0])
                if size < 100_000 and k + 1 < len(texts):
                    continue
                anchor, span, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
                row_of = np.repeat(np.array(rows, dtype=np.int64), [len(f[0]) for f in found])
                if bits is not None:
                    use = bloom.may_contain(bits, _pair(anchor, span))
                    anchor, span, start, end, row_of = (x[use] for x in (anchor, span, start, end, row_of))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row_of), _signed(anchor), _signed(span), pa.array(start), pa.array(end)],
                    ["row", "anchor", "span", "start", "end"],
                )
                rows, found, size = [], [], 0

    return run


_SPAN_ROWS = "row long, anchor long, span long, start long, end long"


def repeated_spans(rows: DataFrame, window: int = WINDOW, gram: int = GRAM, crowded: int = CROWDED) -> DataFrame:
    """(anchor, span, s, e): the removed byte ranges of each distinct span,
    counted from its start.  ``rows`` are (row, text)."""
    every = rows.mapInArrow(_span_rows(window, gram, None), _SPAN_ROWS)
    distinct = every.groupBy("anchor", "span").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("row"), F.max(F.col("end") - F.col("start")).alias("size")
    )
    # An anchor's distinct spans share a partition; spans without company go.
    distinct = stored(distinct, "substring-spans")
    shared = stored(
        distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("spans"), F.sum("n").alias("all")).where(F.col("all") > 1),
        "substring-anchors",
    )
    repeated = distinct.where(F.col("n") > 1).select(
        "anchor", "span", F.lit(0).cast("long").alias("s"), F.col("size").alias("e")
    )
    wanted = distinct.join(shared.where(F.col("spans") > 1), "anchor").select("anchor", "span", "n", "row", "spans")
    wanted = stored(wanted, "substring-wanted")

    # Each wanted span's bytes, from one text that holds it.
    asked = bloom.key_filter(wanted.select("row").distinct())

    @F.pandas_udf("boolean")
    def may_be_asked(row: pd.Series) -> pd.Series:
        bits = np.frombuffer(asked.value, dtype=np.uint8)
        return pd.Series(bloom.may_contain(bits, row.to_numpy().astype(np.int64).view(np.uint64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int, bytes]] = []
            size = 0
            for text, asks in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py().encode()
                anchor, span, start, end = spans(data, window, gram)
                place = dict(zip(zip(anchor.view(np.int64).tolist(), span.view(np.int64).tolist(), strict=True), zip(start.tolist(), end.tolist(), strict=True), strict=True))
                for ask in asks.as_py():
                    s, e = place[ask["anchor"], ask["span"]]
                    out.append((ask["anchor"], ask["span"], ask["n"], ask["spans"], data[s:e]))
                    size += e - s
                if size > 4 << 20:
                    yield _cut_rows(out)
                    out, size = [], 0
            if out:
                yield _cut_rows(out)

    asks = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "span", "n", "spans")).alias("asks"))
    # Rows that repeat an id and a text give a piece more than once.
    texts = rows.where(may_be_asked("row"))
    pieces = asks.join(texts, "row").select("text", "asks").mapInArrow(cut, _CUT_ROWS)
    pieces = stored(pieces, "substring-pieces")

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    indexed = (
        pieces.where(F.col("spans") <= crowded)
        .repartition(parts, "anchor")
        .sortWithinPartitions("anchor", "span")
        .select("anchor", "span", "n", "data")
        .mapInArrow(_index(window), "anchor long, span long, s long, e long")
    )
    lone = pieces.where(F.col("spans") > crowded).dropDuplicates(["anchor", "span"])
    return repeated.unionByName(indexed).unionByName(_by_window(lone, window))


_CUT_ROWS = "anchor long, span long, n long, spans long, data binary"


def _cut_rows(out: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "span", "n", "spans", "data"]
    )


def _index(window: int) -> Callable:
    """Marks of spans that come in order of their anchors; an anchor is never split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def marks() -> pa.RecordBatch:
            text, low, high = RunIndex([h[3] for h in held]).repeats(window)
            once = np.array([h[2] == 1 for h in held], dtype=bool)[text]  # spans met twice go whole already
            text, low, high = text[once], low[once], high[once]
            anchor, span = (np.array([h[k] for h in held], dtype=np.int64)[text] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, span, low, high)], ["anchor", "span", "s", "e"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if held and row[:2] == held[-1][:2]:
                    continue
                if size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield marks()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield marks()

    return run


def _by_window(pieces: DataFrame, window: int) -> DataFrame:
    """(anchor, span, s, e) of spans whose anchors are crowded: every window is
    keyed by its own bytes and counted."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, span, n, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                keys = [xxhash.xxh3_128_digest(data[k : k + window]) for k in range(len(data) - window + 1)]
                m = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * m, pa.int64()), pa.array([span] * m, pa.int64()), pa.array([n] * m, pa.int64()), pa.array(range(m), pa.int64()), pa.array(keys, pa.binary())],
                    ["anchor", "span", "n", "at", "key"],
                )

    every = pieces.select("anchor", "span", "n", "data").mapInArrow(
        windows, "anchor long, span long, n long, at long, key binary"
    )
    twice = every.groupBy("key").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("key")
    return (
        every.where(F.col("n") == 1)
        .join(twice, "key")
        .select("anchor", "span", F.col("at").alias("s"), (F.col("at") + window).alias("e"))
    )


def substring_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    crowded: int = CROWDED,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) for every row.

    ``kept`` are the remaining bytes, which need not be whole characters;
    ``n_spans`` counts the maximal removed runs.  Null and empty texts are empty;
    rows that repeat an id and a text are separate texts and so lose all they
    can; rows are told apart by a 64-bit hash of id and text; extra columns are
    not read; an empty table gives no rows.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(F.xxhash64(col(id_col).cast("string"), text).alias("row"), text.alias("text"))
    marks = stored(repeated_spans(rows, window, gram, crowded), "substring-marks")
    pairs = marks.select("anchor", "span").distinct()

    def pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, span = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([_signed(_pair(anchor, span))], ["key"])

    shared = bloom.key_filter(pairs.mapInArrow(pair_keys, "key long"))
    holders = rows.mapInArrow(
        _span_rows(window, gram, lambda: np.frombuffer(shared.value, dtype=np.uint8)), _SPAN_ROWS
    ).select("row", "anchor", "span", "start")
    cuts = (
        holders.join(marks, ["anchor", "span"])
        .select("row", (F.col("start") + F.col("s")).alias("s"), (F.col("start") + F.col("e")).alias("e"))
        .groupBy("row")
        .agg(F.collect_set(F.struct("s", "e")).alias("cuts"))
    )
    kept_type = T.StructType(
        [T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]
    )

    @F.pandas_udf(kept_type)
    def remove(texts: pd.Series, all_cuts: pd.Series) -> pd.DataFrame:
        out: list[tuple[bytes, int, int]] = []
        for text, found in zip(texts, all_cuts, strict=True):
            data = text.encode()
            kept, at, removed, runs, last = [], 0, 0, 0, -1
            for s, e in sorted((c["s"], c["e"]) for c in found) if found is not None else ():
                if s > last:
                    runs += 1
                if e > at:
                    kept.append(data[at : max(at, s)])
                    removed += e - max(at, s)
                    at = e
                last = max(last, e)
            kept.append(data[at:])
            out.append((b"".join(kept), removed, runs))
        return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    (own,) = fresh(cuts, "own_row")
    whole = docs.select(
        col(id_col).alias("id"), F.xxhash64(col(id_col).cast("string"), text).alias(own), text.alias("text")
    )
    joined = whole.join(cuts, F.col(own) == F.col("row"), "left")
    return joined.select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), remove("text", "cuts").alias("r")
    ).select("id", "n_bytes", "r.n_removed", "r.n_spans", "r.kept")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document."""
    found = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
