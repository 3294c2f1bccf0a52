"""Best-two-fit packing of token pieces into sequences of a fixed length.

Every document becomes its token ids and one closing id.  Only a document longer
than ``capacity`` is cut, into pieces of ``capacity`` ids, the first of which may
be shorter.  A sequence is filled greedily, always with the longest piece that
fits; then its shortest piece gives way to the two unpacked pieces that fill the
widened gap most tightly, if they fill it better, and so on while that helps.

The choice depends on the lengths alone, and there are at most ``capacity``
lengths, whatever the input: the driver gets the number of pieces of each length
and makes a plan of patterns, each used many times over.  The pieces never leave
their tasks for it.  A piece's place then follows from its rank among the pieces
of its length:

1. the tokenizing task numbers its pieces of each length;
2. counts by (length, task) give every task's first rank of each length, in one
   window over tasks, so a length that most pieces share is ranked by all tasks;
3. a binary search in the broadcast plan, whose size is bounded by ``capacity``,
   turns (length, rank) into a sequence and an offset.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm import bpe
from telewatch.llm.common import col, fresh, stored, table

CAPACITY = 2048
END_ID = 0
_RANK_BITS = 44  # a piece's length and its rank in one 64-bit number


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that each hold these pieces: (length, how many)."""

    times: int
    pieces: tuple[tuple[int, int], ...]


def _best_pair(left: np.ndarray, room: int) -> tuple[int, int, int]:
    """(sum, longer, shorter) of the two pieces that fill ``room`` best; the sum
    is 0 if no two fit.  ``left`` counts the unpacked pieces by length."""
    sizes = np.flatnonzero(left[: room + 1])
    if not sizes.size:
        return 0, 0, 0
    most = np.minimum(room - sizes, sizes)
    most -= (most == sizes) & (left[sizes] < 2)  # a single piece makes no pair with itself
    at = np.searchsorted(sizes, most, side="right") - 1
    sums = np.where(at >= 0, sizes + sizes[at], 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))  # of equal sums the one with the longest piece
    return int(sums[best]), int(sizes[best]), int(sizes[at[best]]) if sums[best] else 0


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """The patterns that pack ``counts`` pieces of each length.

    A pattern is used again as long as every choice in it would be made again,
    so the number of patterns is bounded by ``capacity``, not by the pieces.
    """
    if any(not 0 < size <= capacity for size in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    left = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        left[size] = n
    plan: list[Pattern] = []
    while True:
        used: dict[int, int] = {}
        needed: dict[int, int] = {}  # what must be there for the same choices
        gap = capacity
        sizes = np.flatnonzero(left)
        if not sizes.size:
            return plan
        while gap:
            at = int(np.searchsorted(sizes, gap, side="right")) - 1
            if at < 0:
                break
            size = int(sizes[at])
            n = int(min(left[size], gap // size))
            used[size] = needed[size] = n
            left[size] -= n
            gap -= n * size
            sizes = sizes[:at]
        while gap and sum(used.values()) > 1:
            smallest = min(used)
            total, longer, shorter = _best_pair(left, gap + smallest)
            if total <= smallest:
                break
            used[smallest] -= 1
            left[smallest] += 1
            if not used[smallest]:
                del used[smallest]
            for size in (longer, shorter):
                used[size] = used.get(size, 0) + 1
                left[size] -= 1
            for size in {longer, shorter}:
                needed[size] = max(needed.get(size, 0), used[size])
            gap += smallest - total
        again = min((int(left[s]) - (needed[s] - n)) // n for s, n in used.items())
        for s, n in used.items():
            left[s] -= again * n
        plan.append(Pattern(1 + again, tuple(sorted(used.items(), reverse=True))))


class Places:
    """Where the pieces of each length go, by rank, as sorted arrays."""

    def __init__(self, plan: list[Pattern]) -> None:
        rows, taken, sequence = [], {}, 0
        for pattern in plan:
            offset = 0
            for size, n in pattern.pieces:
                rank = taken.get(size, 0)
                rows.append((size << _RANK_BITS | rank, sequence, n, offset))
                taken[size] = rank + n * pattern.times
                offset += n * size
            sequence += pattern.times
        keys, first, uses, offsets = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4).T
        self.arrays = tuple(map(np.ascontiguousarray, (keys, first, uses, offsets)))
        self.sequences = sequence

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces of these lengths and ranks."""
        keys, first, uses, offsets = self.arrays
        at = np.searchsorted(keys, (lengths << _RANK_BITS) | ranks, side="right") - 1
        nth = ranks - (keys[at] & ((1 << _RANK_BITS) - 1))
        return first[at] + nth // uses[at], offsets[at] + nth % uses[at] * lengths


class TextIds:
    """Token ids by the libraries: tiktoken for texts of Latin letters, where its
    piece rule and the vocabulary file's agree beyond doubt, and tokenizers for
    all others and for texts that hold a special token."""

    def __init__(self, data: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(data)
        self.library = Tokenizer.from_str(data)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        ids = spec["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        merged = [ids[a + b] for a, b in pairs]
        self.plain = None
        if merged == sorted(merged):  # ids ascend as merges rank, which is tiktoken's rule
            special = {t["id"] for t in spec["added_tokens"]}
            ranks = {token: i for i, token in enumerate(bpe.token_bytes(data)) if i not in special}
            self.plain = tiktoken.Encoding("plain", pat_str=bpe._PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.latin = re.compile(bpe._LATIN_TEXT).fullmatch

    def encode(self, text: str) -> np.ndarray:
        if self.plain is not None and self.latin(text) and not any(s in text for s in self.special):
            return np.array(self.plain.encode_ordinary(text), dtype="<u4")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


@lru_cache(maxsize=1)
def _text_ids(data: str) -> TextIds:
    """One for all tasks of a worker: loading takes longer than a small task."""
    return TextIds(data)


def token_pieces(
    docs: DataFrame, path: str, text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """One row per piece: the columns of ``docs`` without the text, and ``piece``
    (from 0), ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A null or empty text is the closing id alone.  Repeated rows, also of one id
    or of a null id, are documents of their own.  Columns of ``docs`` named like
    the new ones are replaced.
    """
    new = ["piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    keep = [c for c in docs.columns if c != text_col and c.lower() not in new]
    kinds = [T.IntegerType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(T.IntegerType(), False)]
    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField(n, k, False) for n, k in zip(new, kinds)]
    )
    vocabulary = docs.sparkSession.sparkContext.broadcast(bpe._vocabulary_text(path))
    (text_,) = fresh(docs, "packing_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _text_ids(vocabulary.value).encode
        for batch in batches:
            at = 0
            for part in bpe._by_size((x.as_py() or "" for x in batch.column(len(keep))), bpe.BATCH_CHARS):
                rows, numbers, starts, lengths, sums, lists = [], [], [], [], [], []
                for k, text in enumerate(part):
                    ids = np.append(encode(text), np.uint32(end_id))
                    cuts = [0, *range(ids.size % capacity or capacity, ids.size, capacity), ids.size]
                    for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        rows.append(at + k)
                        numbers.append(piece)
                        starts.append(a)
                        lengths.append(b - a)
                        sums.append(zlib.crc32(ids[a:b].tobytes()))
                        if keep_ids:
                            lists.append(ids[a:b].astype(np.int32))
                at += len(part)
                taken = batch.take(pa.array(rows, pa.int64()))
                columns = [pa.array(numbers, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))]
                if keep_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*taken.columns[: len(keep)], *columns], [*keep, *new])
            pa.default_memory_pool().release_unused()

    return docs.select(*[col(c) for c in keep], col(text_col).alias(text_)).mapInArrow(run, schema)


def _numbered(pieces: DataFrame, length_col: str, task_: str, nth_: str, capacity: int) -> DataFrame:
    """With the task, and the piece's number among the task's pieces of its length."""
    where = pieces.columns.index(length_col)
    schema = T.StructType([*pieces.schema.fields, T.StructField(task_, T.LongType(), False), T.StructField(nth_, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            lengths = batch.column(where).to_numpy(zero_copy_only=False).astype(np.int64)
            if lengths.size and not (0 < lengths.min() and lengths.max() <= capacity):
                raise ValueError(f"lengths must be from 1 to {capacity}")
            order = np.argsort(lengths, kind="stable")
            run_of = lengths[order]
            starts = np.searchsorted(run_of, run_of)
            nth = np.empty(lengths.size, dtype=np.int64)
            nth[order] = np.arange(lengths.size) - starts + seen[run_of]
            np.add.at(seen, lengths, 1)
            columns = [*batch.columns, pa.array(np.full(lengths.size, task)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, task_, nth_])

    return pieces.mapInArrow(run, schema)


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0, without gaps) and ``offset``.

    Every row is one piece of 1 to ``capacity`` ids (else an error) and comes
    back once, repeated rows as well; a null length has no place, so both new
    columns are null; an empty table gives an empty one.  Existing columns of
    the new names are replaced.  The rows are written once to the shared folder,
    so that a lost executor renumbers nothing.
    """
    new = ("sequence_id", "offset")
    kept = [c for c in pieces.columns if c.lower() not in new]
    nowhere = pieces.where(col(length_col).isNull()).select(
        *map(col, kept), *[F.lit(None).cast("long").alias(n) for n in new]
    )
    pieces = pieces.where(col(length_col).isNotNull())
    task_, nth_, first_, number_ = fresh(pieces, "packing_task", "packing_nth", "packing_first", "packing_count")
    numbered = stored(_numbered(pieces.select(*map(col, kept)), length_col, task_, nth_, capacity), "packing-pieces")
    counts = numbered.groupBy(col(length_col), task_).agg(F.count(F.lit(1)).alias(number_))
    totals = counts.groupBy(col(length_col)).agg(F.sum(number_))  # a row for each length at most
    places = Places(best_two_fit({int(size): int(n) for size, n in totals.collect()}, capacity))
    plan = pieces.sparkSession.sparkContext.broadcast(places)
    before = Window.partitionBy(col(length_col)).orderBy(task_).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(col(length_col), task_, F.coalesce(F.sum(number_).over(before), F.lit(0).cast("long")).alias(first_))
    ranked = numbered.join(first, [length_col, task_]).select(
        *map(col, kept), col(length_col).cast("long").alias(task_), (F.col(nth_) + F.col(first_)).alias(nth_)
    )
    schema = T.StructType([pieces.schema[c] for c in kept] + [T.StructField(n, T.LongType()) for n in new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(len(kept) + k).to_numpy() for k in (0, 1))
            found = plan.value.find(lengths, ranks)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *map(pa.array, found)], [*kept, *new])

    return ranked.mapInArrow(run, schema).unionByName(nowhere)


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """(sequence_id, ids): the packed sequences; a sequence holds ``capacity`` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", col(ids_col).alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(token_pieces(docs, bpe.default_path()))
