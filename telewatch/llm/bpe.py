"""Byte-level BPE encoding and decoding with a pair occurrence index.

Encoding, inside each partition: the texts are cut into pieces by the
vocabulary's pattern, and the pieces not met before in this partition go to
the index together.  The index maps each pair of neighbouring symbols to all
its positions; a heap holds the ranks of the pairs that occur.  Ranks are taken
in ascending order: all positions of the pair merge at once, and the lists of
the pairs beside each merge are updated.  The pieces' ids are kept for later
texts, in a table of bounded size.

Special tokens found in a text become their ids, as the vocabulary file says.
Decoding joins the tokens' bytes and reads them as UTF-8, broken sequences
becoming U+FFFD.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm.common import col, fresh, table

TOKENIZER = "byte_bpe_50k.json"
KEPT_PIECES = 150_000  # pieces whose ids a task keeps
BATCH_CHARS = 4 << 20  # texts of about so many characters go to the index together
FEW = 24  # up to so many positions of a pair merge one by one, more as arrays

# Fixed values of the byte-level alphabet: bytes that stand for themselves; the
# others take the code points from 256 on, in order.
_PLAIN = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
# The piece pattern, and the same for texts of Latin letters alone, where the
# standard library's faster engine can stand in.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_L, _S = "A-Za-zÀ-ÖØ-öø-ɏ", "\\t-\\r "
_LATIN_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^{_S}0-9{_L}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_LATIN_TEXT = rf"[\t-\r -\x7e{_L[6:]}]*"


def byte_alphabet() -> dict[int, str]:
    alphabet = {b: chr(b) for b in _PLAIN}
    alphabet |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in alphabet)}
    return alphabet


def token_bytes(data: str) -> list[bytes]:
    """The bytes of every id of a vocabulary file."""
    spec = json.loads(data)
    to_byte = {c: b for b, c in byte_alphabet().items()}
    ids, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in ids.items():
        out[i] = bytes(to_byte[c] for c in token)
    for token, i in special.items():
        out[i] = token.encode()
    return out


class Vocabulary:
    """What encoding needs of a vocabulary file: ranked merges, special tokens, the pattern."""

    def __init__(self, data: str) -> None:
        import re

        import regex

        spec = json.loads(data)
        model = spec["model"]
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = np.array([ids[c] for _, c in sorted(byte_alphabet().items())], dtype=np.int32)
        #: by rank: left id, right id, merged id
        self.merge_list: list[tuple[int, int, int]] = []
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merge_list.append((ids[a], ids[b], ids[a + b]))
        self.rank_of = {(a, b): rank for rank, (a, b, _) in enumerate(self.merge_list)}
        keys = np.array([a << 32 | b for a, b, _ in self.merge_list], dtype=np.int64)
        self._key_ranks = np.argsort(keys, kind="stable")
        self._keys = keys[self._key_ranks]
        self.pieces = regex.compile(_PATTERN).findall
        self.latin_pieces = re.compile(_LATIN_PATTERN).findall
        self.latin = re.compile(_LATIN_TEXT).fullmatch
        specials = sorted(self.special, key=len, reverse=True)
        self.split_special = re.compile("(" + "|".join(map(re.escape, specials)) + ")").split if specials else None

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; -1 where no merge joins them."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._key_ranks[at], -1)

    def cut(self, text: str) -> list[str]:
        return self.latin_pieces(text) if self.latin(text) else self.pieces(text)


def merge_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces, one after the other, and the number of each
    piece's ids, by the pair occurrence index over all of them."""
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    n = int(sizes.sum()) + len(pieces)
    symbol = np.full(n + 1, -1, dtype=np.int32)  # -1 after each piece: pairs never cross pieces
    inside = np.ones(n + 1, dtype=bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    inside[n] = False
    symbol[inside] = vocabulary.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    after = np.arange(1, n + 2, dtype=np.int32)
    before = np.arange(-1, n, dtype=np.int32)
    #: rank of a pair -> its positions, as arrays and one by one
    positions: dict[int, tuple[list[np.ndarray], list[int]]] = {}
    active: list[int] = []
    known, merge_list = vocabulary.rank_of.get, vocabulary.merge_list
    symbol_at, after_at, before_at = memoryview(symbol), memoryview(after), memoryview(before)

    def listed(rank: int) -> tuple[list[np.ndarray], list[int]]:
        if rank not in positions:
            positions[rank] = ([], [])
            heapq.heappush(active, rank)
        return positions[rank]

    def add(at: np.ndarray, ranks: np.ndarray) -> None:
        found = ranks >= 0
        at, ranks = at[found], ranks[found]
        if not at.size:
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for start, end, rank in zip(starts, [*starts[1:], at.size], ranks[starts].tolist(), strict=True):
            if end - start > FEW:
                listed(rank)[0].append(at[start:end])
            else:
                listed(rank)[1].extend(at[start:end].tolist())

    def merge_few(at: list[int], left: int, right: int, new: int) -> None:
        for p in sorted(at):
            gone = after_at[p]
            if symbol_at[p] != left or symbol_at[gone] != right:
                continue  # an earlier merge has changed what stands here
            end, start = after_at[gone], before_at[p]
            symbol_at[p], symbol_at[gone] = new, -2
            after_at[p], before_at[end] = end, p
            rank = known((new, symbol_at[end]))
            if rank is not None:
                listed(rank)[1].append(p)
            if start >= 0:
                rank = known((symbol_at[start], new))
                if rank is not None:
                    listed(rank)[1].append(start)

    def merge_many(at: np.ndarray, left: int, right: int, new: int) -> None:
        at = np.unique(at[(symbol[at] == left) & (symbol[after[at]] == right)])
        if left == right and at.size > 1:  # in a run of one symbol every other pair merges
            follows = np.concatenate(([False], after[at[:-1]] == at[1:]))
            index = np.arange(at.size)
            run = np.maximum.accumulate(np.where(follows, 0, index))
            at = at[(index - run) % 2 == 0]
        if not at.size:
            return
        gone = after[at]
        end = after[gone]
        symbol[at], symbol[gone] = new, -2
        after[at], before[end] = end, at
        start = before[at]
        fused = np.full(at.size, new, dtype=np.int32)
        # Index -1, before the first piece, reads the -1 at the end.
        lefts, rights = np.concatenate((fused, symbol[start])), np.concatenate((symbol[end], fused))
        add(np.concatenate((at, start)), vocabulary.ranks_of(lefts, rights))

    first = np.flatnonzero(inside[:-1] & inside[1:])
    add(first, vocabulary.ranks_of(symbol[first], symbol[first + 1]))
    while active:
        rank = heapq.heappop(active)
        arrays, few = positions.pop(rank)
        if arrays or len(few) > FEW:
            merge_many(np.concatenate([*arrays, np.asarray(few, dtype=np.int64)]), *merge_list[rank])
        else:
            merge_few(few, *merge_list[rank])
    symbol = symbol[:n]
    symbol = symbol[symbol != -2]
    ends = np.flatnonzero(symbol == -1)
    counts = np.diff(np.concatenate(([-1], ends))) - 1
    return symbol[symbol >= 0], counts


class Encoder:
    """Encodes texts, keeping the ids of pieces between calls."""

    def __init__(self, vocabulary: Vocabulary, kept_pieces: int = KEPT_PIECES) -> None:
        self.vocabulary, self.limit = vocabulary, kept_pieces
        self.forget()

    def forget(self) -> None:
        #: piece -> its number, given at first sight
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids, self.counts = np.empty(0, np.int32), np.empty(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's ids."""
        v, number = self.vocabulary, self.number.__getitem__
        if len(self.number) > self.limit:
            self.forget()
            number = self.number.__getitem__
        numbers: list[np.ndarray] = []
        for text in texts:
            if v.split_special and any(s in text for s in v.special):
                parts: list[str] = []
                for k, part in enumerate(v.split_special(text)):
                    parts += [part] if k % 2 else v.cut(part)
            else:
                parts = v.cut(text)
            numbers.append(np.fromiter(map(number, parts), dtype=np.int32, count=len(parts)))
        self._learn(list(islice(self.number, len(self.counts), None)))
        each = np.fromiter(map(len, numbers), dtype=np.int64, count=len(numbers))
        pieces = np.concatenate([np.empty(0, np.int32), *numbers])
        counts = self.counts[pieces]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if ends.size else 0
        starts = (np.cumsum(self.counts) - self.counts)[pieces]
        where = np.arange(total) + np.repeat(starts - (ends - counts), counts)
        upto = np.concatenate(([0], ends))
        text_ends = np.cumsum(each)
        return self.ids[where], upto[text_ends] - upto[text_ends - each]

    def _learn(self, pieces: list[str]) -> None:
        v = self.vocabulary
        ids, counts = merge_pieces([b"" if p in v.special else p.encode() for p in pieces], v)
        special = [k for k, p in enumerate(pieces) if p in v.special]
        if special:  # a special token is one id
            at = np.cumsum(counts)[special]
            ids = np.insert(ids, at, [v.special[pieces[k]] for k in special])
            counts[special] = 1
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.counts = np.concatenate((self.counts, counts))


def decode(ids: Iterable[int], tokens: list[bytes]) -> str:
    return b"".join(map(tokens.__getitem__, ids)).decode("utf-8", "replace")


def _by_size(texts: Iterable[str], limit: int) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


def _vocabulary_text(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _outside(df: DataFrame, *results: str) -> list[str]:
    return [c for c in df.columns if c.lower() not in {r.lower() for r in results}]


def _decoded(ids: np.ndarray, ends: np.ndarray, tokens: list[bytes]) -> pa.Array:
    return pa.array((decode(ids[a:b].tolist(), tokens) for a, b in zip(ends[:-1], ends[1:], strict=True)), pa.string())


def bpe_encode(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
    kept_pieces: int = KEPT_PIECES,
) -> DataFrame:
    """``docs`` with ``ids_col``, the token ids of the whole text, and, if named,
    ``decoded_col``, what these ids decode to (see :func:`bpe_decode`).

    Every row comes back with its other columns (those named like the new ones
    are replaced).  Null and empty texts have no ids; repeated rows are encoded
    like any other; an empty table gives an empty table.  ``path`` is read by
    the driver; the vocabulary, of fixed size, is broadcast.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary_text(path))
    new = [ids_col, *([decoded_col] if decoded_col else [])]
    keep = _outside(docs, *new)
    fields = [docs.schema[c] for c in keep] + [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType(), False))
    (text_,) = fresh(docs, "bpe_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(vocabulary.value), kept_pieces)
        tokens = token_bytes(vocabulary.value) if decoded_col else []
        for batch in batches:
            texts = (x.as_py() or "" for x in batch.column(len(keep)))
            at = 0
            for part in _by_size(texts, BATCH_CHARS):
                flat, counts = encoder.encode(part)
                ends = np.concatenate(([0], np.cumsum(counts)))
                out = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))]
                if decoded_col:
                    out.append(_decoded(flat, ends, tokens))
                rows = batch.slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], *out], [*keep, *new])
            pa.default_memory_pool().release_unused()

    return docs.select(*[col(c) for c in keep], col(text_col).alias(text_)).mapInArrow(run, T.StructType(fields))


def bpe_decode(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``, the text of the ids; null ids give an empty text.

    An id outside the vocabulary raises: it has no text.  Other rows and
    columns as in :func:`bpe_encode`.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(_vocabulary_text(path))
    keep = _outside(docs, text_col)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text_col, T.StringType(), False)])
    (ids_,) = fresh(docs, "bpe_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(vocabulary.value)
        for batch in batches:
            lists = batch.column(len(keep)).fill_null([])
            ids, ends = lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_pylist()])
            texts = _decoded(ids, ends, tokens)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], [*keep, text_col])

    return docs.select(*[col(c) for c in keep], col(ids_col).alias(ids_)).mapInArrow(run, schema)


def digests(
    encoded: DataFrame, ids_col: str = "ids", text_col: str = "decoded", keep_ids: bool = False
) -> DataFrame:
    ids = F.transform(col(ids_col), lambda i: i.cast("string"))
    return encoded.select(
        "doc_id",
        *([col(ids_col)] if keep_ids else []),
        F.size(col(ids_col)).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids, ","), 256).alias("ids_sha256"),
        F.sha2(col(text_col), 256).alias("decoded_sha256"),
    )


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(bpe_encode(docs, default_path(), decoded_col="decoded").select("doc_id", "ids", "decoded"))
