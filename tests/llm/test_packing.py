"""Packing against an item-by-item packer, and the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from tokenizers import Tokenizer

from telewatch.llm import bpe, packing
from telewatch.llm.common import table

PATH = bpe.default_path()


def one_by_one(counts, capacity):
    """Best-two-fit without patterns: every sequence by itself."""
    left, bins = Counter(counts), []
    while +left:
        left, filled, gap = +left, [], capacity
        for size in sorted(left, reverse=True):
            while left[size] and size <= gap:
                filled.append(size)
                left[size] -= 1
                gap -= size
        while gap and len(filled) > 1:
            smallest = min(filled)
            room = gap + smallest
            pairs = [
                (x + y, x, y) for x in +left for y in +left if y <= x and x + y <= room and (x != y or left[x] > 1)
            ]
            if not pairs or max(pairs)[0] <= smallest:
                break
            filled.remove(smallest)
            left[smallest] += 1
            for size in max(pairs)[1:]:
                filled.append(size)
                left[size] -= 1
            gap = capacity - sum(filled)
        bins.append(tuple(sorted(filled, reverse=True)))
    return sorted(bins)


@pytest.mark.parametrize("seed", range(120))
def test_patterns_equal_single_bins(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 17, 40, 64])
    sizes = rnd.sample(range(1, capacity + 1), rnd.randint(1, min(capacity, 12)))
    counts = {s: rnd.randint(1, rnd.choice([2, 30])) for s in sizes}
    plan = packing.best_two_fit(counts, capacity)
    bins = sorted(tuple(s for s, n in p.pieces for _ in range(n)) for p in plan for _ in range(p.times))
    assert bins == one_by_one(counts, capacity)


def test_pairs_replace_the_smallest():
    # greedily 6 + 3 leaves a gap of 1, 5 + 4 + 1 comes after it; 3 gives way to 2 + 2
    (first, *_) = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert first == packing.Pattern(1, ((6, 1), (2, 2)))


def test_many_pieces_need_few_patterns():
    rnd = random.Random(1)
    counts = {s: rnd.randint(1, 10**9) for s in range(1, 2049)}
    plan = packing.best_two_fit(counts)
    assert len(plan) < 20_000
    packed = Counter()
    for p in plan:
        for size, n in p.pieces:
            packed[size] += n * p.times
        assert sum(size * n for size, n in p.pieces) <= 2048
    assert packed == counts
    least = sum(s * n for s, n in counts.items()) / 2048
    assert sum(p.times for p in plan) < 1.01 * least


def check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_query_equals_library(spark):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    rows = packing.op12_packing(spark, SF001).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    assert len(got) == len(rows)
    expected = {}
    for r in table(spark, SF001, "documents").collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[r.doc_id, piece] = (a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
    assert got == expected
    counts = Counter(r.length for r in rows)
    assert check_places(rows, 2048) == len(one_by_one(counts, 2048))


def test_odd_texts_equal_library():
    with open(PATH, encoding="utf-8") as file:
        ours = packing.TextIds(file.read())
    assert ours.plain is not None
    library = ours.library
    rnd = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'LL", "<|endoftext|>", "\u00a0", "\u0085", "é", "ß", "1", "²", "½", "漢",
             "😀", "\x1c", "\x00", "\u200b", "!", "\u0301", "ʰ", "_", " of", "ing", "×", "aaaaaaa", "      ", "ÿ", "ſ"]
    latin = [p for p in parts if ours.latin(p)]
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 60))) for some in (parts, latin) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 4001, "ab" * 3000, "word " * 20_000, "é" * 700]
    for text in texts:
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_length_that_most_rows_share(spark):
    pieces = spark.range(0, 20_000, numPartitions=16).selectExpr("id", "if(id % 3 = 0, id % 50 + 1, 7) AS length")
    rows = packing.pack(pieces, capacity=50).collect()
    assert sorted(r.id for r in rows) == list(range(20_000))
    assert check_places(rows, 50) == len(one_by_one(Counter(r.length for r in rows), 50))


def test_sequences_hold_the_documents_ids(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, PATH, keep_ids=True, capacity=300)
    packed = packing.pack(pieces, capacity=300)
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
        assert len(whole[r.sequence_id]) <= 300


def test_edge_rows(spark):
    rows = [(1, None, 5), (1, "", 6), (1, "", 6), (None, "word " * 3000, 7), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, packing_text long")
    out = packing.pack(packing.token_pieces(docs, PATH)).collect()
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.packing_text)) for r in out) == sorted(
        map(str, [(1, 0, 0, 1, 5), (1, 0, 0, 1, 6), (1, 0, 0, 1, 6), (None, 0, 0, 1, None),
                  (None, 0, 0, 954, 7), (None, 1, 954, 2048, 7)])
    )
    check_places(out, 2048)
    empty = packing.pack(packing.token_pieces(docs.limit(0), PATH))
    assert empty.collect() == [] and "sequence_id" in empty.columns
    clash = spark.createDataFrame([("x", 3, "y"), ("z", None, "y")], "sequence_id string, length int, packing_task string")
    assert sorted(map(str, packing.pack(clash, capacity=3).collect())) == sorted(
        ["Row(length=3, packing_task='y', sequence_id=0, offset=0)", "Row(length=None, packing_task='y', sequence_id=None, offset=None)"]
    )
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(clash.where("length = 3"), capacity=2).collect()
