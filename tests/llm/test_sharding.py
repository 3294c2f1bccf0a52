"""Extendible hashing against a brute-force directory."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telewatch.llm import sharding
from telewatch.llm.sharding import HASH_BITS, directory, entries, hash_bits, shard


def brute(rows, limit):
    """Sorted (id, bytes, shard) by splitting buckets one bit at a time."""

    def bits(key):
        return format(int(hashlib.md5(key.encode()).hexdigest()[: HASH_BITS // 4], 16), f"0{HASH_BITS}b")

    hashed = []
    for (id_, text), n in Counter((r[0], r[1]) for r in rows).items():
        mark = "n" if text is None else "t"
        b = bits(f"{'' if id_ is None else id_}|{mark}|{hashlib.md5((text or '').encode()).hexdigest()}")
        size = len((text or "").encode())
        for k in range(n):
            own = bits(f"{int(b, 2)}|{k}") if n > 1 and n * size > limit else b
            hashed.append((id_, size, own))
    out = []

    def split(bucket, depth):
        if not bucket:
            return
        if sum(r[1] for r in bucket) <= limit or depth == HASH_BITS:
            out.extend((i, size, b[:depth]) for i, size, b in bucket)
            return
        for bit in "01":
            split([r for r in bucket if r[2][depth] == bit], depth + 1)

    split(hashed, 0)
    return sorted(out, key=str)


def got(spark, rows, limit):
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string, n_bytes string")
    return sorted(((r.id, r.n_bytes, r.shard_id) for r in shard(docs, limit).collect()), key=str)


@pytest.mark.parametrize("limit", [300, 5_000, 10_000_000])
def test_equals_brute_force(spark, limit):
    rows = [(i, "é" * (i % 37) + "x" * (i % 5), "b", None) for i in range(400)]
    assert got(spark, rows, limit) == brute(rows, limit)


def test_hot_repeats_spread_and_every_shard_fits(spark):
    rows = [(7, "r" * 50, None, None)] * 9000 + [(i, "t" * 40, None, None) for i in range(1000)]
    found = got(spark, rows, 2_000)
    assert found == brute(rows, 2_000)
    sizes = Counter()
    for _, size, name in found:
        sizes[name] += size
    assert max(sizes.values()) <= 2_000


def test_edge_rows(spark):
    rows = [(None, None, "a", "b"), (None, "", "a", None), (1, None, None, None), (1, None, None, None), (2, "y" * 5000, "c", "d"), (3, "z", "", "")]
    found = got(spark, rows, 100)
    assert found == brute(rows, 100)
    assert len(found) == len(rows)
    big = [name for _, size, name in found if size == 5000]
    assert sum(name == big[0] for _, _, name in found) == 1 and len(big[0]) == HASH_BITS


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shard(docs, 10).collect() == []


@pytest.mark.parametrize("n, size, limit", [(5_000, 6_000, 1 << 20), (4_000, 10, 1 << 20), (2_000, 30, 100)])
def test_the_directory_grows_with_the_shards(spark, n, size, limit):
    cells = spark.range(n).select(hash_bits(F.col("id").cast("string")).alias("bits"), F.lit(size).alias("bytes"), F.lit(1).alias("rows"))
    found = directory(cells, limit)
    shards = found.collect()
    assert sum(r.rows for r in shards) == n and all(r.bytes <= limit for r in shards)
    assert len(shards) <= max(1, 4 * n * size // limit)
    names = sorted(format(r.prefix, "b").zfill(r.depth)[: r.depth] for r in shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    pointers, level = entries(found, len(shards))
    assert pointers.count() <= 2 * len(shards) and 1 << level <= len(shards)


def test_shuffled_directory_gives_the_same(spark, monkeypatch):
    rows = [(i, "x" * (i % 90), "b", None) for i in range(700)] + [(None, None, "n", None)] * 9_000
    monkeypatch.setattr(sharding, "BROADCAST_SHARDS", 0)
    assert got(spark, rows, 500) == brute(rows, 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, bits string, n_bytes string")
    sizes = Counter()
    for r in (found := shard(docs, 500).collect()):
        sizes[r.shard_id] += r.n_bytes
    assert all(r.shard_bytes == sizes[r.shard_id] for r in found)
