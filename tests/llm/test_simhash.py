"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash
from conftest import SF001
from pyspark.sql import functions as F

from telewatch.llm import components, simhash
from telewatch.llm.common import table
from telewatch.llm.components import connected_components


def brute_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=3):
    """fp per id -> smallest id reachable."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    expected = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op3_simhash(spark, SF001).collect()}
    assert got == {i: (f"{fps[i]:016x}", expected[i]) for i in texts}


@pytest.mark.parametrize("crowded", [256, 3])
@pytest.mark.parametrize("segments", [2, 3, 4])
def test_links_equal_brute_force(spark, crowded, segments):
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    fps = {0, (1 << 64) - 1, 1, 7, 15}
    for c in centres:
        for _ in range(40):
            f = c
            for _ in range(rnd.randint(0, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(r.a, r.b) for r in simhash.links(frame, 3, segments, crowded).collect()}
    mask = (1 << 64) - 1
    expected = {(a, b) for a in signed for b in signed if a < b and ((a & mask) ^ (b & mask)).bit_count() <= 3}
    assert got == expected


def test_edge_rows(spark):
    rows = [(5, None, "x"), (4, "", "x"), (9, "One  two", None), (9, "one two", "y"), (None, "one two", "z"), (2, " ", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = sorted(((r.id, r.fp, r.component) for r in simhash.simhash_dedup(docs).collect()), key=str)
    f = brute_fingerprint("one two")
    f = f - (1 << 64) if f >> 63 else f
    g = brute_fingerprint(" ")
    g = g - (1 << 64) if g >> 63 else g
    assert got == sorted([(5, 0, 4), (4, 0, 4), (9, f, 9), (9, f, 9), (None, f, 9), (2, g, 2)], key=str)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "9"]
    assert simhash.simhash_dedup(docs.limit(0)).count() == 0


def test_very_long_text():
    text = "a b c d " * 100_000
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_repeated_ids_lose_no_group(spark):
    t1, t2 = "some words that are here", "other words of another text altogether"
    rows = [(3, t1), (5, t1.upper()), (5, t2), (9, t2.title()), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, t1), (5, t2), (None, "alone")], key=str)


def test_exactly_one_row_of_each_group_stays(spark):
    """Repeated ids, repeated rows and null ids included, whatever else a row holds."""
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    groups = [" ".join(rnd.sample(words, 30)) for _ in range(12)]
    rows = [(rnd.choice([None, 1, 2, 3, 40]), g.title() if rnd.random() < 0.5 else g, rnd.random()) for g in groups for _ in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sh_row double").repartition(7)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = {r.text.lower(): r.doc_id for r in kept.collect()}
    least = {g: min((i for i, t, _ in rows if t.lower() == g and i is not None), default=None) for g in groups}
    assert got == least and kept.count() == len(groups)
    nulls = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "sh_row")
    assert simhash.keep_one_of_each(nulls).count() == len(groups)


def test_copies_of_one_text_are_dealt_over_the_tasks(spark):
    docs = spark.range(0, 4000, 1, 5).selectExpr("id % 3 AS doc_id", "if(id % 3 = 0, 'text of its own ' || id, 'one hot text') AS text")
    found = simhash.simhash_dedup(docs).where(F.col("fp") == _signed(brute_fingerprint("one hot text")))
    assert found.count() == 2666 and {r.component for r in found.select("component").distinct().collect()} == {1}
    rows = simhash.with_fingerprints(docs, "text", 3, ["doc_id"])
    assert rows.select("row").distinct().count() == 4000
    cells = [r["count"] for r in rows.where("doc_id = 1").groupBy("fp", (F.col("row") % 8).alias("cell")).count().collect()]
    assert len(cells) == 8 and max(cells) < 2 * min(cells)


def _signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def test_components_of_hubs_chains_and_loops(spark):
    """A node with very many edges, a long chain, loops and repeated edges."""
    hub = [(5000, k) for k in range(5001, 8000)] + [(k, 5000) for k in range(8000, 9000)]
    chain = [(k, k + 1) for k in range(100, 200)]
    edges = hub + chain + chain[:5] + [(k + 1, k) for k in range(105, 110)] + [(7, 7), (9000, 9001), (-3, 9001)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {k: 5000 for k in range(5001, 9000)} | {k: 100 for k in range(101, 201)} | {9000: -3, 9001: -3}
    assert len(got) == len(expected) and {r.node: r.root for r in got} == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_hub_s_edges_are_dealt_over_the_cells(spark):
    edges = spark.range(1, 4001).selectExpr("0L AS a", "id AS b")
    least = spark.createDataFrame([(0, -1)], "a long, m long")
    rows = components._with_least(edges, least, 8)
    assert rows.count() == 4000 and rows.where("m = -1").count() == 4000
    sizes = [r["count"] for r in rows.groupBy("cell").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
