"""Collocations against counting every phrase by itself."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF01

from telewatch.llm import collocations as colloc
from telewatch.llm import countmin

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest=5):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang or "und"][tuple(words[i : i + k])] += 1
    return counts


def brute_force(rows, min_count=100, longest=5, top=2000):
    out = []
    for lang, f in counted(rows, longest).items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= min_count}
        inside = set()
        for g, a in often.items():
            for k in range(2, len(g)):
                inside |= {g[i : i + k] for i in range(len(g) - k + 1) if f[g[i : i + k]] <= a}
        scores = []
        for g, a in often.items():
            if g not in inside:
                cuts = [(1000 * a * n // (f[g[:k]] * f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))]
                score, _, left, right = min(cuts)
                scores.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(scores)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n, -score))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def result(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def random_rows(seed, n=300):
    rnd = random.Random(seed)
    vocabulary = [*"abcdefgh", "É", "漢字", "it's", "\x1c", "x" * 60]
    passage = "one passage that many documents share and that goes on for more words than any phrase may have"
    rows = []
    for i in range(n):
        words = rnd.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=rnd.randint(0, 60))
        text = "".join(w + rnd.choice([" "] * 8 + ["\t", "  ", ".", ", ", "\n", "?!", "\r\n"]) for w in words)
        rows.append((rnd.choice(["en", "en", "de", None]), text + (passage.upper() if i % 3 else "") + rnd.choice(["", " a a a a a a a"])))
    return rows


@pytest.mark.parametrize(("seed", "min_count", "longest", "top", "cells"), [(1, 12, 5, 2000, 1 << 24), (2, 3, 4, 7, 1 << 10), (3, 20, 2, 50, 16), (4, 300, 5, 9, 1 << 24)])
def test_equals_brute_force(spark, seed, min_count, longest, top, cells):
    """Also with a sketch that is too full to cut anything."""
    rows = random_rows(seed, 300 if min_count < 300 else 900)
    got = colloc.collocations(frame(spark, rows), min_count=min_count, longest=longest, top=top, most_cells=cells)
    assert result(got) == brute_force(rows, min_count, longest, top)


def test_small_limits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(colloc, "PATH_PART", 3)
    rows = random_rows(5)
    assert result(colloc.collocations(frame(spark, rows), min_count=15)) == brute_force(rows, 15)


def test_task_limits_change_nothing():
    """Numbering words anew, and adding grams up early, keeps every count."""
    rows = random_rows(6)
    words, grams, total = colloc.Words(), colloc.Grams(5), Counter()
    for k, (_, text) in enumerate(rows):
        ids = words.ids(text.encode())
        if not ids.size:
            continue
        grams.add(ids, words.pairs(ids, "en")[0])
        if k % 7 == 0:
            grams.add_up()
        if k % 50 == 49 or k == len(rows) - 1:
            for batch in grams.out("en", list(words.number)):
                for gram, f in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                    total[tuple(gram.split(" "))] += f
            words, grams = colloc.Words(), colloc.Grams(5)
    expected = Counter()
    for _, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", text.translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            expected.update(tuple(w[i : i + 5]) for i in range(len(w)))
    assert total == expected


def test_graph_keeps_flow(spark):
    rows = random_rows(7)
    edges = colloc.graph(frame(spark, rows), min_count=1)
    f = counted(rows)
    for k, df in colloc.flows(edges).items():
        got = {(r.lang, tuple(r.gram.split(" "))): r.f for r in df.collect()}
        assert got == {(lang, g): a for lang, c in f.items() for g, a in c.items() if len(g) == k}


def test_unary_paths_are_the_repeated_passages(spark):
    passage = [f"p{i}" for i in range(40)]
    rows = [("en", " ".join(passage))] * 9 + [("en", "before " + " ".join(passage[10:30]) + " after")] * 4
    counts = colloc.flows(colloc.graph(frame(spark, rows), min_count=3))
    paths = colloc.unary_paths(counts[5], counts[4]).collect()
    spans = sorted((r.words[0], r.words[-1], len(r.words), r.f) for r in paths)
    # the shared middle occurs 13 times, its neighbourhoods 9 or 4 times
    assert ("p10", "p29", 20, 13) in spans and ("p0", "p13", 14, 9) in spans and ("p26", "p39", 14, 9) in spans
    assert sorted(x[3] for x in spans) == [4, 4, 9, 9, 13]


def test_loops_end(spark):
    rows = [("en", "a b c " * 50), ("en", "a " * 300), ("de", "x y " * 3)]
    assert result(colloc.collocations(frame(spark, rows), min_count=5)) == brute_force(rows, 5)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("lang", "text").collect()
    assert result(colloc.op11_collocations(spark, SF01)) == brute_force([tuple(r) for r in docs])


def test_scores_beyond_64_bits(spark):
    big = 10**14
    found = spark.createDataFrame([("en", "a b", 2, big)], "lang string, gram string, size int, a long")
    known = spark.createDataFrame([("en", "a", big + 7), ("en", "b", big + 11)], "lang string, gram string, f long")
    totals = spark.createDataFrame([("en", 9 * big + 3)], "lang string, n long")
    (row,) = colloc.scored(found, known, totals).collect()
    assert row.score == 1000 * big * (9 * big + 3) // ((big + 7) * (big + 11))


def test_edge_rows(spark):
    kind = "text string, gram string, size int, n string"
    none = spark.createDataFrame([(None, "x", 1, None), ("", None, 2, "y"), (" \t.!", "x", 3, "z")], kind)
    assert colloc.collocations(none, group_col="gram", min_count=1).collect() == []
    assert colloc.collocations(none.limit(0), group_col="gram").collect() == []
    one = spark.createDataFrame([("Same words", None, 1, "x")] * 2 + [("Word " * 30_000, None, 0, None)], kind)
    got = result(colloc.collocations(one, group_col="gram", min_count=2))
    assert got == brute_force([(None, "same words")] * 2 + [(None, "word " * 30_000)], 2)


def test_estimates_never_lie_below():
    rnd = np.random.default_rng(1)
    keys = rnd.integers(0, 500, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for width in (64, 1 << 12):
        counter = countmin.Counter(width, 3, 200)
        for part in np.split(keys, 4):
            counter.add(part)
        sketch = np.minimum(counter.counts, 200).astype(np.uint8)
        values, times = np.unique(keys, return_counts=True)
        assert (countmin.estimate(sketch, values) >= np.minimum(times, 200)).all()
    assert (countmin.estimate(sketch, values) == times).mean() > 0.9


def test_oracle_equals_brute_force():
    rows = [(lang, text) for lang, text in random_rows(8, 900)]
    import pandas as pd

    documents = pd.DataFrame(rows, columns=["lang", "text"])  # noqa: F841  read by name
    got = duckdb.sql(colloc.ORACLE).fetchall()
    assert sorted(got) == brute_force(rows)
