"""Quality rules against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
import xxhash
from conftest import SF01

from pyspark.sql import functions as F

from telewatch.llm import quality
from telewatch.llm.common import table


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


EDGE = [
    None, "", " \t\n", "one", "a b c d e a b c d e", "x " * 40, "l1\nl1\n\n\nl2\nl1", "a|b #c $d %e &f *g <h> i j k l",
    "z\x0bq\x0cw\re", "nb\xa0sp \x85 x", "aa bb cc dd ee ff aa bb cc dd ee gg", "\n" * 50, "v w x y z " * 30_000,
]


def test_base_rules_equal_brute_force(spark):
    rows = [(k, t, "w", 1) for k, t in enumerate(EDGE)] + [(None, EDGE[4], "w", 1), (4, EDGE[4], "w", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, w string, qr_h int")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted(((r.id, *[r[n] for n in names]) for r in quality.base_rules(docs).collect()), key=str)
    assert got == sorted(((r[0], *base(r[1])) for r in rows), key=str)
    assert quality.base_rules(docs.limit(0)).collect() == []


@pytest.mark.parametrize("window", [1, 2, 5])
def test_windows_are_hashed_from_the_hashes_of_words(spark, window):
    """op2_quality: each word is hashed once, not once for every window it is in."""
    texts = [*EDGE[:-1], "a b a b a b c", "b a " * 7 + "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = quality.with_repeat_words(docs.select("id", quality.split_words(F.col("text")).alias("w")), "w", "n", window)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(w#" not in plan and plan.count("transform(w#") == 1
    for r in rows.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.id] or "")
        windows = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
        counts = Counter(windows)
        assert r.n == len({i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(window)})


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def long_hash(value, seed):
    return signed(xxhash.xxh64_intdigest(value.to_bytes(8, "little", signed=True), seed & ((1 << 64) - 1)))


def buckets(text):
    tokens = re.findall(r"\w+|[^\w\s]+", (text or "").lower())
    hashes = [signed(xxhash.xxh64_intdigest(t.encode(), 42)) for t in tokens]
    out = [h % quality.BUCKETS for h in hashes]
    for k, h in enumerate(hashes):
        one = long_hash(h, 42)
        out.append((long_hash(hashes[k + 1], one) if k + 1 < len(hashes) else one) % quality.BUCKETS)
    return out


@pytest.fixture(scope="module")
def rows(spark):
    return {r.doc_id: r for r in quality.op2_quality(spark, SF01).collect()}


def test_query_scores_equal_brute_force(spark, rows):
    docs = {r.doc_id: r.text for r in table(spark, SF01, "documents").collect()}
    good = {r.doc_id for r in table(spark, SF01, "labels").where("quality = 1").collect()}
    grams = {i: buckets(t) for i, t in docs.items()}
    corpus, target = Counter(), Counter()
    for i, g in grams.items():
        corpus.update(g)
        if i in good:
            target.update(g)
    n, k, size = sum(corpus.values()), sum(target.values()), quality.BUCKETS
    weight = {b: math.log((target[b] + 1) / (k + size) / ((c + 1) / (n + size))) for b, c in corpus.items()}
    assert set(rows) == set(docs)
    for i, text in docs.items():
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text)
        score = sum(weight[b] for b in grams[i]) / len(grams[i]) if grams[i] else 0.0
        assert abs(r.score - score) < 2e-6
    kept = [r.score for r in rows.values() if r.kept]
    dropped = [r.score for r in rows.values() if not r.kept and not r.base_failed]
    assert max(dropped) < min(kept) and not any(r.kept and r.base_failed for r in rows.values())


def test_verdicts_follow_the_labels(spark, rows):
    labels = {r.doc_id: r.quality for r in table(spark, SF01, "labels").collect()}
    judged = [(labels[i], rows[i].kept) for i in labels if not rows[i].base_failed]
    right = sum(q == k for q, k in judged)
    assert right / len(judged) > 0.98


def test_without_labels_nothing_falls_by_score(spark):
    docs = spark.createDataFrame([(1, "some words that are more than ten in number and all differ"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, None), (None, 1)], [(1, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        got = {r.id: r.kept for r in quality.quality(docs, frame).collect()}
        assert got == {1: True, 2: False}
