"""Repeated-substring removal against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from conftest import SF001

from telewatch.llm import substring_dedup as sd
from telewatch.llm.common import table


def brute(texts, window):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if counts[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_query_equals_brute_force(spark):
    rows = table(spark, SF001, "documents").select("doc_id", "text").collect()
    expected = dict(zip((r.doc_id for r in rows), brute([r.text for r in rows], 200), strict=True))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.op5_substring_dedup(spark, SF001).collect()}
    assert got == expected


def test_index_equals_brute_force():
    rnd = random.Random(2)
    for _ in range(150):
        base = "".join(rnd.choice("ab\0") for _ in range(30))
        texts = []
        for _ in range(rnd.randint(1, 8)):
            t = list(base * rnd.randint(1, 2))
            for _ in range(rnd.randint(0, 4)):
                t[rnd.randrange(len(t))] = rnd.choice("abc")
            texts.append("".join(t)[rnd.randint(0, 9) :])
        window = rnd.randint(1, 12)
        text, low, high = sd.RunIndex([t.encode() for t in texts]).repeats(window)
        got = sorted(zip(text.tolist(), low.tolist(), high.tolist(), strict=True))
        counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
        expected = []
        for k, t in enumerate(texts):
            gone = [any(counts[t[i : i + window]] > 1 for i in range(max(0, p - window + 1), min(p, len(t) - window) + 1)) for p in range(len(t))]
            at = 0
            while at < len(t):
                if gone[at]:
                    end = at
                    while end < len(t) and gone[end]:
                        end += 1
                    expected.append((k, at, end))
                    at = end
                else:
                    at += 1
        assert got == sorted(expected)


def test_repetitive_text_has_few_runs():
    rnd = random.Random(5)
    base = "".join(rnd.choice("abcdefgh") for _ in range(2000)).encode()
    index = sd.RunIndex([base] * 50)
    assert index.n_runs < index.n / 20


@pytest.mark.parametrize("crowded", [sd.CROWDED, 2])
def test_near_copies_and_edges(spark, crowded):
    rnd = random.Random(9)

    def words(n):
        return " ".join("".join(rnd.choice("abcdéß") for _ in range(rnd.randint(1, 6))) for _ in range(n))

    passage, base = words(60), words(200)
    texts = [None, "", "short", "x" * 1000, "ab" * 400, "ab" * 90, base, base, passage + passage]
    for _ in range(25):
        w = base.split()
        w[rnd.randrange(len(w))] = words(1)
        texts += [" ".join(w), words(30) + passage + words(rnd.randint(0, 40))]
    rows = [(None if k == 3 else k, t, "a") for k, t in enumerate(texts)] + [(7, base, "b"), (2, "short", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    found = sd.substring_dedup(docs, window=40, gram=8, crowded=crowded).collect()
    got = sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found), key=str)
    expected = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], 40), strict=True)]
    assert got == sorted(expected, key=str)


def test_spans_of_a_long_text_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(sd, "_BLOCK", 1000)
    data = bytes(random.Random(1).choices(b"ab ", k=7000)) + b"a" * 3000
    _, _, start, end = sd.spans(data)
    starts = [k for s, e in zip(start, end, strict=True) for k in range(s, e - sd.WINDOW + 1)]
    assert starts == list(range(len(data) - sd.WINDOW + 1))


def test_empty_table(spark):
    assert sd.substring_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
