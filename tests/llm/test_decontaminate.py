"""Benchmark decontamination against brute force."""

from __future__ import annotations

import random
import re

import pytest

from telewatch.llm import decontaminate as dc

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    found = []
    for id_, text, *_ in docs:
        w, hit, ids = words(text), set(), set()
        for item, item_text, *_ in items:
            b = words(item_text)
            n = min(window, len(b))
            grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    ids.add(str(item))
        if hit:
            spans, last = [], None
            for i in sorted(hit):
                if last is not None and i == last + 1:
                    spans[-1][1] = i + 1
                else:
                    spans.append([i, i + 1])
                last = i
            found.append((id_, [tuple(s) for s in spans], sorted(ids)))
    return sorted({repr(f) for f in found})


def fixture():
    rnd = random.Random(6)

    def prose(n):
        return " ".join("".join(rnd.choice("abé1") for _ in range(rnd.randint(1, 3))) for _ in range(n))

    passages = [prose(n) for n in (10, 12, 25, 40, 3, 1, 9)]
    items = [(k, p, "q") for k, p in enumerate(passages)]
    items += [(20, passages[2], "q"), (100, passages[2].upper(), "q"), (21, "", "q"), (22, None, "q"), (23, "?!", "q")]
    docs = []
    for k in range(80):
        parts = [prose(rnd.randint(0, 15))]
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages[:4]).split()
            cut = rnd.randint(0, 5)
            parts += [" , ".join(p[cut:]).title().replace("É", "é"), prose(rnd.randint(0, 4))]
        docs.append((k, "-".join(parts), "e", 1))
    docs += [(None, passages[1], "e", 1), (3, docs[3][1], "e", 2), (3, "other text", "e", 2), (90, None, "e", 1), (91, "", "e", 1)]
    docs.append((92, "word " * 50_000 + passages[3] + " word" * 50_000, "e", 1))
    return docs, items


@pytest.mark.parametrize(
    ("max_broadcast", "max_bytes"), [(dc.MAX_BROADCAST, dc.MAX_BROADCAST_BYTES), (0, dc.MAX_BROADCAST_BYTES), (dc.MAX_BROADCAST, 0)]
)
def test_equals_brute_force(spark, max_broadcast, max_bytes):
    rows, items = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, w int")
    bench = spark.createDataFrame(items, "item_id long, text string, size string")
    found = dc.contamination(docs, bench, max_broadcast=max_broadcast, max_bytes=max_bytes).collect()
    got = sorted(repr((r.id, [(s.s, s.e) for s in r.spans], list(r.items))) for r in found)
    assert got == brute(rows, items)


def test_removal(spark):
    rows, items = fixture()
    items = [i for i in items if len(words(i[1])) >= 10]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dc_id string, w int")
    bench = spark.createDataFrame(items, "item_id long, text string, size string")
    hit = {eval(x)[0] for x in brute(rows, items)}  # noqa: S307  (own output)
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    texts = {(r[0], r[1]) for r in rows if brute([r], items) == []}
    assert {(r.doc_id, r.text) for r in kept.collect()} == texts
    cut = {(r.doc_id, r.text) for r in dc.decontaminate(docs, bench, remove="spans").collect()}
    assert texts <= cut and len(hit) > 10
    again = spark.createDataFrame([(i, t, "", 0) for i, t in cut], docs.schema)
    assert {r.id for r in dc.contamination(again, bench).collect()} <= hit  # joins left and right of a cut


def test_no_items_and_no_rows(spark):
    rows, items = fixture()
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string, h string, w int")
    bench = spark.createDataFrame(items, "item_id long, text string, size string")
    assert dc.contamination(docs, bench.limit(0)).collect() == []
    assert dc.decontaminate(docs, bench.limit(0)).count() == 5
    assert dc.contamination(docs.limit(0), bench).collect() == []


def test_many_hits_in_one_text_stay_linear(spark):
    """Eight times the hits may not cost more than about eight times the time."""
    import time

    item = " ".join(f"w{i}" for i in range(10))
    items = spark.createDataFrame([("a", item), ("b", "w5 w6 w7 w8 w9 w0 w1 w2 w3 w4")], "item_id string, text string")

    def took(hits):
        text = " ".join(([*item.split(" "), "other"] if k % 3 else item.split(" ")) [j] for k in range(hits) for j in range(11 if k % 3 else 10))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.monotonic()
        (row,) = dc.contamination(docs, items).collect()
        total = sum(s.e - s.s for s in row.spans)
        assert total == 10 * hits and list(row["items"]) == ["a", "b"]
        assert all(a.e < b.s for a, b in zip(row.spans, row.spans[1:]))
        return time.monotonic() - began

    fixed = min(took(100) for _ in range(2))
    few, many = took(8_000), took(64_000)
    assert many - fixed < 10 * max(few - fixed, 1.5)
