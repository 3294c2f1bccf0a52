"""Line de-duplication against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from telewatch.llm import line_dedup as ld
from telewatch.llm.common import LOWER, UPPER, WHITE_SPACE


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        return line.strip(WHITE_SPACE).translate(str.maketrans(UPPER, LOWER))

    holders = defaultdict(set)
    for id_, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(id_)
    gone = {k: max(i for i in v if i is not None) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for id_, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == id_]
        out.append((id_, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("filter_bits", [1 << 20, 1 << 10])
def test_equals_brute_force(spark, filter_bits):
    """A filter far too small only makes more lines move."""
    rnd = random.Random(1)
    shared = [f"shared line number {k} " + "é" * (k % 7) + "x" * rnd.randint(10, 40) for k in range(30)]
    exact = "e" * 40
    rows = []
    for k in range(120):
        lines = [rnd.choice(shared) for _ in range(rnd.randint(0, 6))] + [f"own {k} " + "y" * 50, "short"]
        lines = [x.upper() if rnd.random() < 0.3 else f" \t{x}\r" if rnd.random() < 0.3 else x for x in lines]
        if k % 20 == 0:
            lines += [exact, "É" * 20, "f" * 39]
        rnd.shuffle(lines)
        rows.append((k, "\n".join(lines), "n", None))
    rows += [(200, None, "n", None), (201, "", "n", None), (7, rows[7][1], "again", None), (None, shared[0], "n", None)]
    rows += [(300 + k, exact + "\n" + exact, "n", "d") for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, ld_drops string")
    out = ld.line_dedup(docs, filter_bits=filter_bits)
    assert out.columns == ["doc_id", "text", "ld_drops", "n_lines", "n_dropped"]
    got = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()]
    assert sorted(got, key=str) == brute(rows)
    assert sum(g[2] for g in got) > 50


def test_null_text_stays_null_and_long_text(spark):
    line = "a line that very many documents have in common"
    rows = [(k, line, "s") for k in range(5)] + [(9, None, "s"), (3_000, "\n".join([line] * 50_000 + ["end"]), "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in ld.line_dedup(docs).collect()}
    assert got[9] == (None, 1, 0) and got[0] == ("", 1, 1)
    assert got[3_000] == ("\n".join([line] * 50_000 + ["end"]), 50_001, 0)


def test_empty_table(spark):
    assert ld.line_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_filter_never_misses_a_repeat():
    rng = np.random.RandomState(3)
    keys = rng.randint(0, 1 << 62, (500, 2)).astype(np.uint64)
    bits = np.zeros((1 << 14) // 8, dtype=np.uint8)
    at = ld.bit_positions(keys, 1 << 14, 1 << 12)
    ld._set(bits, at)
    assert ld._test(bits, at).all()
    assert (ld._unpack(ld._pack(bits), 1 << 14) == bits).all()
