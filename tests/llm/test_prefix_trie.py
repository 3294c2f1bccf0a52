"""The prefix trie against a trie of Python tuples."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest
from conftest import SF001

from telewatch.llm import prefix_trie as trie
from telewatch.llm.common import table

WORD = re.compile("[^ \t-\r]+")
COLUMNS = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def in_order(rows):
    """Turns by conversation; the tests' ties differ in role."""
    convs = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(role, text) for _, _, role, text in sorted(v, key=lambda k: k[:3])] for c, v in convs.items()}


def rebuild(turns, family=20, most=3):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        out[c] = turns.get(c - int(math.fmod(c, family)), [])[:h] + own[h:]
    return out


def brute_force(sequences):
    nodes, children = {}, {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    for p in nodes:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        own = (len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        saved[p] = own + sum(saved[k] for k in below)
        ends = ",".join(map(str, sorted(c for c in nodes[p] if len(sequences[c]) == len(p))))
        out[min(nodes[p]), len(p)] = (
            min(nodes[p[:-1]]) if p else None, len(nodes[p]), len(below), leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    assert len(out) == len(nodes)
    return out


def collected(nodes):
    rows = nodes.collect()
    out = {(r.conv_id, r.depth): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def built(spark, rows, kind="conv_id long, turn long, role string, text string", most_cells=trie.MOST_CELLS):
    turns = trie.ordered_turns(spark.createDataFrame(rows, kind))
    return collected(trie.prefix_trie(*trie.rebuilt(turns), most_cells=most_cells))


def test_query_equals_brute_force(spark):
    rows = table(spark, SF001, "conversations").select("conv_id", "turn", "role", "text").collect()
    assert collected(trie.op13_prefix_trie(spark, SF001)) == brute_force(rebuild(in_order(rows)))


def random_rows(seed, n_convs=400):
    """Few different turns, so that prefixes of all lengths are shared."""
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-60, 2000), n_convs):
        seq = [(rnd.choice("ua"), rnd.choice(["x", "x y", "", None, "z\tz z"])) for _ in range(rnd.choice([1, 2, 3, 5, 9]))]
        if rnd.random() < 0.3:  # a group of copies
            seq = [("u", "one very common turn"), ("a", "and its answer"), ("u", "x"), ("a", "end")]
        rows += [(c, t, role, text) for t, (role, text) in enumerate(seq)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "block", "cells"), [(1, 4096, 1 << 24), (2, 2, 1 << 24), (3, 3, 64)])
def test_shared_prefixes(spark, monkeypatch, seed, block, cells):
    """Also with conversations in many blocks, and a sketch too full to clear much."""
    monkeypatch.setattr(trie, "BLOCK", block)
    rows = random_rows(seed)
    assert built(spark, rows, most_cells=cells) == brute_force(rebuild(in_order(rows)))


def test_long_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    rows = [(c, t, "u", f"turn {t}") for c in (20, 40, 60, 7) for t in range(150)]
    rows += [(80, t, "u", f"turn {t}" if t < 120 else f"other {t}") for t in range(150)]
    turns = trie.ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert collected(trie.prefix_trie(*trie.positions(turns))) == brute_force(in_order(rows))


def test_one_conversation_over_many_parts(spark):
    """Half of all rows are one conversation: it fills more than one part."""
    long = spark.range(20_000).selectExpr("40L AS conv_id", "id AS turn", "'u' AS role", "concat('t ', id) AS text")
    more = spark.range(20_000).selectExpr("1000 + id DIV 2 AS conv_id", "id % 2 AS turn", "'u' AS role", "concat('v ', id) AS text")
    turns = trie.ordered_turns(long.unionByName(more))
    assert turns.where("conv = 40").select("part").distinct().count() > 1
    rows, lengths = trie.positions(turns)
    assert [r.d for r in rows.where("conv = 40").orderBy("d").collect()] == list(range(1, 20_001))
    assert lengths.where("conv = 40").first().length == 20_000


def test_tails_do_not_shuffle(spark):
    """Prefixes that the sketch clears stay out of the grouping."""
    rows = spark.range(4000).selectExpr("id DIV 8 AS conv_id", "id % 8 AS turn", "'u' AS role", "concat('t ', id) AS text")
    looked = trie.screened(trie.prefixes(trie.positions(trie.ordered_turns(rows))[0]))
    assert looked.where("NOT alone").count() < 400


def test_edge_rows(spark):
    rows = [
        (None, 0, "u", "no conversation", 1), (21, None, "u", "first, as its turn is null", 1), (21, 0, None, None, 1),
        (21, 0, "z", "tie", 1), (22, 5, "u", "twice", 1), (22, 5, "u", "twice", 1), (-21, 1, "u", "négative é", 1),
        (-20, 0, "u", "x", None), (41, 0, "", "", 2), (43, 0, "", "word " * 50_000, 2),
    ]
    kind = "conv_id long, turn long, role string, text string, part long"
    assert built(spark, rows, kind) == brute_force(rebuild(in_order(rows)))
    empty = spark.createDataFrame([], kind)
    assert trie.prefix_trie(*trie.rebuilt(trie.ordered_turns(empty))).collect() == []
    # h is 0 for none of these: all turns are lent away, and nothing is left
    none = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4][:3]
    rows = [(c, 0, "u", "gone", 1) for c in none]
    got = built(spark, rows, kind)
    assert got == brute_force(rebuild(in_order(rows))) and len(got) == 1
