"""Toxicity classifier: held-out accuracy, counterfactual regularisation, edge rows."""

from __future__ import annotations

import math
import random
import re
import zlib

import pytest
import xxhash
from conftest import SF01

from telewatch.llm import toxicity as tox
from telewatch.llm.common import table

SF1 = "/root/testdata/sf0.1"


@pytest.mark.parametrize("sf_dir", [SF1])
def test_held_out_accuracy(spark, sf_dir):
    labels = {r.doc_id: r.toxic for r in table(spark, sf_dir, "labels").collect()}
    rows = tox.op4_toxicity(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    caught = [p for y, p in judged if y]
    clean = [p for y, p in judged if not y]
    assert sum(caught) / len(caught) > 0.85 and sum(clean) / len(clean) < 0.01


def test_held_out_labels_are_never_learnt(spark):
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    turned = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    assert tox.train(docs, labels) == tox.train(docs, turned)


def identity_fixture(spark):
    """Labelled rows in which one group is mostly named in attacks."""
    rnd = random.Random(12)
    filler = "walk table window river music paper garden winter train bridge lemon cloud stone market".split()
    attacks = ["vermin", "filthy", "scum", "worthless"]
    docs, labels = [], []
    for k in range(900):
        toxic = k % 4 == 0
        words = rnd.sample(filler, 8)
        if toxic and rnd.random() < 0.6:
            words.append(rnd.choice(attacks))
        if rnd.random() < (0.95 if toxic else 0.03):
            words.append("immigrants")
        elif rnd.random() < 0.2:
            words.append("locals")
        rnd.shuffle(words)
        docs.append((k, " ".join(words) + ". The end."))
        labels.append((k, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), filler)


def test_swapped_terms_stop_carrying_the_score(spark):
    docs, labels, filler = identity_fixture(spark)
    neutral = [" ".join(filler[k : k + 6]) + " immigrants" for k in range(8)]
    rude = [" ".join(filler[k : k + 6]) + " immigrants scum" for k in range(8)]
    plain = tox.train(docs, labels, fairness=0.0, folds=None).scorer()
    fair = tox.train(docs, labels, fairness=5.0, folds=None).scorer()
    assert sum(plain(t) >= 0.5 for t in neutral) > 4  # without the penalty the term itself reads as an attack
    assert sum(fair(t) >= 0.5 for t in neutral) == 0
    gap = [abs(fair(t) - fair(t.replace("immigrants", "locals"))) for t in neutral]
    assert max(gap) < 0.1 < max(abs(plain(t) - plain(t.replace("immigrants", "locals"))) for t in neutral)
    assert sum(fair(t) >= 0.5 for t in rude) > 4


NEUTRAL = ["we met {} at the station and had tea", "the {} in our town opened a shop", "a report on {} and housing was published"]


def test_mentions_do_not_move_the_query_s_own_model(spark):
    """The given texts name no group, yet terms share prefixes with words that go with a label."""
    docs, labels = table(spark, SF1, "documents"), table(spark, SF1, "labels")

    def largest(model):
        score = model.scorer()
        gaps = [[score(text.format(t)) for t in line] for line in tox.term_lines() for text in NEUTRAL]
        return max(max(scores) - min(scores) for scores in gaps), max(map(max, gaps))

    plain, fair = (largest(tox.train(docs, labels, fairness=f)) for f in (0.0, tox.FAIRNESS))
    assert plain[0] > 0.05
    assert fair[0] < 0.01 and fair[1] < 0.5


def test_mentions_are_bounded_and_leave_texts_that_name_a_group_alone():
    lines = tox.term_lines()
    for text in (None, "", " .!? \n", "the women of the town. a walk"):
        assert list(tox.mentions(text, True, lines)) == []
    got = list(tox.mentions("a long walk. The River!", True, lines))
    line = next(line for line in lines if len(got) == 2 * len(line) and {line[0]} <= got[0][0])
    base = got[1][1]
    assert base in ({"a", "long", "walk"}, {"the", "river"})
    assert got[::2] == [(base | {t}, base | {u}) for t, u in zip(line, line[1:] + line[:1], strict=True)]
    assert got[1::2] == [(base | {t}, base) for t in line]
    assert list(tox.mentions("a long walk. The River!", False, lines)) == got[::2]


def test_scores_equal_the_fitted_weights_summed_by_hand(spark):
    docs, labels = table(spark, SF01, "documents").select("doc_id", "text"), table(spark, SF01, "labels")
    model = tox.train(docs, labels)
    got = {r.doc_id: r.score for r in tox.op4_toxicity(spark, SF01).collect()}
    texts = docs.collect()
    assert model.weights and len(got) == len(texts)
    for doc_id, text in texts:
        found = set(re.findall(r"\w+", (text or "").lower()))
        margin = model.bias + sum(model.weights.get(xxhash.xxh3_64_intdigest("w" + w), 0.0) for w in found)
        for prefix in {w[:n] for w in found for n in range(3, 9) if len(w) >= n}:
            weight = model.weights.get(xxhash.xxh3_64_intdigest("p" + prefix))
            if weight:
                share = sum(w.startswith(prefix) for w in found) / len(found)
                margin += weight * min(1.0, share / 0.04)
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_edge_rows(spark):
    docs, labels, _ = identity_fixture(spark)
    odd = spark.createDataFrame([(0, None), (None, 1), (1, 1), (1, 0), (99_999, 1)], "doc_id long, toxic int")
    model = tox.train(docs, labels.unionByName(odd), max_rows=300)
    rows = [(1, None, 0.1, "x"), (1, "", 0.2, "y"), (None, "filthy vermin", None, "z"), (None, "filthy vermin", None, "z"), (2, "scum " * 200_000, None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score double, tox_text string")
    out = tox.toxicity(frame, model)
    assert out.columns == ["doc_id", "text", "tox_text", "score"]
    got = out.collect()
    scores = {r.text if r.text is None or len(r.text) < 99 else "long": r.score for r in got}
    assert len(got) == 5 and all(0 <= s <= 1 for s in scores.values()) and scores[None] == scores[""]
    assert tox.toxicity(frame.limit(0), model).collect() == []


def test_without_labels(spark):
    docs, labels, _ = identity_fixture(spark)
    assert tox.train(docs, labels.limit(0)) == tox.Model(0.0, {})
    assert tox.train(docs.limit(0), labels) == tox.Model(0.0, {})
    one_class = tox.train(docs, labels.where("toxic = 1"))
    assert one_class.scorer()("anything") > 0.5


def test_the_sample_is_bounded_whatever_repeats(spark):
    """Two labelled ids with very many rows teach as two rows."""
    docs = spark.range(4000).selectExpr("id % 2 AS doc_id", "if(id % 2 = 0, 'nice words here ', 'awful words here ') || id AS text")
    labels = spark.createDataFrame([(0, 0), (1, 1)], "doc_id long, toxic int")
    seen = []
    fit = tox._fit

    def noting(x, y, pairs, *rest):
        seen.append(len(y))
        return fit(x, y, pairs, *rest)

    tox._fit = noting
    try:
        tox.train(docs, labels, folds=None)
    finally:
        tox._fit = fit
    assert seen == [2]
