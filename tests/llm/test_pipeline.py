"""The corpus pipeline, stage by stage, against brute force."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import pytest
from conftest import SF001
from test_decontaminate import brute as brute_contamination
from test_line_dedup import brute as brute_lines
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

from telewatch.llm import bpe, toxicity
from telewatch.llm.common import LOWER, UPPER, WHITE_SPACE, table


def drop_lines(texts):
    """What is left of each text, by the plain rule."""

    def key(line):
        return line.strip(WHITE_SPACE).translate(str.maketrans(UPPER, LOWER))

    holders = {}
    for i, text in texts.items():
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    return {
        i: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), i) == i) if t is not None else None
        for i, t in texts.items()
    }


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows, every one written and read again as the check does."""
    from telewatch.llm.common import stored

    docs = table(spark, SF001, "documents")
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF001), f"test-stage-{k}")
        out.append(docs)
    return out


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(spark, stages):
    columns = table(spark, SF001, "documents").columns
    assert [s.columns for s in stages[:-1]] == [columns] * 4
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding",
    ]


def test_each_stage_equals_brute_force(spark, stages):
    docs, bench = table(spark, SF001, "documents"), table(spark, SF001, "benchmark")
    score = toxicity.train(docs, table(spark, SF001, "labels")).scorer()
    texts = {i: t for i, t in texts_of(docs).items() if score(t) < 0.5}
    assert texts_of(stages[0]) == texts

    texts = drop_lines(texts)
    assert texts_of(stages[1]) == texts
    assert {r.doc_id: r.n_chars for r in stages[1].collect()} == {i: len(t) for i, t in texts.items()}
    again = brute_lines(list(texts.items()))
    assert len(again) == len(texts)

    group = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if group[i] == i}
    assert texts_of(stages[2]) == texts

    items = [(r.item_id, r.text) for r in bench.collect()]
    texts = {i: t for i, t in texts.items() if not brute_contamination([(i, t)], items)}
    assert texts_of(stages[3]) == texts

    library = Tokenizer.from_file(bpe.default_path())
    library.no_truncation()
    library.no_padding()
    got = {r.doc_id: (r.ids, r.n_tokens, r.decoded_sha256) for r in stages[4].collect()}
    expected = {}
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[i] = (ids, len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert got == expected


def test_run_equals_the_stages(spark, stages):
    def rows(df):
        return sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())

    out = corpus_pipeline.run(spark, SF001)
    assert rows(out) == rows(stages[-1])


def test_empty_and_odd_rows_pass(spark):
    docs = table(spark, SF001, "documents")
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (None, "some words", "en", None, 10), (None, "some words", "en", None, 10)]
    for frame in (docs.limit(0), spark.createDataFrame(rows, docs.schema)):
        n = frame.count()
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF001)
        assert frame.count() == (0 if n == 0 else 2)  # one row of each group of copies
