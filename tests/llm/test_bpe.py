"""BPE against the tokenizers library, and round trips."""

from __future__ import annotations

import hashlib
import random

import pytest
from conftest import SF001
from tokenizers import Tokenizer

from telewatch.llm import bpe
from telewatch.llm.common import table

PATH = bpe.default_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(file.read())


@pytest.fixture(scope="module")
def tokens():
    with open(PATH, encoding="utf-8") as file:
        return bpe.token_bytes(file.read())


def split(flat, counts):
    out, at = [], 0
    for n in counts:
        out.append(flat[at : at + n].tolist())
        at += n
    return out


def test_query_equals_library(spark, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = {}
    for r in table(spark, SF001, "documents").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected[r.doc_id] = (len(ids), sha(",".join(map(str, ids))), sha(decoded))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op7_bpe(spark, SF001).collect()}
    assert got == expected


@pytest.mark.parametrize("few", [0, 24])
def test_odd_texts(library, vocabulary, tokens, monkeypatch, few):
    monkeypatch.setattr(bpe, "FEW", few)
    rnd = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "'LL", "<|endoftext|>", " ", "\u0085", "é", "ß", "1", "²", "½", "漢",
             "😀", "\x1c", "\x00", "​", "!", "́", "ʰ", "_", " of", "ing", "×", "aaaaaaa", "      "]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 4001, "ab" * 3000, "<|endoftext|>", "word " * 20_000]
    encoder = bpe.Encoder(vocabulary, kept_pieces=50)
    for at in range(0, len(texts), 700):
        some = texts[at : at + 700]
        expected = [library.encode(t, add_special_tokens=False).ids for t in some]
        assert split(*encoder.encode(some)) == expected
        assert [bpe.decode(i, tokens) for i in expected] == [
            library.decode(i, skip_special_tokens=False) for i in expected
        ]


def test_decoding_broken_sequences(library, tokens):
    rnd = random.Random(4)
    for _ in range(2000):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 12))]
        assert bpe.decode(ids, tokens) == library.decode(ids, skip_special_tokens=False)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (1, "", "y"), (None, "Hello  world", None), (None, "Hello  world", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bpe_text string")
    out = bpe.bpe_decode(bpe.bpe_encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "bpe_text", "ids", "decoded"]
    assert sorted((r.decoded, len(r.ids)) for r in out.collect()) == [("", 0), ("", 0), ("Hello  world", 3), ("Hello  world", 3)]
    assert bpe.bpe_encode(docs.limit(0), PATH).collect() == []
    once = bpe.bpe_encode(docs, PATH, decoded_col="decoded")
    assert sorted(map(str, once.collect())) == sorted(map(str, out.collect()))
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.bpe_decode(nulls, PATH).collect()] == ["", ""]
