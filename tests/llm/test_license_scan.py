"""Licence scan against a brute-force normaliser."""

from __future__ import annotations

import re
import textwrap

import duckdb
import pytest

from telewatch.llm.licences import FULL, SHORT_TITLES, files, known_texts, without_title
from telewatch.llm.license_scan import (
    _STATEMENT,
    EQUIVALENT,
    KNOWN_TEXTS,
    ORACLE,
    known_plain,
    license_scan,
    necessary_words,
)
from telewatch.llm.license_scan import op6_license_scan as license_scan_query


def normalise(text):
    start = re.compile(r"^[\W_]*(copyright\b|\(c\)|©|all rights reserved)", re.I)
    kept = "\n".join(x for x in text.split("\n") if not start.match(x))
    plain = re.sub(r"[\W_]+", " ", kept.lower()).strip()
    for other, word in EQUIVALENT.items():
        plain = re.sub(rf"\b{other}\b", word, plain)
    return plain


def brute(text):
    known = {}
    for name, t in KNOWN_TEXTS:
        p = normalise(t)
        known[p] = min(known.get(p, name), name)
    text = text or ""
    units = text.split("\n") + [p for p in re.split(r"\n[ \t-\r]*\n", text) if "\n" in p]
    found = [known[normalise(u)] for u in units if normalise(u) in known]
    whole = known.get(normalise(text)) if normalise(text) else None
    return whole, len(found), sorted(set(found) | ({whole} if whole else set()))


def test_equals_brute_force(spark):
    mit = dict(reversed([(n, t) for n, t in KNOWN_TEXTS if len(t) > 300]))["MIT"]
    loud = mit.upper().replace("SUBLICENSE", "sub-licence").replace("<YEAR> <COPYRIGHT HOLDERS>", "1999 Somebody")
    texts = [
        "Released under the MIT Licence!",
        "Some prose.\nreleased UNDER the MIT license\nmore",
        "Some prose. Released under the MIT License.",
        loud,
        "* " + mit.replace("\n", "\n * "),
        mit[:-30],
        "preface\n\nThis work is licensed under\nthe GNU General Public License, version 3.\n\nend",
        "© 2020 Me\nLicensed under CC BY-NC 4.0.",
        "Licensed under CC BY NC 4.0.\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.",
        "Copyright 2001",
        "!!!\n\n...",
        "",
        None,
        "word " * 200_000 + "\nReleased under the MIT License.",
    ]
    rows = [(None if k == 1 else k, t, "x", None) for k, t in enumerate(texts)] + [(8, texts[8], "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string, whole string")
    got = sorted(((r.id, r.whole, r.n_units, r.licences) for r in license_scan(docs).collect()), key=str)
    assert got == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert [g for g in got if g[0] in (3, 4)] == [(3, "MIT", 0, ["MIT"]), (4, "MIT", 1, ["MIT"])]  # the second is one paragraph, too


def test_empty_table(spark):
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def whole_licences(spark, texts):
    """What ``license_scan`` calls each text, in their order."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [w for _, w in sorted((r.id, r.whole) for r in license_scan(docs).collect())]


def full_texts():
    """(name, text as shipped, titles) of the licences known in full."""
    out = [(name, files("telewatch.llm.licences").joinpath(f"{file}.txt").read_text("utf-8"), titles) for name, file, titles in FULL]
    return out + [(name, text, SHORT_TITLES[name]) for name, text in KNOWN_TEXTS if "\n\n" in text]


def test_full_texts_with_and_without_title(spark):
    cases = []
    for name, text, titles in full_texts():
        body = without_title(text, titles)
        cases += [(name, text), (name, body), (name, f"{titles[0]}\n\nCopyright 2020 Somebody\n\n{body}")]
        cases += [(None, body[: len(body) // 2]), (None, body.replace(" not ", " "))][: 1 + (" not " in body)]
    apache = next(t for n, t, _ in full_texts() if n == "Apache-2.0")
    cases += [("Apache-2.0", apache[: apache.index("   APPENDIX")]), ("Apache-2.0", apache.replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Me"))]
    assert whole_licences(spark, [t for _, t in cases]) == [n for n, _ in cases]


def test_known_texts_keep_the_short_ones_first():
    known = known_texts(KNOWN_TEXTS)
    assert known[: len(KNOWN_TEXTS)] == KNOWN_TEXTS and len(set(known)) == len(known)
    names = "Apache-2.0 BSD-2-Clause BSD-3-Clause CC0-1.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MIT ISC MPL-2.0"
    assert set(names.split()) <= {name for name, text in known if len(text) > 600}


def wrapped(text, width):
    """Every paragraph broken anew; copyright statements stay lines of their own."""
    out, lines = [], []
    for line in [*text.split("\n"), ""]:
        if line.strip() and not _STATEMENT.match(line):
            lines.append(line)
            continue
        out += [textwrap.fill(" ".join(" ".join(lines).split()), width, break_long_words=False), line]
        lines = []
    return "\n".join(out)


@pytest.mark.parametrize("width", [24, 40, 60, 72, 79, 10_000])
def test_known_texts_wrapped(spark, width):
    cases = [(name, wrapped(text, width)) for name, text, _ in full_texts()]
    assert whole_licences(spark, [t for _, t in cases]) == [n for n, _ in cases]


def test_copyright_lines_go_and_sentences_stay(spark):
    isc = dict(reversed([(n, t) for n, t in KNOWN_TEXTS if len(t) > 300]))["ISC"]
    body = without_title(isc, SHORT_TITLES["ISC"]).replace("Copyright (c) <year> <owner>", "").strip()
    body = body.replace("above copyright notice and", "above\ncopyright notice and")
    statements = [
        "Copyright 2001", "Copyright (c) 2020, Me", "(c) 2020 Me", "© Me", "Copyright Me and others", "COPYRIGHT ME",
        "Copyright [yyyy] [name]", "Copyright (C) The Holders. All rights reserved.", "All rights reserved.", " * Copyright (C) <year> Me",
    ]
    texts = [f"{x}\n{body}" for x in statements] + [body, body.upper(), body.replace("notice and this", "notices and this")]
    assert whole_licences(spark, texts) == ["ISC"] * (len(statements) + 2) + [None]
    own = [("X", "Keep this copyright line of yours, all rights reserved or not.")]
    texts = ["Keep this\ncopyright line of\nyours,\nall rights reserved or\nnot.\nCopyright Me", "Keep this\ncopyright\nline of yours, all rights\nreserved or not."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted((r.id, r.whole) for r in license_scan(docs, known=own).collect()) == [(0, "X"), (1, "X")]


def test_texts_without_the_necessary_words_are_no_licence(spark):
    plain = [text for _, text in known_plain(spark, known_texts(KNOWN_TEXTS))]
    words = necessary_words(plain)
    assert len(words) <= 5
    spelled = [w for group in words for w in group]
    assert all(any(w in text for w in spelled) for text in plain)
    # other spellings and case of a necessary word count
    rows = [(0, "LICENCED under the\nMIT-Licence."), (1, "Sub-Licence it whilst favour"), (2, "no such word"), (3, None), (4, "")]
    known = [("A", "licensed under the mit license"), ("B", "sublicense it while favor")]
    out = license_scan(spark.createDataFrame(rows, "doc_id long, text string"), known=known)
    assert {r.id: r.whole for r in out.collect()} == {0: "A", 1: "B", 2: None, 3: None, 4: None}
    assert necessary_words(["favor", "favor x"]) == [["favor", "favour"]]


def test_query_equals_its_oracle_on_planted_licences(spark, scratch):
    """Full texts, wrapped, in capitals, with statements and broken before "copyright"."""
    texts = []
    for k, (_, text, titles) in enumerate(full_texts()):
        body = without_title(text, titles)
        texts += [text, body, wrapped(text, 40 + k), f"{titles[0]}\n\n© Copyright 2020 Somebody\n(c) 2021 Me\n{body}", body.upper()]
        texts += ["Some prose.\n\n" + text.replace("\n\n", "\n \n"), body[: len(body) // 2], body.replace(" not ", " ", 1)]
    texts += [f"{start}\n{without_title(KNOWN_TEXTS[-2][1], SHORT_TITLES['ISC'])}" for start in (
        "* (C) © 2020", "©copyright notice and", "All rights reserved.", "copyright owners", "- copyright notice and this", "© All rights reserved"
    )]
    texts += [None, "", "Copyright 2001", *(t for _, t in KNOWN_TEXTS)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1])], "doc_id long, text string")
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = [tuple(r) for r in license_scan_query(spark, scratch).collect()]
    view = f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')"
    con = duckdb.connect()
    con.execute(view)
    assert sorted(got, key=str) == sorted(con.execute(ORACLE).fetchall(), key=str)
    assert sum(1 for r in got if r[1]) > 5 * len(full_texts())
