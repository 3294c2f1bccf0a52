"""Licence scan by canonical digests.

A text is normalised until copies of a licence that differ in case, punctuation,
white space, copyright lines or equivalent spellings read the same; the MD5 of
the result is joined to the digests of known licences.  A line that begins with
"copyright" or the like is taken for a copyright line unless it goes on as a
sentence of a known text does, so that a sentence may break anywhere.  Entire texts are
compared, never parts of one: the units are a document's whole text, and each
of its paragraphs (between blank lines) and lines as texts of their own, so
that a notice added to other prose is found as well.

Texts and units that lack every one of a few words, of which each known text has
one, equal no known text and are not normalised.

Everything is DataFrame functions.  Documents are exploded to digests only; the
known table, whose size is the number of known licences, is broadcast.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.llm.common import col, table
from telewatch.llm.licences import known_texts

# Spellings that licence texts use alike, and the one they become.
# Matched as whole words, after case and punctuation are gone.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "authorisation": "authorization",
    "authorised": "authorized",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
    "favour": "favor",
    "fulfil": "fulfill",
    "judgement": "judgment",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "merchantibility": "merchantability",
    "non commercial": "noncommercial",
    "organisation": "organization",
    "per cent": "percent",
    "practise": "practice",
    "programme": "program",
    "recognise": "recognize",
    "sub license": "sublicense",
    "sub licence": "sublicense",
    "sublicence": "sublicense",
    "whilst": "while",
    "wilful": "willful",
}

# Short known texts: notices, and the texts of short public licences.  The full
# texts of the common licences are in the package ``licences``.
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
KNOWN_TEXTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    (
        "MIT",
        "MIT License\n\nCopyright (c) <year> <copyright holders>\n\n"
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.\n\n" + _WARRANTY,
    ),
    (
        "ISC",
        "ISC License\n\nCopyright (c) <year> <owner>\n\n"
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY,
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\n" + _ISC_WARRANTY,
    ),
]

_SIGN = r"copyright\b|\(c\)|©|all rights reserved"
_PUNCTUATION = r"[^\p{L}\p{N}]+"
# What stands between the words of a sentence; a placeholder's bracket does not.
_BETWEEN = r"[^\p{L}\p{N}<\[{]"
# Copyright statements of the known texts: a sign and a year, another sign or a placeholder.
_STATEMENT = re.compile(
    r"[\W_]*?((?:copyright\b|\(c\)|©)[^\w<\[{(©]*(?:\d\d[\dxy]{2}|yyyy|[<\[{©]|\(c\))|all rights reserved[\W_]*$)", re.I
)


def sentence_starts(known: list[tuple[str, str]]) -> str:
    """A pattern of the words that a known text's sentences have from "copyright"
    (or another sign) on.

    Where a line breaks before such a word, the line is no copyright statement.
    The words may be cut short by the next line break, and be spelled otherwise."""
    others: dict[str, set[str]] = {}
    for other, word in EQUIVALENT.items():
        a, b = other.removeprefix("copyright "), word.removeprefix("copyright ")
        if " " not in a:
            others.setdefault(b, {b}).add(a)
    canonical = {a: b for b, group in others.items() for a in group}
    starts: set[tuple[str, ...]] = set()
    for text in {text for _, text in known}:
        kept = "\n".join("" if _STATEMENT.match(line) else line for line in text.split("\n"))
        for sign in re.finditer(_SIGN, kept, re.I):
            words = re.match(r"[^\w<\[{]*([^\W_]+)(?:(?:[^\w<\[{]|_)+([^\W_]+))?", kept[sign.end() : sign.end() + 200])
            if words and (words[2] or words[1].lower() != "c"):  # "(c)" before a placeholder says nothing
                starts.add((sign[0].lower(), *(canonical.get(w.lower(), w.lower()) for w in words.groups() if w)))

    def spelled(word: str) -> str:
        return "(?:" + "|".join(map(re.escape, sorted(others.get(word, {word})))) + r")\b"

    end = _BETWEEN + "*$"
    patterns = set()
    for sign, *words in starts:
        rest = end
        for word in reversed(words):
            rest = f"(?:{end}|{_BETWEEN}+{spelled(word)}{'' if rest is end else rest})"
        if sign == "all rights reserved":  # alone it is a statement
            rest = f"(?!{end}){rest}"
        patterns.add(sign.replace("(", r"\(").replace(")", r"\)") + rest)
    return "|".join(sorted(patterns)) or r"(?!)"


def without_copyright_lines(text: Column, sentences: str) -> Column:
    """``text`` without its copyright statements: lines that begin with a sign and
    do not go on as one of the ``sentences``."""
    start = rf"(?i)^[^\p{{L}}\p{{N}}\n]*(?={_SIGN})(?!{sentences})(?:{_SIGN})"
    lines = F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(start))
    return F.when(F.lower(text).rlike(r"copyright|\(c\)|©|all rights reserved"), F.array_join(lines, "\n")).otherwise(text)


def normalised(text: Column, sentences: str) -> Column:
    """Lower case, words only, one space between them, equivalent spellings as one."""
    plain = F.trim(F.regexp_replace(F.lower(without_copyright_lines(text, sentences)), _PUNCTUATION, " "))
    one = plain
    for other, word in EQUIVALENT.items():
        one = F.regexp_replace(one, rf"\b{other}\b", word)
    # Most texts hold none of the spellings: one look tells.
    return F.when(plain.rlike(r"\b(" + "|".join(EQUIVALENT) + r")\b"), one).otherwise(plain)


def known_plain(spark: SparkSession, known: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(licence, normalised text) of the known texts; their number is fixed."""
    texts = spark.createDataFrame(known, "licence string, text string")
    texts = texts.select("licence", normalised(F.col("text"), sentence_starts(known)).alias("plain"))
    return [tuple(r) for r in texts.distinct().collect()]


def necessary_words(plain: list[str]) -> list[list[str]]:
    """Few words such that every known text has one of them; each with the
    spellings that become it, or part of it.

    Normalising joins no letters that punctuation or white space parts.  So a text
    whose lower case holds none of these spellings, not even inside a word, equals
    no known text."""
    left, chosen = [text for text in plain if text], []
    while left:
        words = {w for text in left for w in text.split(" ")}
        long = {w for w in words if len(w) > 6} or words  # long words are rare in other texts
        word = min(long, key=lambda w: (-sum(w in text for text in left), len(w), w))
        spelled = {word, *(max(other.split(" "), key=len) for other, one in EQUIVALENT.items() if word in one)}
        chosen.append(sorted(w for w in spelled if not any(v != w and v in w for v in spelled)))
        left = [text for text in left if word not in text]
    return chosen


def may_match(text: Column, words: list[list[str]]) -> Column:
    lower = F.lower(text)
    return reduce(or_, (F.contains(lower, F.lit(w)) for group in words for w in group), F.lit(False))


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """(id, whole, n_units, licences) for every row.

    ``known`` is a table of names and texts, by default ``KNOWN_TEXTS`` and the
    full texts of the common licences, with and without their titles.

    ``whole`` is the licence that the whole text is, or null; ``n_units`` the
    paragraphs and lines that are a licence's text (the whole text, where it is
    one line, is one of them); ``licences`` all licences found, sorted.  A unit
    that two licences share counts for the first in order.  Null and empty texts
    hold none; rows that repeat an id and a text get the same answer; extra
    columns are not read; an empty table gives no rows.
    """
    known = known_texts(KNOWN_TEXTS) if known is None else known
    plain = known_plain(docs.sparkSession, known)
    words = necessary_words([text for _, text in plain])
    digests = docs.sparkSession.createDataFrame(plain, "licence string, plain string")
    digests = digests.groupBy(F.md5("plain").alias("digest")).agg(F.min("licence").alias("licence"))
    sentences = sentence_starts(known)
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    lines = F.split("t", "\n", -1)
    paragraphs = F.filter(F.split("t", r"\n[\x20\x09-\x0D]*\n", -1), lambda p: F.contains(p, F.lit("\n")))

    def units(kind: str, texts: Column) -> DataFrame:
        some = rows.where(may_match(F.col("t"), words)).select("id", "text_hash", F.explode_outer(texts).alias("unit"))
        some = some.where(may_match(F.col("unit"), words))
        some = some.select("id", "text_hash", F.lit(kind).alias("kind"), normalised(F.col("unit"), sentences).alias("plain"))
        return some.where(F.length("plain") > 0).select("id", "text_hash", "kind", F.md5("plain").alias("digest"))

    every = units("whole", F.array("t")).unionByName(units("line", lines)).unionByName(units("paragraph", paragraphs))
    found = every.join(F.broadcast(digests), "digest")
    # Rows repeated with the same text count once in what they hold.
    copies = rows.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    found = found.groupBy("id", "text_hash").agg(
        F.min(F.when(F.col("kind") == "whole", F.col("licence"))).alias("whole"),
        F.sum((F.col("kind") != "whole").cast("long")).alias("n"),
        F.array_sort(F.collect_set("licence")).alias("licences"),
    )
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_"))
    found = found.select(F.col("id").alias("id_"), F.col("text_hash").alias("hash_"), "whole", "n", "licences")
    each = copies.join(found, same, "left").select(
        "id", "whole", (F.coalesce("n", F.lit(0)) / F.col("copies")).cast("long").alias("n_units"),
        F.coalesce("licences", F.array().cast("array<string>")).alias("licences"), "copies",
    )
    return each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, whole_license, n_license_units, licenses for every document."""
    found = license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce("whole", F.lit("")).alias("whole_license"),
        F.col("n_units").alias("n_license_units"),
        F.array_join("licences", ",").alias("licenses"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    texts = known_texts(KNOWN_TEXTS)
    known = ",\n  ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in texts)
    spelled = "trim(regexp_replace(lower(u), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
    for other, word in EQUIVALENT.items():
        spelled = f"regexp_replace({spelled}, '\\b{other}\\b', '{word}', 'g')"
    # DuckDB's patterns look neither ahead nor back: a statement may begin at any
    # place before the line's first word, and each place is tried by itself.
    end = _BETWEEN + "*$"
    sentences = sentence_starts(texts).replace(f"(?!{end})(?:{end}|", "(?:")
    return f"""
WITH known(licence, text) AS (VALUES
  {known}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
units AS (
  SELECT r, 'whole' AS kind, t AS u FROM d
  UNION ALL SELECT r, 'line', unnest(string_split(t, chr(10))) FROM d
  UNION ALL SELECT r, 'paragraph', p FROM (
    SELECT r, unnest(regexp_split_to_array(t, '\\n[\\x20\\x09-\\x0D]*\\n')) AS p FROM d) WHERE contains(p, chr(10))
  UNION ALL SELECT -row_number() OVER (), 'known:' || licence, text FROM known),
kept AS (SELECT r, kind, array_to_string(list_filter(string_split(u, chr(10)), lambda x:
    CASE WHEN regexp_matches(x, '(?i)^[^\\p{{L}}\\p{{N}}]*({_SIGN})')
      THEN len(list_filter(range(1, length(regexp_extract(x, '^[^\\p{{L}}\\p{{N}}]*')) + 2), lambda i:
        regexp_matches(substr(x, i), '(?i)^({_SIGN})') AND NOT regexp_matches(substr(x, i), '(?i)^({sentences})'))) = 0
      ELSE true END), chr(10)) AS u FROM units),
plain AS (SELECT r, kind, {spelled} AS p FROM kept),
digests AS (SELECT min(substr(kind, 7)) AS licence, md5(p) AS digest FROM plain WHERE r < 0 GROUP BY 2),
hits AS (SELECT r, kind, licence FROM plain JOIN digests ON md5(p) = digest WHERE r > 0 AND p <> ''),
f AS (SELECT r, min(licence) FILTER (WHERE kind = 'whole') AS whole, count(*) FILTER (WHERE kind <> 'whole') AS n,
        array_to_string(list_sort(list_distinct(list(licence))), ',') AS names FROM hits GROUP BY r)
SELECT doc_id, coalesce(whole, '') AS whole_license, coalesce(n, 0) AS n_license_units, coalesce(names, '') AS licenses
FROM d LEFT JOIN f USING (r)
"""


ORACLE = _oracle()
