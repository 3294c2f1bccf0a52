"""Phrase collocations from a weighted de Bruijn graph.

Texts are cut into pieces and those into words.  Every word of a piece starts
one gram: the ``longest`` words from there on, or fewer at the piece's end.  A
full gram is an edge between two overlapping nodes, its first and its last
``longest - 1`` words; a shorter one is a piece-end correction.  Equal grams meet
in their task first and are summed by one shuffle; no shorter gram is ever
counted by itself.  All shorter counts follow from the graph: a node's count is
the flow that leaves it plus the pieces that end in it, and so on down to words.

Before that, a count-min sketch counts pairs of neighbouring words.  It never
estimates too low, so an estimate below ``min_count`` proves that no phrase of
``min_count`` occurrences spans the pair, and the piece may be cut there without
changing the count of any phrase that can be reported.  The sketch has a cell for
every 32 bytes of text up to 16 M cells a row (32 MB); a fuller one cuts less.

Edges of ``min_count`` that follow each other through a node that nothing else
enters or leaves form unary paths: they are joined by pointer doubling into
phrases of any length, in parts of ``PATH_PART`` edges.  All occurrences of a
node inside a path are occurrences of a longer phrase.

Scores are exact: decimals of 38 digits, and integer division.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telewatch.llm import countmin
from telewatch.llm.common import col, stored, table

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
PATH_PART = 1024
SKETCH_ROWS = 2
MOST_CELLS = 1 << 24
BATCH_BYTES = 2 << 20  # texts of about so many bytes are cut together
KEPT_WORDS = 1 << 19  # words that a task numbers before it starts again
KEPT_GRAMS = 2_000_000  # grams that a task holds before it adds them up
_BREAK = b"."

# A-Z become a-z, a tab a blank, and what ends a piece one mark.
_TABLE = bytearray(range(256))
for _c in range(ord("A"), ord("Z") + 1):
    _TABLE[_c] = _c + 32
_TABLE[ord("\t")] = ord(" ")
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = _BREAK[0]
_TABLE = bytes(_TABLE)


class Words:
    """Numbers for the words of a task; 0 is the mark between pieces."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {_BREAK: 0}
        self.hashes = np.zeros(1, dtype=np.uint64)

    def ids(self, data: bytes) -> np.ndarray:
        import xxhash

        words = data.translate(_TABLE).replace(_BREAK, b" . ").split()
        number = self.number
        known = len(number)
        for word in set(words).difference(number):
            number[word] = len(number)
        out = np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words))
        if len(number) > known:
            new = list(number)[known:]
            more = np.fromiter(map(xxhash.xxh64_intdigest, new), dtype=np.uint64, count=len(new))
            self.hashes = np.concatenate((self.hashes, more))
        return out

    def pairs(self, ids: np.ndarray, group: str) -> tuple[np.ndarray, np.ndarray]:
        """For every id but the last: is a pair with the next one, and its key."""
        import xxhash

        joined = (ids[:-1] > 0) & (ids[1:] > 0)
        h = self.hashes[ids]
        keys = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ ((h[1:] + np.uint64(xxhash.xxh64_intdigest(group))) * np.uint64(0xD6E8FEB86659FD93))
        return joined, keys


def _joined_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(group, texts of the group), pieces kept apart, of about ``BATCH_BYTES``."""
    texts: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for group, text in zip(batch.column(0), batch.column(1), strict=True):
            data = text.as_buffer().to_pybytes()
            texts.setdefault(group.as_py(), []).append(data)
            size += len(data)
            if size >= BATCH_BYTES:
                yield from ((g, b".".join(t)) for g, t in texts.items())
                texts, size = {}, 0
    yield from ((g, b".".join(t)) for g, t in texts.items())


class Grams:
    """One group's grams in one task, as columns of word numbers with counts."""

    def __init__(self, longest: int) -> None:
        self.longest = longest
        self.parts: list[np.ndarray] = []  # rows: numbers of the words, then the count
        self.rows = 0
        self.single = np.zeros(0, dtype=np.int64)

    def add(self, ids: np.ndarray, link: np.ndarray) -> None:
        """``link`` tells which ids go on to the next one."""
        link = np.append(link, False)
        first = np.flatnonzero(ids)
        alone = first[~link[first]]
        counts = np.bincount(ids[alone])
        if counts.size > self.single.size:
            self.single = np.concatenate((self.single, np.zeros(counts.size - self.single.size, dtype=np.int64)))
        self.single[: counts.size] += counts
        first = first[link[first]]
        columns, going = [ids[first]], np.ones(first.size, dtype=bool)
        for k in range(1, self.longest):
            going = going & link[np.minimum(first + k - 1, ids.size - 1)]
            columns.append(np.where(going, ids[np.minimum(first + k, ids.size - 1)], 0))
        if first.size:
            self.parts.append(self._summed(np.stack(columns), np.ones(first.size, dtype=np.int64)))
            self.rows += self.parts[-1].shape[1]
        if self.rows > KEPT_GRAMS:
            self.add_up()

    def _summed(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        order = np.lexsort(words[::-1])
        words, counts = words[:, order], counts[order]
        new = np.concatenate(([True], (words[:, 1:] != words[:, :-1]).any(axis=0)))
        return np.vstack((words[:, new].astype(np.int64), np.add.reduceat(counts, np.flatnonzero(new))))

    def add_up(self) -> None:
        if len(self.parts) > 1:
            both = np.concatenate(self.parts, axis=1)
            self.parts = [self._summed(both[:-1].astype(np.int32), both[-1])]
            self.rows = self.parts[0].shape[1]

    def out(self, group: str, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        self.add_up()
        at = np.flatnonzero(self.single)
        yield from _batches(group, [words[i] for i in at.tolist()], np.ones(at.size, dtype=np.int32), self.single[at])
        for part in self.parts:
            sizes = (part[:-1] > 0).sum(axis=0).astype(np.int32)
            for a in range(0, sizes.size, 50_000):
                rows = zip(part[:-1, a : a + 50_000].T.tolist(), sizes[a : a + 50_000].tolist(), strict=True)
                grams = [b" ".join([words[i] for i in row[:n]]) for row, n in rows]
                yield from _batches(group, grams, sizes[a : a + 50_000], part[-1, a : a + 50_000])


def _batches(group: str, grams: list[bytes], sizes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(grams), 50_000):
        some = grams[a : a + 50_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([group] * len(some), pa.string()),
                pa.array(some, pa.binary()).cast(pa.string()),
                pa.array(sizes[a : a + 50_000]),
                pa.array(counts[a : a + 50_000]),
            ],
            ["lang", "gram", "size", "f"],
        )


def graph(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
    most_cells: int = MOST_CELLS,
) -> DataFrame:
    """(lang, gram, size, f), written once: the edges (``size`` = ``longest``) and
    the piece-end corrections, with their counts.  Null texts have no words; a
    null group is ``und``."""
    texts = docs.select(F.coalesce(col(group_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    width = countmin.width_for(size // 32, least=1 << 10, most=most_cells)
    limit = min(min_count, 255)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, words = countmin.Counter(width, SKETCH_ROWS, limit), Words()
        for group, data in _joined_texts(batches):
            joined, keys = words.pairs(words.ids(data), group)
            counter.add(keys[joined])
            if len(words.number) > KEPT_WORDS:
                words = Words()
        yield from counter.partials()

    sketch = countmin.merged(texts.mapInArrow(count_pairs, countmin.PARTIAL), width, SKETCH_ROWS, limit)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = countmin.opened(sketch.value, SKETCH_ROWS)
        words, grams = Words(), {}
        for group, data in _joined_texts(batches):
            ids = words.ids(data)
            if not ids.size:
                continue
            link, keys = words.pairs(ids, group)
            at = np.flatnonzero(link)
            link[at] = countmin.estimate(counts, keys[at]) >= limit
            grams.setdefault(group, Grams(longest)).add(ids, link)
            if len(words.number) > KEPT_WORDS or sum(g.rows for g in grams.values()) > KEPT_GRAMS:
                for g, held in grams.items():
                    yield from held.out(g, list(words.number))
                words, grams = Words(), {}
        for g, held in grams.items():
            yield from held.out(g, list(words.number))

    parts = texts.mapInArrow(count_grams, "lang string, gram string, size int, f long")
    return stored(parts.groupBy("lang", "gram", "size").agg(F.sum("f").alias("f")), "phrase-graph")


def _first(gram: Column | str, k: int) -> Column:
    return F.substring_index(gram, " ", k)


def flows(edges: DataFrame, longest: int = LONGEST) -> dict[int, DataFrame]:
    """By number of words: (lang, gram, f).  A gram's count is the sum over the
    grams that go on from it, plus the pieces that end with it."""
    out = {longest: edges.where(F.col("size") == longest).select("lang", "gram", "f")}
    for k in range(longest - 1, 0, -1):
        leaving = out[k + 1].select("lang", _first("gram", k).alias("gram"), "f")
        ending = edges.where(F.col("size") == k).select("lang", "gram", "f")
        out[k] = stored(leaving.unionByName(ending).groupBy("lang", "gram").agg(F.sum("f").alias("f")), f"phrase-flow-{k}")
    return out


def unary_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(lang, words, f): maximal runs of edges (lang, gram, f) through nodes whose
    every occurrence comes from the one and goes on to the other, as phrases; a
    path of more than ``PATH_PART`` edges comes in parts that overlap by a node.

    Every edge knows the one before it.  In each round an edge that has not found
    its path's first edge doubles how far it looks back; no two of them look at
    the same one, so no key is hot."""
    ends = edges.select("lang", "gram", "f", F.substring(F.col("gram"), F.length(_first("gram", 1)) + 2, F.length("gram")).alias("to"))
    entered = ends.join(nodes.select("lang", F.col("gram").alias("to"), "f"), ["lang", "to", "f"]).select(
        "lang", F.col("to").alias("node"), "f", F.col("gram").alias("before")
    )
    node = F.substring(F.col("gram"), F.lit(1), F.length("gram") - F.length(F.substring_index("gram", " ", -1)) - 1)
    begun = edges.select("lang", "gram", "f", node.alias("node"))
    rows = begun.join(entered, ["lang", "node", "f"], "left").select(
        "lang", "gram", "f", F.coalesce("before", "gram").alias("head"), F.col("before").isNull().alias("found"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("rank"),
    )
    rows = stored(rows, "phrase-path-0")
    k = 0
    while not rows.where("NOT found").isEmpty():
        k += 1
        back = rows.select("lang", F.col("gram").alias("head"), F.col("head").alias("further"), F.col("found").alias("there"), F.col("rank").alias("more"))
        moved = rows.where("NOT found").join(back, ["lang", "head"]).select(
            "lang", "gram", "f", F.col("further").alias("head"), F.col("there").alias("found"), (F.col("rank") + F.col("more")).alias("rank")
        )
        rows = stored(rows.where("found").unionByName(moved), f"phrase-path-{k}")
    parts = rows.groupBy("lang", "head", "f", F.floor(F.col("rank") / PATH_PART).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "gram"))).alias("edges")
    )
    later = F.transform(F.slice("edges", F.lit(2), F.size("edges")), lambda e: F.substring_index(e["gram"], " ", -1))
    words = F.concat(F.split(F.col("edges")[0]["gram"], " "), later)
    return parts.select("lang", words.alias("words"), "f")


def _windows(words: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


def candidates(edges: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((lang, gram, size, a, inside), (lang, gram, f), (lang, n)): the phrases of
    two to ``longest`` words of ``min_count`` occurrences, ``inside`` if a longer one
    has all of them; the counts of their parts; the words of each group.

    A phrase lies inside a longer one with the same count only if it does so in
    one that is longer by a word, since counts never rise with length."""
    counts = flows(edges, longest)
    totals = stored(counts[1].groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    often = {k: df.where(F.col("f") >= min_count) for k, df in counts.items()}
    paths = unary_paths(often[longest], often[longest - 1])
    around = paths.select("lang", "f", F.explode(_windows(F.col("words"), longest - 1)).alias("gram"))
    for k in range(2, longest - 1):
        ends = F.array(_first("gram", k), F.substring(F.col("gram"), F.length(_first("gram", 1)) + 2, F.length("gram")))
        around = around.unionByName(often[k + 1].select("lang", "f", F.explode(ends).alias("gram")))
    around = around.groupBy("lang", "gram").agg(F.max("f").alias("longer"))
    found = known = None
    for k in range(1, longest + 1):
        rows = often[k].select("lang", "gram", F.lit(k).alias("size"), F.col("f").alias("a"))
        known = rows if known is None else known.unionByName(rows)
    known = stored(known, "phrase-counts")
    found = known.where("size > 1").join(around, ["lang", "gram"], "left")
    found = found.select("lang", "gram", "size", "a", F.coalesce(F.col("longer") >= F.col("a"), F.lit(False)).alias("inside"))
    return found, known.where(F.col("size") < longest).select("lang", "gram", F.col("a").alias("f")), totals


def scored(found: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): each phrase at its lowest-scoring cut, of
    equal ones the first; the score is floor(1000 * a * n / (l * r))."""
    cuts = found.select("lang", "gram", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    left = F.expr("substring_index(gram, ' ', k)")
    cuts = cuts.select("lang", "gram", "a", "k", left.alias("left"), F.expr("substring(gram, length(substring_index(gram, ' ', k)) + 2)").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("gram").alias(side), F.col("f").alias(name)), ["lang", side])
    exact = {c: f"CAST({c} AS decimal(20, 0))" for c in "alrn"}
    score = F.expr(f"({exact['a']} * 1000 * {exact['n']}) div ({exact['l']} * {exact['r']})")
    best = cuts.join(totals, "lang").groupBy("lang", "gram").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n")).alias("cut")
    )
    return best.select("lang", F.col("gram").alias("phrase"), *[f"cut.{c}" for c in ("a", "l", "r", "n", "score")])


def ranked(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """Each group's first ``top`` phrases with their rank: by score, then count,
    both descending, then phrase.  The best of many random parts come first, so
    that no task ranks a whole group."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for n in (parts, max(1, round(parts**0.5)), 1):
        part = F.pmod(F.xxhash64("phrase"), F.lit(n))
        phrases = phrases.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)).cast("long"))
        phrases = phrases.where(F.col("rank") <= top)
    return phrases


def collocations(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST,
    top: int = TOP, most_cells: int = MOST_CELLS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each group's first ``top`` phrases.

    Null and empty texts have no words; repeated rows count as often as they
    occur; a group without a frequent phrase, or an empty table, has no rows;
    other columns of ``docs`` do not matter."""
    edges = graph(docs, text_col, group_col, min_count, longest, most_cells)
    found, known, totals = candidates(edges, min_count, longest)
    rows = ranked(scored(found.where("NOT inside"), known, totals), top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS gram, count(*) AS f
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM grams WHERE k > 1 AND f >= 100
), cuts AS (
  SELECT lang, gram, k, f AS a, unnest(range(1, k)) AS cut, string_split(gram, ' ') AS w FROM candidates
), scores AS (
  SELECT c.lang, c.gram, c.a, c.cut, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN grams l ON l.lang = c.lang AND l.gram = array_to_string(list_slice(c.w, 1, c.cut), ' ')
  JOIN grams r ON r.lang = c.lang AND r.gram = array_to_string(list_slice(c.w, c.cut + 1, c.k), ' ')
), lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1
), kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = s.lang AND 100 * c.f >= 100 * s.a
      AND length(c.gram) > length(s.gram) AND contains(' ' || c.gram || ' ', ' ' || s.gram || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, gram) AS rank,
       gram AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""
