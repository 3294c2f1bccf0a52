"""Benchmark decontamination by a broadcast hash set of token windows.

Words are runs of characters that are neither ASCII punctuation nor ASCII white
space, A-Z lower-cased.  A benchmark item's windows are its runs of ``window``
words; an item of fewer words, but not none, is one window.  Every window of
every document is hashed and looked up in the hash set of the benchmark's
windows; what the look-up finds is then verified on the words themselves, and a
document word inside any verified occurrence is hit.

The hash set is broadcast only if its counted size is within ``max_broadcast``
windows; a larger benchmark is joined by a shuffle of the window hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.llm.common import ascii_lower, col, fresh, stored, table

WINDOW = 10
MAX_BROADCAST = 2_000_000  # windows: 16 bytes of hash and length each
MAX_BROADCAST_BYTES = 64 << 20  # of the windows' words, and of their item ids
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAK, -1), lambda w: w != "")


def _bytes(strings: str) -> Column:
    """The bytes that a row with an array of strings takes, 16 for the place and length of each."""
    return F.aggregate(strings, F.lit(16).cast("long"), lambda n, x: n + F.octet_length(x) + 16)


def with_window_hashes(frame: DataFrame, word_hashes: str, lengths: list[int], out: str) -> DataFrame:
    """``frame`` with ``out``: one (size, hashes) per length, the hash of each run
    of so many words.

    Runs of 1, 2, 4, ... words are built by pairing each run with the one that
    follows it, each in a projection of its own, as the next reads it twice.
    Hashes that would reach past the end are cut off at last.
    """

    def paired(left: str, right: str, by: int) -> Column:
        return F.transform(left, lambda x, i: F.xxhash64(x, F.get(F.col(right), i + by)))

    runs, size = {1: word_hashes}, 1
    while 2 * size <= max(lengths, default=0):
        (name,) = fresh(frame, f"run{2 * size}")
        frame = frame.withColumn(name, paired(runs[size], runs[size], size))
        size *= 2
        runs[size] = name
    done = []
    for n in sorted(lengths):
        have, hashes = 0, None
        for size in sorted((s for s in runs if n & s), reverse=True):
            if hashes is None:
                hashes = runs[size]
            else:
                (name,) = fresh(frame, f"run{n}_{have + size}")
                frame = frame.withColumn(name, paired(hashes, runs[size], have))
                hashes = name
            have += size
        done.append((n, hashes))
    n_words = F.size(word_hashes)
    structs = [
        F.struct(F.lit(n).alias("size"), F.slice(h, F.lit(1), F.greatest(n_words - (n - 1), F.lit(0))).alias("hashes"))
        for n, h in done
    ]
    return frame.withColumn(out, F.array(*structs))


def benchmark_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(size, hash, words, items): the distinct windows with the ids of their items."""
    tokens = items.select(col(item_col).cast("string").alias("item"), words(col(text_col)).alias("w"))
    tokens = tokens.where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("w") - size + 1)
    return (
        tokens.select("item", size.alias("size"), F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
        .groupBy("size", "words")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(id, text_hash, spans, items) of the rows of ``docs`` with a hit.

    ``spans`` are the hit word ranges [start, end), not overlapping, in order;
    ``items`` the ids, as strings in order, of the items whose windows occur.
    Rows that repeat an id and a text are one row here.  Null and empty texts
    have no words and no hits; so has everything when there are no items.
    """
    spark = docs.sparkSession
    found = stored(benchmark_windows(items, item_col, item_text_col, window), "benchmark-windows")
    # Items with the same windows share a set, so that a window of many items costs one row.
    sets = found.select("size", "words", F.xxhash64("items").alias("set"), "items")
    lengths = [r[0] for r in found.select("size").distinct().collect()]  # at most ``window`` values
    ids = sets.select("set", "items").dropDuplicates(["set"])
    # What is broadcast is counted first, row by row and byte by byte; the rest is shuffled.
    n, n_bytes = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(_bytes("words")), F.lit(0))).first()
    few, short = n <= max_broadcast, n_bytes <= max_bytes
    small = ids.agg(F.coalesce(F.sum(_bytes("items")), F.lit(0))).first()[0] <= max_bytes

    schema = docs.schema[id_col].dataType.simpleString()
    if not lengths:
        return spark.createDataFrame([], f"id {schema}, text_hash long, spans array<struct<s:int,e:int>>, items array<string>")

    keys = sets.select("size", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    needles = (
        with_window_hashes(keys, "h", lengths, "runs")
        .select("size", F.explode_outer("runs").alias("run"))
        .where(F.col("run.size") == F.col("size"))
        .select("size", F.col("run.hashes")[0].alias("hash"))
        .distinct()
    )
    text = F.coalesce(col(text_col), F.lit(""))
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    word_hashes = rows.select("id", "text_hash", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("h"))
    # "outer": a plain explode has Catalyst test the arrays' size below the scan, and
    # so build them twice, nested.
    hits = (
        with_window_hashes(word_hashes, "h", lengths, "runs")
        .select("id", "text_hash", F.explode_outer("runs").alias("run"))
        .select("id", "text_hash", F.col("run.size").alias("size"), F.posexplode_outer("run.hashes").alias("pos", "hash"))
        .join(F.broadcast(needles) if few else needles, ["size", "hash"], "left_semi")
        .groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("pos", "size")).alias("hits"))
    )

    # The candidates' words come back to be compared themselves.
    rows = rows.select(F.col("id").alias("id_"), F.col("text_hash").alias("hash_"), "t")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("text_hash") == F.col("hash_"))
    tokens = hits.join(rows, same).select("id", "text_hash", "hits", words(F.col("t")).alias("w"))
    run = F.transform(
        "hits",
        lambda h: F.struct(
            h["pos"].alias("pos"),
            F.when(h["pos"] + h["size"] <= F.size("w"), F.slice("w", h["pos"] + 1, h["size"])).alias("words"),
        ),
    )
    occurring = tokens.select("id", "text_hash", F.explode_outer(run).alias("run")).select(
        "id", "text_hash", F.col("run.pos").alias("pos"), F.col("run.words").alias("words")
    )
    known = sets.select("size", "words", "set")
    verified = occurring.join(F.broadcast(known) if few and short else known, "words")
    per_row = verified.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct(F.col("pos").alias("s"), (F.col("pos") + F.col("size")).alias("e")))).alias("o"),
        F.collect_set("set").alias("sets"),
    )
    # Occurrences that overlap or touch become one span.  Of those with one start the
    # longest counts; none is longer than the window, so a look back at as many
    # others tells whether a span begins, and the work grows with the hits alone.
    longest = F.filter("o", lambda x, i: F.coalesce(F.get("o", i + 1)["s"] != x["s"], F.lit(True)))
    per_row = per_row.withColumn("o", longest)

    def end_at(i: Column) -> Column:
        """The furthest end of the occurrences up to the i-th."""
        near = F.slice("o", F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window)) + 1)
        return F.array_max(F.transform(near, lambda y: y["e"]))

    per_row = per_row.withColumn("until", F.transform("o", lambda x, i: end_at(i)))
    starts = F.filter("o", lambda x, i: F.coalesce(x["s"] > F.get("until", i - 1), F.lit(True)))
    ends = F.filter("until", lambda e, i: F.coalesce(F.get("o", i + 1)["s"] > e, F.lit(True)))
    merged = F.zip_with(F.transform(starts, lambda x: x["s"]), ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    per_row = per_row.select("id", "text_hash", merged.alias("spans"), "sets")
    named = (
        per_row.select("id", "text_hash", F.explode("sets").alias("set"))
        .join(F.broadcast(ids) if few and small else ids, "set")
        .select("id", "text_hash", F.explode("items").alias("item"))
        .groupBy("id", "text_hash")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select(F.col("id").alias("id_"), F.col("text_hash").alias("hash_"), "items")
    )
    return per_row.join(named, same).select("id", "text_hash", "spans", "items")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    remove: str = "documents",
) -> DataFrame:
    """``docs`` less its contaminated rows, or less their hit words.

    ``remove`` is "documents", or "spans": then a hit row's text becomes its
    remaining words, lower-cased and joined by spaces, and other rows stay as
    they are.  Null and empty texts stay.
    """
    id_, hash_, row_hash, spans = fresh(docs, "dc_id", "dc_hash", "dc_row", "dc_spans")
    found = contamination(docs, items, id_col, text_col, window=window).select(
        F.col("id").alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(spans)
    )
    rows = docs.withColumn(row_hash, F.xxhash64(F.coalesce(col(text_col), F.lit(""))))
    same = col(id_col).eqNullSafe(col(id_)) & (col(row_hash) == col(hash_))
    if remove == "documents":
        return rows.join(found, same, "left_anti").select(*map(col, docs.columns))
    w = words(col(text_col))
    left = F.filter(w, lambda _, i: ~F.exists(col(spans), lambda s: (s["s"] <= i) & (i < s["e"])))
    text = F.when(col(spans).isNull(), col(text_col)).otherwise(F.array_join(left, " "))
    return rows.join(found, same, "left").select(*[text.alias(c) if c == text_col else col(c) for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("id").alias("id_"),
        F.col("text_hash").alias("hash_"),
        F.aggregate("spans", F.lit(0), lambda n, s: n + s["e"] - s["s"]).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    counted = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_hash"),
        F.size(words(F.col("text"))).cast("long").alias("n_words"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("row_hash") == F.col("hash_"))
    return counted.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH low AS (SELECT row_number() OVER () AS r, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT r, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0),
dw AS (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM d, (SELECT DISTINCT n FROM bw) AS ns, unnest(range(1, greatest(len(w) - n + 2, 1))) AS u(i)),
hits AS (SELECT r, i, dw.n, item FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
words AS (SELECT r, count(DISTINCT i + o) AS n_hit FROM (SELECT DISTINCT r, i, n FROM hits), unnest(range(0, n)) AS v(o) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN its USING (r)
"""
