"""Quality rules: base rules and a hashed n-gram likelihood ratio.

Tokens are runs of word characters and runs of other visible characters, lower
case; their unigrams and bigrams are hashed into ``BUCKETS`` buckets.  Two
multinomials over the buckets, one of the trusted target documents and one of
the whole corpus, give each bucket a log ratio; a document's score is the mean
of its n-grams' ratios.  Both sets of counts are over every row.

The threshold is one number, the same for every document: the score that tells
labelled good from labelled bad documents best, found on a histogram of the
labelled rows' scores.  No sampling takes part, so verdicts are repeatable.

All of it is DataFrame functions: no Python runs on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.llm.common import WHITE_SPACE, checkpoint, col, table

BUCKETS = 10_000  # also the size of what is broadcast
SMOOTHING = 1.0
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"
STEPS = 2_000  # histogram steps of 0.005 in which the threshold is sought
STEP = 0.005
_SPACE = r"[\x20\x09-\x0D]+"
_TOKEN = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+"


def split_words(text: Column) -> Column:
    """Words between ASCII white space; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE, -1))


def with_repeat_words(frame: DataFrame, words: str, out: str, window: int = REPEAT_WINDOW) -> DataFrame:
    """``frame`` with ``out``: the words inside runs of ``window`` words that the
    text has twice or more.

    The words are hashed, and a text's windows from the hashes of their words;
    only where some hash occurs twice are the hashes sorted with their positions,
    to find which."""
    frame = frame.withColumn("qr_words", F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.slice("qr_words", 1, F.greatest(F.size("qr_words") - (window - 1), F.lit(0)))
    hashes = F.transform(
        starts, lambda h, i: F.xxhash64(h, *[F.get("qr_words", i + k) for k in range(1, window)])
    )
    frame = frame.withColumn("qr_hashes", hashes)
    distinct = F.size(F.array_distinct("qr_hashes"))
    pairs = F.sort_array(F.transform("qr_hashes", lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i"))))
    frame = frame.withColumn("qr_sorted", F.when(distinct < F.size("qr_hashes"), pairs))
    frame = frame.withColumn("qr_h", F.transform("qr_sorted", lambda p: p["h"]))
    repeated = F.transform(
        "qr_sorted",
        lambda p, k: F.when(
            (p["h"] == F.get("qr_h", k - 1)) | (p["h"] == F.get("qr_h", k + 1)), p["i"]
        ),
    )
    frame = frame.withColumn("qr_at", F.sort_array(F.array_compact(repeated)))
    # Each start covers ``window`` words, or as many as lie before the next start.
    covered = F.transform(
        "qr_at", lambda i, k: F.least(F.lit(window), F.coalesce(F.get("qr_at", k + 1) - i, F.lit(window)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return frame.withColumn(out, F.coalesce(total, F.lit(0).cast("long"))).drop(
        "qr_words", "qr_hashes", "qr_sorted", "qr_h", "qr_at"
    )


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, t)."""
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("t"))
    rows = rows.withColumn("w", split_words(F.col("t")))
    rows = with_repeat_words(rows, "w", "n_repeat_words")
    with_word = F.filter(F.split("t", "\n", -1), lambda line: F.btrim(line, F.lit(WHITE_SPACE)) != "")
    rows = rows.withColumn("lines", with_word)
    rows = rows.select(
        "id",
        "t",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def with_buckets(frame: DataFrame, text: Column, out: str, buckets: int = BUCKETS) -> DataFrame:
    """``frame`` with ``out``: the buckets of a text's unigrams and bigrams."""
    frame = frame.withColumn("qb_tokens", F.transform(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0)), lambda w: F.xxhash64(w)))
    grams = F.transform(
        "qb_tokens",
        lambda x, i: F.struct(
            F.pmod(x, F.lit(buckets)).cast("int").alias("u"),
            F.pmod(F.xxhash64(x, F.get("qb_tokens", i + 1)), F.lit(buckets)).cast("int").alias("b"),
        ),
    )
    return frame.withColumn(out, grams).drop("qb_tokens")


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight): log of the target's share over the corpus's share."""
    ids = trusted.select(col(id_col).alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("t"))
    # The join moves texts, which are smaller than their n-grams; what the counts
    # shuffle is one row per task and bucket.
    target = F.coalesce(F.col("trusted_id").isNotNull(), F.lit(False)).cast("long")
    # Always a shuffle: the number of trusted ids grows with the corpus.
    rows = rows.join(ids.hint("merge"), rows.id == ids.trusted_id, "left").select(target.alias("target"), "t")
    rows = with_buckets(rows, F.col("t"), "grams", buckets).select("target", "grams")
    grams = rows.select("target", F.explode_outer("grams").alias("g"))
    grams = grams.select("target", F.explode_outer(F.array("g.u", "g.b")).alias("bucket"))
    counts = grams.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("target").alias("k")
    )
    counts = checkpoint(counts)
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    share = (F.col("k") + SMOOTHING) / (totals["k"] + SMOOTHING * buckets)
    of_all = (F.col("n") + SMOOTHING) / (totals["n"] + SMOOTHING * buckets)
    return counts.select("bucket", F.round(F.log(share / of_all), 6).alias("weight"))


def with_score(frame: DataFrame, text: Column, weights: DataFrame, out: str, buckets: int = BUCKETS) -> DataFrame:
    """``frame`` with ``out``, the mean log ratio of a text's n-grams, 0 without any.

    The weights, one number per bucket, become a constant of the plan."""
    known = {r.bucket: r.weight for r in weights.collect()}  # at most ``buckets`` rows
    listed = ",".join(repr(known.get(b, 0.0)) for b in range(buckets))
    lookup = F.split(F.lit(listed), ",").cast("array<double>")
    frame = with_buckets(frame, text, "qs_grams", buckets)
    total = F.aggregate(
        "qs_grams", F.lit(0.0), lambda a, g: a + F.get(lookup, g["u"]) + F.get(lookup, g["b"])
    )
    n = F.size("qs_grams")
    return frame.withColumn(out, F.when(n > 0, F.round(total / (2 * n), 9)).otherwise(F.lit(0.0))).drop("qs_grams")


def threshold(scored: DataFrame) -> float:
    """The score that tells ``good`` from bad rows best.

    Of the histogram's steps with the most right verdicts the longest unbroken
    run counts, the lowest of several, and its middle is the threshold.  Without
    rows of both classes it is minus infinity: nothing is dropped for its score."""
    step = F.floor(F.col("score") / STEP).cast("int")
    step = F.greatest(F.lit(-STEPS), F.least(F.lit(STEPS), step))
    counts = scored.groupBy(step.alias("step"), "good").count().collect()  # at most 2 * (2 * STEPS + 1) rows
    net = dict.fromkeys(range(-STEPS, STEPS + 1), 0)  # bad less good rows in a step
    for r in counts:
        net[r.step] += -r["count"] if r.good else r["count"]
    if len({r.good for r in counts}) < 2:
        return float("-inf")
    right, gained = [], 0
    for s in net:
        right.append(gained)
        gained += net[s]
    runs: list[list[int]] = [[]]
    for s, value in zip(net, right, strict=True):
        if value == max(right):
            runs[-1].append(s)
        elif runs[-1]:
            runs.append([])
    best = max(runs, key=len)
    return (best[0] + best[-1]) // 2 * STEP


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    buckets: int = BUCKETS,
) -> DataFrame:
    """(id, the base counts, base_failed, score, kept) for every row.

    ``labels`` name the trusted documents (``label_col`` 1) and the bad ones
    (0); null labels count as neither.  Null and empty texts have no words and
    fail; repeated rows are judged alike; extra columns are not read; an empty
    table gives no rows.
    """
    marked = labels.where(col(label_col).isNotNull()).select(col(id_col), (col(label_col) > 0).alias("good"))
    weights = bucket_weights(docs, marked.where("good"), id_col, text_col, buckets)
    rows = with_score(base_rules(docs, id_col, text_col), F.col("t"), weights, "score", buckets).drop("t")
    rows = checkpoint(rows)
    judged = marked.select(col(id_col).alias("label_id"), "good").where("label_id IS NOT NULL")
    limit = threshold(
        rows.where(~F.col("base_failed")).join(judged, F.col("id") == F.col("label_id")).select("score", "good")
    )
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(limit)))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, the four counts, base_failed, kept and the score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = quality(docs, table(spark, sf_dir, "labels"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )
