"""Counterfactually regularised toxicity classifier.

A logistic model over two kinds of features: whether a text has a word, and
the share of its distinct words that begin with a prefix, so that inflected
forms of a stem count together.  Sentences of the labelled rows that name a
group are copied with the identity term swapped for another of its kind; the
squared change of the score between sentence and copy is penalised, so that
which group is named cannot carry a score and neutral mentions are not taken
for attacks.  Labelled texts that name no group are given a mention: one of
their sentences is copied once for each term of a kind, and the copies are held
against each other and, where the text is labelled harmless, against the
sentence itself.  Terms share word prefixes with words that do go with a label,
so this penalty acts also where the labelled texts name nobody.

Fitting sees a bounded sample of labelled rows (``max_rows``, and ``MAX_SWAPS``
copied sentences of each).  Spark counts
their features and selects those that go with a label; at most
``MAX_FEATURES`` of them reach the driver.  Scoring reads every row's whole text
in the tasks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm.common import checkpoint, col, fresh, table

MAX_ROWS = 8_000  # labelled rows that fitting may see
MAX_SWAPS = 64  # sentences with a swapped or added term that a labelled row may give
MAX_FEATURES = 20_000
MIN_ROWS_OF_FEATURE = 4
KNOWN_WORDS = 300_000  # words whose features a task keeps
MIN_Z = 4.0  # standard errors by which a feature's rate of label 1 must be off the mean
PREFIXES = range(3, 9)
FULL_SHARE = 0.04  # a prefix counts in full from this share of the distinct words on
EPOCHS = 40
BATCH_ROWS = 256
RATE = 0.5
SPARSITY = 5e-4
FAIRNESS = 1.0
SEED = 5
FOLDS = 5  # rows whose crc32(id) is divisible by this are held out

# Interchangeable identity terms: any member of a line may replace another.
IDENTITY_TERMS = """
women men
woman man
girls boys
muslims christians jews hindus buddhists atheists
muslim christian jewish hindu buddhist atheist
black white asian latino african european
gay straight lesbian bisexual transgender
blind deaf disabled
elderly young
immigrants refugees locals foreigners
frauen männer
muslime christen juden
ausländer einwanderer flüchtlinge
femmes hommes
musulmans chrétiens juifs
immigrés réfugiés étrangers
mujeres hombres
musulmanes cristianos judíos
inmigrantes refugiados extranjeros
"""

_WORDS = re.compile(r"\w+").findall
_SENTENCES = re.compile(r"[^.!?\n]+").findall


def words(text: str | None) -> list[str]:
    return _WORDS((text or "").lower())


def feature_hash(kind: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind}{text}".encode("utf-8", "replace"))


def features_of(word: str) -> Iterator[tuple[bool, int]]:
    """(is a prefix, hash) of a word's features."""
    yield False, feature_hash("w", word)
    for n in PREFIXES:
        if len(word) < n:
            break
        yield True, feature_hash("p", word[:n])


def features(some: set[str]) -> dict[int, float]:
    """The feature values of a set of words."""
    counts: dict[int, int] = {}
    out: dict[int, float] = {}
    for word in some:
        for prefix, h in features_of(word):
            if prefix:
                counts[h] = counts.get(h, 0) + 1
            else:
                out[h] = 1.0
    for h, n in counts.items():
        out[h] = min(1.0, n / len(some) / FULL_SHARE)
    return out


def term_lines(terms: str = IDENTITY_TERMS) -> list[list[str]]:
    """The lines of terms that may replace one another."""
    return [line.split() for line in terms.splitlines() if line.strip()]


def term_groups(terms: str = IDENTITY_TERMS) -> dict[str, list[str]]:
    """Each identity term -> the terms that may replace it."""
    groups = term_lines(terms)
    return {term: [t for t in group if t != term] for group in groups for term in group}


def counterfactuals(text: str | None, groups: dict[str, list[str]]) -> Iterator[tuple[set[str], set[str]]]:
    """The words of each sentence that names a group, and those of each swapped copy."""
    low = (text or "").lower()
    for sentence in _SENTENCES(low):
        found = _WORDS(sentence)
        named = [w for w in found if w in groups]
        if not named:
            continue
        for k in range(max(len(groups[w]) for w in named)):
            swapped = {groups[w][k % len(groups[w])] if w in groups else w for w in found}
            yield set(found), swapped


def mentions(text: str | None, harmless: bool, lines: list[list[str]]) -> Iterator[tuple[set[str], set[str]]]:
    """For a text that names no group: the words of one of its sentences (the least by hash) with
    each term of one line against those with the next term; if ``harmless`` also against none."""
    sentences = [found for found in map(_WORDS, _SENTENCES((text or "").lower())) if found]
    terms = {t for line in lines for t in line}
    if not sentences or any(not terms.isdisjoint(found) for found in sentences):
        return
    order, chosen = min((feature_hash("s", " ".join(found)), found) for found in sentences)
    some, line = set(chosen), lines[order % len(lines)]
    for term, following in zip(line, line[1:] + line[:1], strict=True):
        yield some | {term}, some | {following}
        if harmless:
            yield some | {term}, some


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[int, float]  # feature hash -> weight

    def scorer(self) -> Callable[[str | None], float]:
        """A function that scores texts and keeps the weighted features of words met before."""
        known: dict[str, tuple[tuple[bool, int], ...]] = {}

        def score(text: str | None) -> float:
            if len(known) > KNOWN_WORDS:
                known.clear()
            some = set(words(text))
            terms, counts = [self.bias], {}
            for word in some:
                found = known.get(word)
                if found is None:
                    found = known[word] = tuple(f for f in features_of(word) if f[1] in self.weights)
                for prefix, h in found:
                    if prefix:
                        counts[h] = counts.get(h, 0) + 1
                    else:
                        terms.append(self.weights[h])
            terms += [self.weights[h] * min(1.0, n / len(some) / FULL_SHARE) for h, n in counts.items()]
            margin = max(-35.0, min(35.0, math.fsum(terms)))  # fsum: the order does not matter
            return 1.0 / (1.0 + math.exp(-margin))

        return score


@dataclass
class _Sparse:
    """Rows of feature values."""

    index: np.ndarray
    value: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = self.ends[which + 1] - self.ends[which]
        row = np.repeat(np.arange(len(which)), sizes)
        at = np.arange(sizes.sum()) + np.repeat(self.ends[which] - (np.cumsum(sizes) - sizes), sizes)
        return self.index[at], self.value[at], row


def _fit(x: _Sparse, y: np.ndarray, pairs: _Sparse, n_features: int, fairness: float, sparsity: float) -> tuple[float, np.ndarray]:
    """Proximal AdaGrad on log loss + sparsity · |w| + fairness · (score change)²."""
    rng = np.random.RandomState(SEED)
    w, g2 = np.zeros(n_features), np.full(n_features, 1e-8)
    rate = y.mean() if len(y) else 0.5
    b, b2 = float(np.log((rate + 1e-6) / (1 - rate + 1e-6))), 1e-8
    for _ in range(EPOCHS if len(y) else 0):
        order, order_p = rng.permutation(len(y)), rng.permutation(len(pairs))
        steps = max(1, -(-len(y) // BATCH_ROWS))
        for batch, batch_p in zip(np.array_split(order, steps), np.array_split(order_p, steps), strict=True):
            index, value, row = x.rows(batch)
            margin = b + np.bincount(row, weights=w[index] * value, minlength=len(batch))
            error = 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))) - y[batch]
            grad = np.bincount(index, weights=value * error[row], minlength=n_features) / len(batch)
            if len(batch_p):
                index, value, row = pairs.rows(batch_p)
                change = np.bincount(row, weights=w[index] * value, minlength=len(batch_p))
                grad += 2 * fairness / len(batch_p) * np.bincount(index, weights=value * change[row], minlength=n_features)
            g2 += grad * grad
            step = RATE / np.sqrt(g2)
            step[g2 <= 1e-8] = 0
            w -= step * grad
            w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(step, 10.0) * sparsity, 0)
            slope = float(error.mean())
            b2 += slope * slope
            b -= RATE / np.sqrt(b2) * slope
    return b, w


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
    fairness: float = FAIRNESS,
    sparsity: float = SPARSITY,
    terms: str = IDENTITY_TERMS,
    folds: int | None = FOLDS,
) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold.

    The sample is the labels least by a hash of their id, the same on every run,
    each with one text of its id (the least by hash, where rows repeat an id) and
    at most ``MAX_SWAPS`` sentences with a swapped or added term.  So what the driver gets
    is bounded by ``max_rows``.  Null labels, ids and texts without a label teach
    nothing; contradicting labels of one id both count; without labelled rows
    every score is 0.5.
    """
    spark = docs.sparkSession
    key = col(id_col).cast("string")
    known = labels.where(col(label_col).isNotNull() & col(id_col).isNotNull())
    if folds:
        known = known.where(F.crc32(key.cast("binary")) % folds != 0)
    sample = (
        known.select(col(id_col).alias("lid"), (col(label_col) > 0).cast("double").alias("y"))
        .orderBy(F.xxhash64(F.col("lid").cast("string"), F.lit("toxicity sample")), "lid", "y")
        .limit(max_rows)
    )
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("t"))
    labelled = texts.join(F.broadcast(sample.select("lid").distinct()), F.col("id") == F.col("lid"), "left_semi")
    one = labelled.groupBy("id").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    joined = checkpoint(one.join(F.broadcast(sample), F.col("id") == F.col("lid")).select("id", "t", "y"))
    groups, lines = term_groups(terms), term_lines(terms)
    schema = "row long, kind int, y double, feature long, value double"

    def emit(selected: Broadcast | None) -> Callable:
        """Feature values of rows (kind 0) and of changes by a swap (kind 1)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = TaskContext.get()
            row = (context.partitionId() if context else 0) << 40
            only = selected.value if selected else None
            for batch in batches:
                out: list[tuple[int, int, float, dict[int, float]]] = []
                for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    row += 1
                    out.append((row, 0, y, features(set(words(text)))))
                    if only is None:  # rows alone are counted
                        continue
                    pairs = chain(counterfactuals(text, groups), mentions(text, y == 0, lines) if lines else ())
                    for real, swapped in islice(pairs, MAX_SWAPS):
                        a, b = features(real), features(swapped)
                        change = {h: a.get(h, 0.0) - b.get(h, 0.0) for h in a.keys() | b.keys() if h in only}
                        if any(change.values()):
                            row += 1
                            out.append((row, 1, y, change))
                flat = [
                    (r, kind, y, h, v)
                    for r, kind, y, values in out
                    for h, v in [(0, 1.0), *sorted(values.items())]  # feature 0 stands for the row itself
                    if v and (only is None or not h or h in only)
                ]
                if flat:
                    r, kind, y, h, v = zip(*flat, strict=True)
                    hashes = pa.array(np.array(h, dtype=np.uint64).view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r, pa.int64()), pa.array(kind, pa.int32()), pa.array(y, pa.float64()), hashes, pa.array(v, pa.float64())],
                        ["row", "kind", "y", "feature", "value"],
                    )

        return run

    rows = joined.select("t", "y")
    rate = rows.agg(F.avg("y")).first()[0]
    if rate is None:
        return Model(0.0, {})
    counted = rows.mapInArrow(emit(None), schema).where("feature <> 0 AND kind = 0").groupBy("feature")
    stats = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("k")).where(F.col("n") >= MIN_ROWS_OF_FEATURE)
    off = F.abs(F.col("k") - F.col("n") * rate) / F.sqrt(F.col("n") * (rate * (1 - rate) + 1e-9))
    chosen = stats.select("feature", off.alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    vocabulary = np.sort(chosen.select("feature").toArrow()["feature"].to_numpy().astype(np.int64))
    selected = spark.sparkContext.broadcast(frozenset(vocabulary.view(np.uint64).tolist()))
    got = rows.mapInArrow(emit(selected), schema).toArrow()
    got = got.sort_by([("row", "ascending"), ("feature", "ascending")])

    def matrix(kind: int) -> tuple[_Sparse, np.ndarray]:
        part = got.filter(pa.compute.equal(got["kind"], kind))
        row, y, feature, value = (part[c].to_numpy() for c in ("row", "y", "feature", "value"))
        own = feature == 0
        ids, place = np.unique(row, return_inverse=True)
        use = ~own
        index = np.searchsorted(vocabulary, feature[use])
        ends = np.concatenate(([0], np.cumsum(np.bincount(place[use], minlength=len(ids)))))
        return _Sparse(index, value[use], ends), y[own]

    x, y = matrix(0)
    pairs, _ = matrix(1)
    bias, weights = _fit(x, y, pairs, len(vocabulary), fairness, sparsity)
    used = np.flatnonzero(weights)
    return Model(bias, dict(zip(vocabulary[used].view(np.uint64).tolist(), weights[used].tolist(), strict=True)))


def toxicity(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col``, the model's score of the whole text, 0 to 1.

    Every row comes back with its other columns (one named ``score_col`` is
    replaced).  Null and empty texts score the model's bias; repeated rows
    score alike; an empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c.lower() != score_col.lower()]
    (text_,) = fresh(docs, "tox_text")
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(score_col, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            scores = [score(t.as_py()) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(scores, pa.float64())], [*keep, score_col]
            )

    return docs.select(*[col(c) for c in keep], col(text_col).alias(text_)).mapInArrow(run, schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity(docs, model).select("doc_id", "score")
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
