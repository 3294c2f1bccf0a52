"""The corpus pipeline: five operators of ``telewatch.llm``, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; every stage but the last returns the columns of ``documents``.  Null and
empty texts, repeated rows and empty tables pass as each operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from telewatch.llm.common import col, stored, table

SCORE = "pipeline_toxicity_score"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.5 or more go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity(docs, model, score_col=SCORE)
    return scored.where(F.col(SCORE) < 0.5).select(*map(col, docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; ``n_chars`` follows."""
    out = line_dedup.line_dedup(docs, n_lines="pipeline_n_lines", n_dropped="pipeline_n_dropped")
    changed = F.col("pipeline_n_dropped") > 0
    return out.select(
        *[
            F.when(changed, F.length("text")).otherwise(col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else col(c)
            for c in docs.columns
        ]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest id."""
    return simhash.keep_one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids, and the digests of op7_bpe."""
    encoded = bpe.bpe_encode(docs.select("doc_id", "text"), bpe.default_path(), decoded_col="decoded")
    return bpe.digests(encoded, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None  # the classifier is not SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-stage-{k}")
    return docs
