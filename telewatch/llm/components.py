"""Connected components of an edge list, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telewatch.llm.common import checkpoint

MAX_ROUNDS = 60


def _with_least(edges: DataFrame, least: DataFrame, tasks: int) -> DataFrame:
    """``edges`` (a, b) with ``m``, the value of a in ``least`` (a, m).

    A node's edges are dealt into ``tasks`` cells by their other end, and its value
    is handed to its cells first, so that a node with very many edges is no
    group of one task.
    """
    dealt = edges.withColumn("cell", F.pmod(F.xxhash64("b"), F.lit(tasks)))
    cells = dealt.select("a", "cell").distinct().join(least, "a")
    return dealt.join(cells, ["a", "cell"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternates two steps until the edges no longer change: every node hooks its
    larger neighbours to its smallest one, then its smaller neighbours.  The
    smallest neighbour is a partial aggregate, and reaches the edges of a node
    over many tasks.  Each round is checkpointed.  Nodes are non-null;
    loops and repeated edges are allowed; no edges give no rows.
    """
    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = checkpoint(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _with_least(both.where(F.col("b") > F.col("a")), least, tasks)
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _with_least(large, least, tasks).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpoint(
            small.unionByName(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
