"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half of its shingles' 64-bit
hashes have it.  Texts whose fingerprints differ in at most ``max_bits`` bits
are linked.  The index cuts the distinct fingerprints into segments and keeps
one table per segment: of two fingerprints that are near enough, one segment
differs in at most ``max_bits // segments`` bits.  So each fingerprint looks up
the small Hamming ball around its segment's value in that segment's table, and
the matches' complete distances are verified in the join.

Only distinct fingerprints enter the index, so copies cost nothing there.  A
table value that very many fingerprints share is refined: the rest of the
fingerprint, cut in two, is looked up the same way within that value, which
finds every pair that the plain look-up finds without comparing all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telewatch.llm.common import checkpoint, col, fresh, stored, table
from telewatch.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEGMENTS = 2
SEED = 42
CROWDED = 256  # table values with more fingerprints are refined
_BITS = 64
_SLICE = 1 << 17  # shingles hashed between two additions to the bit counts


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text, 0 for a text without words."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters, ASCII white space
    if not tokens:
        return 0
    shingles = zip(*(tokens[k:] for k in range(words)), strict=False) if len(tokens) >= words else [tokens]
    n = max(1, len(tokens) - words + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    counts = np.zeros(_BITS, dtype=np.int64)
    hashes = (digest(join(s), SEED) for s in shingles)
    for at in range(0, n, _SLICE):
        part = np.fromiter(hashes, dtype="<u8", count=min(_SLICE, n - at))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def with_fingerprints(
    docs: DataFrame, text_col: str, words: int, keep: list[str], fp_col: str = "fp", row_col: str = "row"
) -> DataFrame:
    """The ``keep`` columns of every row, its fingerprint as a signed 64-bit integer
    and a number that no other row has.  The numbers last only where the result is stored."""
    at, places = docs.columns.index(text_col), [docs.columns.index(c) for c in keep]
    added = [T.StructField(fp_col, T.LongType(), False), T.StructField(row_col, T.LongType(), False)]
    schema = T.StructType([docs.schema.fields[k] for k in places] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        next_row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(at)], dtype=np.uint64)
            rows = np.arange(next_row, next_row + len(found), dtype=np.int64)
            next_row += len(found)
            kept = [batch.column(k) for k in places]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view(np.int64)), pa.array(rows)], schema.names)

    return docs.mapInArrow(run, schema)


def _cut(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    edges = [low + (high - low) * k // parts for k in range(parts + 1)]
    return list(zip(edges, edges[1:], strict=False))


def _value(fp: Column, low: int, high: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def _ball(low: int, high: int, radius: int) -> list[int]:
    """The bit masks that change at most ``radius`` bits of a segment."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(high - low), r)]


def _look_up(rows: DataFrame, inside: list[str], pieces: list[tuple[int, int]], radius: int, probe: bool) -> DataFrame:
    """``rows`` under each piece's value, or as probes under the ball around it;
    ``part`` tells the pieces apart, within the columns of ``inside``."""
    keys = []
    for k, (low, high) in enumerate(pieces):
        value = _value(F.col("fp"), low, high)
        values = [value.bitwiseXOR(F.lit(m)) for m in _ball(low, high, radius)] if probe else [value]
        keys += [F.struct(F.lit(k).alias("part"), v.alias("value")) for v in values]
    exploded = rows.select(*inside, "fp", F.explode(F.array(*keys)).alias("key"))
    return exploded.select(*inside, F.col("key.part").alias("part"), F.col("key.value").alias("value"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, crowded: int = CROWDED) -> DataFrame:
    """(a, b) with a < b: all pairs of distinct ``fp`` within ``max_bits`` bits."""
    pieces, radius = _cut(0, _BITS, segments), max_bits // segments
    members = _look_up(fps, [], pieces, radius, probe=False)
    probes = _look_up(fps, [], pieces, radius, probe=True)
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)

    def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        return (
            left.withColumnRenamed("fp", "a")
            .alias("l")
            .join(
                right.withColumnRenamed("fp", "b").alias("r"),
                [F.col(f"l.{c}") == F.col(f"r.{c}") for c in on] + [near],
            )
            .select("a", "b")
        )

    sizes = members.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    hot = checkpoint(sizes.where(F.col("n") > crowded).select("part", "value", F.lit(True).alias("hot")))
    # Balls are symmetric: it is enough that the larger fingerprint looks up the smaller.
    members, probes = (df.join(hot, ["part", "value"], "left") for df in (members, probes))
    found = matched(members.where(F.col("hot").isNull()), probes.where(F.col("hot").isNull()), ["part", "value"])
    for k, (low, high) in enumerate(pieces):
        rest = _cut(0, low, 2) if low else _cut(high, _BITS, 2)
        if low and high < _BITS:  # a piece in the middle: what lies on either side
            rest = [(0, low), (high, _BITS)]
        inner = [
            (df.where(F.col("hot") & (F.col("part") == k)).select(F.col("value").alias("outer"), "fp"), probe)
            for df, probe in ((members, False), (probes, True))
        ]
        (m, p) = (_look_up(df, ["outer"], rest, max_bits // 2, probe) for df, probe in inner)
        found = found.unionByName(matched(m, p, ["outer", "part", "value"]))
    return found.distinct()


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fps``, one row for each fingerprint ``fp``, with the least fingerprint that links reach."""
    roots = connected_components(links(fps.select("fp"), max_bits))
    # Only fingerprints with links have a root; the rest are their own.
    joined = fps.join(roots, fps.fp == roots.node, "left")
    return joined.select(*fps.columns, F.coalesce("root", "fp").alias("root"))


def simhash_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, fp, component): one row per row of ``docs``.

    ``component`` is the smallest id that links reach, the row's own included.
    A null or empty text has fingerprint 0 and links like any other.  Null ids
    count below none: a component of null ids alone is null.  Repeated rows come
    back as often as they occur; an empty table gives no rows.

    Rows get their component in two steps, so that the copies of one fingerprint,
    however many, are dealt over as many tasks as a shuffle has.
    """
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    rows = stored(with_fingerprints(texts, "text", words, ["id"]), "simhash-rows")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("id", "fp", F.pmod("row", F.lit(tasks)).alias("cell"))
    cells = checkpoint(rows.groupBy("fp", "cell").agg(F.min("id").alias("least")))
    fps = checkpoint(cells.groupBy("fp").agg(F.min("least").alias("least")))
    rooted = _rooted(fps, max_bits)
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(smallest, "root").select("fp", "component")
    told = cells.select("fp", "cell").join(named, "fp")
    return rows.join(told, ["fp", "cell"]).select("id", "fp", "component")


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of ``docs`` for each component of near copies.

    It is the row of the smallest id, null ids after all others; where rows of the
    component repeat that id, the one whose text has the least hash; of rows alike
    in id and text, any one.  Rows, not ids, are decided on, so an id that stands
    for several texts may stay with one and go with another, and no component
    goes whole.  The texts are stored once beside their fingerprints."""
    fp, row, digest = fresh(docs, "sh_fp", "sh_row", "sh_digest")
    marked = with_fingerprints(docs, text_col, words, docs.columns, fp, row)
    rows = stored(marked.withColumn(digest, F.xxhash64(col(text_col))), "simhash-texts")
    order = F.struct(col(id_col).isNull().alias("none"), col(id_col).alias("id"), col(digest).alias("digest"), col(row).alias("row"))
    fps = checkpoint(rows.groupBy(col(fp).alias("fp")).agg(F.min(order).alias("first")))
    first = _rooted(fps, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    kept = rows.join(first.select(F.col("first.row").alias(row)), row, "left_semi")
    return kept.select(*map(col, docs.columns))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id for every document."""
    found = simhash_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
