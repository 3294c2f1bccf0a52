"""Sharding by extendible hashing, in DataFrame operations alone.

Rows hash to 60 bits; a bucket is the set of rows that share a prefix of these
bits.  A bucket over the byte limit splits on its next bit, others stay, until
every bucket fits.  The directory maps each final prefix, with its depth, to
its shard.

Rounds of ``STEP_BITS`` bits find the depths: only rows of buckets that are still
too large enter a round, and each round sums their bytes under all its prefix
lengths at once.  The directory has a row for each shard.  Rows look up the entry
of their first bits; it is broadcast up to ``BROADCAST_SHARDS`` shards and shuffled
beyond.  Nothing reaches the driver but the number of shards.

Rows of one key share all bits.  Where such rows exceed the limit by
themselves, they are counted and numbered, and the number joins the key in the
hash, so that repeats spread over shards, too.  A single row over the limit is
a shard of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.llm.common import checkpoint, col, table

SHARD_BYTES = 1 << 20  # small, so that even small tables split; a cluster's files would take more
STEP_BITS = 8
HASH_BITS = 60
BROADCAST_SHARDS = 1 << 18  # at most twice as many entries, of 36 bytes each
_CHUNK = 4096  # repeats of one row that a single step numbers


def hash_bits(key: Column) -> Column:
    """60 bits of a key's MD5, most significant first."""
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(bits: Column, depth: Column | int) -> Column:
    """The first ``depth`` bits."""
    if isinstance(depth, int):
        return F.shiftright(bits, HASH_BITS - depth)
    return F.call_function("shiftright", bits, (F.lit(HASH_BITS) - depth).cast("int"))


def directory(cells: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, rows): one row for each shard of ``cells`` (bits, bytes, rows).

    A shard is a prefix whose rows fit the limit while those of the prefix one bit
    shorter do not; rows that share all bits are a shard whatever their size."""
    open_cells, found, low = cells, None, 0
    total = (F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    while True:
        high = min(low + STEP_BITS, HASH_BITS + 1)
        depths = F.explode(F.array(*[F.lit(d) for d in range(low, high)])).alias("depth")
        # Summed per deepest prefix first, so that the explode is small.
        deepest = open_cells.groupBy(prefix(F.col("bits"), high - 1).alias("cell")).agg(*total)
        shorter = F.call_function("shiftright", "cell", F.lit(high - 1) - F.col("depth")).alias("prefix")
        sums = deepest.select("cell", "bytes", "rows", depths).groupBy("depth", shorter).agg(*total)
        fits = (F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS)
        sums = checkpoint(sums.withColumn("fits", fits))
        fitting = sums.where("fits")
        parents = fitting.select((F.col("depth") + 1).alias("below"), F.col("prefix").alias("parent"))
        same = (F.col("depth") == F.col("below")) & (F.shiftright("prefix", 1) == F.col("parent"))
        shards = fitting.join(parents, same, "left_anti").select("depth", "prefix", "bytes", "rows")
        found = shards if found is None else found.unionByName(shards)
        too_large = sums.where(~F.col("fits") & (F.col("depth") == high - 1)).select(F.col("prefix").alias("cell"))
        if too_large.isEmpty():
            return found
        if high <= 2 * STEP_BITS:  # at most 2^15 prefixes
            too_large = F.broadcast(too_large)
        inside = open_cells.withColumn("cell", prefix(F.col("bits"), high - 1)).join(too_large, "cell", "left_semi")
        open_cells = checkpoint(inside.select("bits", "bytes", "rows"))
        low = high


def entries(shards: DataFrame, n_shards: int) -> tuple[DataFrame, int]:
    """The directory as it is looked up, and its level: (entry, depth, prefix, bytes, rows).

    It has an entry for each value of the first ``level`` bits, about as many as
    there are shards.  A shard of fewer bits stands under several entries, one of
    more bits beside others under one; so it has at most twice as many rows as shards."""
    level = max(0, n_shards.bit_length() - 1)
    less = F.greatest(F.col("depth") - level, F.lit(0))
    more = F.greatest(F.lit(level) - F.col("depth"), F.lit(0))
    first = F.call_function("shiftright", "prefix", less)
    values = F.sequence(F.call_function("shiftleft", first, more), F.call_function("shiftleft", first + 1, more) - 1)
    return shards.select(F.explode(values).alias("entry"), "depth", "prefix", "bytes", "rows"), level


def shard(
    docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, shard_id, depth, shard_bytes, shard_rows) for every row.

    ``shard_id`` is the bucket's prefix as a string of ``depth`` bits (the
    empty string while one shard holds all).  The key is id and text; null
    texts have 0 bytes and, like null ids, a place of their own; an empty table
    has no shards.  Extra columns are not read.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    mark = F.when(col(text_col).isNull(), F.lit("n")).otherwise(F.lit("t"))
    key = F.concat_ws("|", F.coalesce(col(id_col).cast("string"), F.lit("")), mark, F.md5(text))
    rows = docs.select(
        col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), hash_bits(key).alias("bits")
    )
    # Repeats of one row, alike in all that is returned, are counted before the
    # shuffle.  Those too large for a shard are numbered after it, the rest stay counted.
    grouped = rows.groupBy("id", "n_bytes", "bits").agg(F.count(F.lit(1)).alias("n"))
    crowded = (F.col("n") > 1) & (F.col("n") * F.col("n_bytes") > limit)
    numbered = F.concat_ws("|", F.col("bits").cast("string"), F.col("number").cast("string"))
    units = _numbered(grouped.withColumn("crowded", crowded), F.when(F.col("crowded"), F.col("n")).otherwise(F.lit(1)))
    units = checkpoint(
        units.select(
            "id",
            "n_bytes",
            F.when(F.col("crowded"), hash_bits(numbered)).otherwise(F.col("bits")).alias("bits"),
            F.when(F.col("crowded"), F.lit(1)).otherwise(F.col("n")).alias("n"),
        )
    )

    cells = units.select("bits", (F.col("n") * F.col("n_bytes")).alias("bytes"), F.col("n").alias("rows"))
    shards = checkpoint(directory(cells, limit))
    n_shards = shards.count()
    pointers, level = entries(shards, n_shards)
    if n_shards <= BROADCAST_SHARDS:
        pointers = F.broadcast(pointers)
    own = F.call_function("shiftright", "bits", F.lit(HASH_BITS) - F.col("depth")) == F.col("prefix")
    placed = units.withColumn("at", prefix(F.col("bits"), level)).join(pointers, (F.col("at") == F.col("entry")) & own)
    binary = F.lpad(F.bin("bits"), HASH_BITS, "0")
    return _numbered(placed, F.col("n")).select(
        "id",
        "n_bytes",
        F.substring(binary, F.lit(1), F.col("depth")).alias("shard_id"),
        "depth",
        F.col("bytes").alias("shard_bytes"),
        F.col("rows").alias("shard_rows"),
    )


def _numbered(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` times, with its ``number`` from 0, made in chunks."""
    chunk, last = F.col("chunk") * _CHUNK, times - 1
    chunks = df.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor(last / _CHUNK))))
    return chunks.withColumn("number", F.explode(F.sequence(chunk, F.least(chunk + (_CHUNK - 1), last))))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, shard_id, depth and the shard's bytes and rows, for every document."""
    placed = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.withColumnRenamed("id", "doc_id").withColumn("depth", F.col("depth").cast("long"))


# The tables hold no row over and over beyond the limit, so the numbering of
# repeats is left to the tests.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''),
           CASE WHEN text IS NULL THEN 'n' ELSE 't' END, md5(coalesce(text, '')))), 1, {HASH_BITS // 4}) AS BIGINT) AS bits
  FROM documents),
s AS (SELECT depth, bits >> ({HASH_BITS} - depth) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS bytes, count(*) AS rows
      FROM d, range(0, {HASH_BITS} + 1) AS r(depth) GROUP BY ALL),
p AS (SELECT d.doc_id, d.n_bytes, d.bits, min(s.depth) AS depth
      FROM (SELECT row_number() OVER () AS r, * FROM d) AS d JOIN s ON s.prefix = d.bits >> ({HASH_BITS} - s.depth)
      WHERE s.bytes <= {SHARD_BYTES} OR s.depth = {HASH_BITS} GROUP BY d.r, d.doc_id, d.n_bytes, d.bits)
SELECT p.doc_id, p.n_bytes,
       substr(lpad(format('{{:b}}', p.bits), {HASH_BITS}, '0'), 1, CAST(p.depth AS INTEGER)) AS shard_id,
       p.depth, s.bytes AS shard_bytes, s.rows AS shard_rows
FROM p JOIN s ON s.depth = p.depth AND s.prefix = p.bits >> ({HASH_BITS} - p.depth)
"""
