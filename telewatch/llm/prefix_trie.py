"""The trie of conversation prefixes, with count-min screening.

A node is a distinct sequence of first turns (role, text).  Turns become 128-bit
hashes in one pass; the texts go no further.  A prefix is the exclusive-or of the
hashes of (place, turn) of its turns, so prefixes of one long conversation are
hashed block by block in many tasks.

Screening: a count-min sketch counts all prefixes.  An estimate of one proves that
no other conversation has the prefix, so it and all longer ones are nodes of one
member that are written where they stand: the tails.  Only prefixes that the
sketch cannot clear, and each tail's first node, are shuffled, and grouped
exactly.  The sketch is sized by the number of prefixes up to 16 M cells a row
(48 MB); beyond that a fuller sketch clears fewer tails, which costs shuffling
and changes no result.

Sums over a node's subtree need no walk over levels.  A node's figure belongs to
its smallest member; along that conversation the figures of deeper nodes are
added up from the end, and a node sums what its members bring.  So a deep trie
takes no more rounds than a flat one, and a node that a third of all
conversations share is a partial aggregate like any other.

Order of turns: by turn (null first), then role, then the hashes of the text;
repeated rows are turns of their own.  Rows without a conversation id belong to
no conversation and are left out.  An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telewatch.llm import countmin
from telewatch.llm.common import col, stored, table

FAMILY = 20  # conversations c - c % FAMILY lend their first turns
MOST_SHARED = 3
BLOCK = 4096  # turns of a conversation that one task takes at a time
SKETCH_ROWS = 3
MOST_CELLS = 1 << 24  # of a row of the sketch
WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def _hashes(first: int, *columns: Column) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(F.lit(first + k), *columns) for k in (0, 1)]


def ordered_turns(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, part, at, a, b, words), written once: every turn's hashes and words,
    ``at`` ascending with the order of turns within a conversation and ``part``.

    The rows are dealt by ranges of (conversation, turn, ...), so one very long
    conversation fills many tasks."""
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    a, b = _hashes(1, role, text)
    turns = conversations.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv"),
        col(turn_col).alias("turn"),
        role.alias("role"),
        a.alias("a"),
        b.alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["conv", "turn", "role", "a", "b"]
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(
        turns.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "a", "b", "words"),
        "trie-turns",
    )


def _spans(turns: DataFrame) -> DataFrame:
    """A conversation's rows of each part: where they start and what came before."""
    spans = turns.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")))


def _position() -> Column:
    return F.col("at") - F.col("first") + F.col("before") + 1


def positions(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns as they are: rows (conv, d, a, b, words, length) and (conv, length)."""
    spans = _spans(turns)
    lengths = spans.groupBy("conv").agg(F.sum("size").alias("length"))
    rows = turns.join(spans.join(lengths, "conv"), ["conv", "part"])
    return rows.select("conv", _position().alias("d"), "a", "b", "words", "length"), lengths


def rebuilt(turns: DataFrame, family: int = FAMILY, most_shared: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations with lent beginnings, in the form of :func:`positions`.

    Conversation c takes the first h turns of c - c % family (fewer if it has
    fewer), then its own after the first h; h = crc32(decimal c) % (most_shared
    + 1).  At most ``family`` conversations borrow from one."""
    spans = _spans(turns)
    lenders = turns.where(F.col("conv") % family == 0).join(spans, ["conv", "part"]).withColumn("d", _position())
    heads = lenders.where(F.col("d") <= most_shared).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("d", "a", "b", "words"))).alias("head")  # most_shared at most
    )
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % (most_shared + 1)
    convs = spans.groupBy("conv").agg(F.sum("size").alias("own")).withColumn("h", h)
    convs = convs.withColumn("lender", F.col("conv") - F.col("conv") % family)
    convs = convs.join(heads.withColumnRenamed("conv", "lender"), "lender", "left").drop("lender")
    lent = F.least(F.col("h"), F.coalesce(F.size("head"), F.lit(0)).cast("long"))
    convs = convs.withColumn("lent", lent).withColumn(
        "length", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("long"))
    )
    borrowed = convs.where("lent > 0").select("conv", "length", F.explode(F.slice("head", F.lit(1), F.col("lent").cast("int"))).alias("t"))
    borrowed = borrowed.select("conv", "t.d", "t.a", "t.b", "t.words", "length")
    own = turns.join(spans.join(convs.drop("head", "own"), "conv"), ["conv", "part"]).withColumn("d", _position())
    own = own.where(F.col("d") > F.col("h")).withColumn("d", F.col("d") - F.col("h") + F.col("lent"))
    return borrowed.unionByName(own.select("conv", "d", "a", "b", "words", "length")), convs.select("conv", "length")


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, d, words, last, pa, pb, before_a, before_b), written once: the hash of
    the first d turns, and of the first d - 1."""
    a, b = _hashes(3, F.col("d"), F.col("a"), F.col("b"))
    rows = rows.select(
        "conv", "d", "words", (F.col("d") == F.col("length")).alias("last"), a.alias("a"), b.alias("b"),
        F.floor((F.col("d") - 1) / BLOCK).alias("block"),
    )
    upto = Window.partitionBy("conv", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("a").alias("sum_a"), F.bit_xor("b").alias("sum_b"))
    blocks = blocks.select("conv", "block", *[F.bit_xor(f"sum_{x}").over(earlier).alias(f"from_{x}") for x in "ab"])
    blocks = blocks.where("block > 0")
    whole = rows.select("*", *[F.bit_xor(x).over(upto).alias(f"in_{x}") for x in "ab"]).join(blocks, ["conv", "block"], "left")
    whole = whole.select(
        "*", *[F.col(f"in_{x}").bitwiseXOR(F.coalesce(f"from_{x}", F.lit(0).cast("long"))).alias(f"p{x}") for x in "ab"]
    )
    return stored(
        whole.select(
            "conv", "d", "words", "last", "pa", "pb", *[F.col(f"p{x}").bitwiseXOR(F.col(x)).alias(f"before_{x}") for x in "ab"]
        ),
        "trie-prefixes",
    )


def _key(batch: pa.RecordBatch, first: str, second: str) -> np.ndarray:
    a, b = (batch.column(batch.schema.get_field_index(c)).to_numpy().view(np.uint64) for c in (first, second))
    return a ^ (b * np.uint64(0x9FB21C651E98DF25))


def screened(rows: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """``rows`` with ``alone`` and ``alone_before``: the sketch proves that no other
    conversation has the prefix, or the one before it (never so for the root)."""
    width = countmin.width_for(2 * rows.count(), most=most_cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = countmin.Counter(width, SKETCH_ROWS, 2)
        for batch in batches:
            counter.add(_key(batch, "pa", "pb"))
        yield from counter.partials()

    sketch = countmin.merged(rows.select("pa", "pb").mapInArrow(count, countmin.PARTIAL), width, SKETCH_ROWS, 2)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = countmin.opened(sketch.value, SKETCH_ROWS)
        for batch in batches:
            alone = countmin.estimate(counts, _key(batch, "pa", "pb")) == 1
            before = countmin.estimate(counts, _key(batch, "before_a", "before_b")) == 1
            before &= batch.column(batch.schema.get_field_index("d")).to_numpy() > 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(alone), pa.array(before)], [*batch.schema.names, "alone", "alone_before"]
            )

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return stored(rows.mapInArrow(look, f"{schema}, alone boolean, alone_before boolean"), "trie-screened")


def _digest(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of (conv_id, depth, conv): the ids of a node's
    members in order, hashed as one text.

    Ranges of ids become pieces of text in many tasks, one for a node's ids in an
    Arrow batch; a node's pieces then pass through one hash, a piece at a time."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "depth", "conv"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, depth, conv = (c.to_numpy() for c in batch.columns)
            change = np.flatnonzero((owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])) + 1
            cuts = np.unique(np.concatenate(([0], change, [owner.size])))
            starts, ends = cuts[:-1], cuts[1:]
            texts = [",".join(map(str, conv[s:e].tolist())) for s, e in zip(starts, ends, strict=True)]
            columns = [pa.array(x[starts]) for x in (owner, depth, conv)] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*order, "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()

        def done() -> pa.RecordBatch:
            values = [[node[0]], [node[1]], [state.hexdigest()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, (pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["conv_id", "depth", "ends_sha256"],
            )

        for batch in batches:
            for owner, depth, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (owner, depth) != node:
                    if node is not None:
                        yield done()
                    node, state = (owner, depth), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if node is not None:
            yield done()

    texts = rows.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        pieces, "conv_id long, depth long, conv long, ids string"
    )
    texts = texts.repartition(parts, "conv_id", "depth").sortWithinPartitions(*order)
    return texts.mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string")


def _along(rows: DataFrame) -> DataFrame:
    """What a row needs of the others of its conversation: ``parent`` (the smallest
    member of the node above), ``child`` (of the node below), and ``saved_below``
    and ``leaves_below``, sums from this row to the conversation's end.

    Blocks of a conversation are summed apart and meet by their totals."""
    rows = rows.withColumn("block", F.floor((F.col("d") - 1) / BLOCK))
    rows = rows.withColumn("saved", F.when(F.col("least") == F.col("conv"), (F.col("n") - 1) * F.col("words")).otherwise(F.lit(0).cast("long")))
    rows = rows.withColumn(
        "leaf", (F.col("last") & (F.col("ends") == F.col("n")) & (F.col("least") == F.col("conv"))).cast("long")
    )
    inside = Window.partitionBy("conv", "block").orderBy("d")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = Window.partitionBy("conv", "block")
    blocks = rows.groupBy("conv", "block").agg(
        F.sum("saved").alias("b_saved"),
        F.sum("leaf").alias("b_leaf"),
        F.min_by("least", "d").alias("b_first"),
        F.max_by("least", "d").alias("b_last"),
    )
    order = Window.partitionBy("conv").orderBy("block")
    reverse = Window.partitionBy("conv").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv",
        "block",
        F.sum("b_saved").over(reverse).alias("b_saved"),
        F.sum("b_leaf").over(reverse).alias("b_leaf"),
        F.lag("b_last").over(order).alias("b_parent"),
        F.lead("b_first").over(order).alias("b_child"),
    ).where("b_parent IS NOT NULL OR b_child IS NOT NULL")
    rows = rows.select(
        "*",
        F.lag("least").over(inside).alias("r_parent"),
        F.lead("least").over(inside).alias("r_child"),
        *[(F.sum(c).over(all_) - F.sum(c).over(upto) + F.col(c)).alias(f"r_{c}") for c in ("saved", "leaf")],
    )
    rows = rows.join(blocks, ["conv", "block"], "left")
    above = F.when(F.col("alone_before"), F.col("conv")).otherwise(F.coalesce("r_parent", "b_parent"))
    zero = F.lit(0).cast("long")
    return rows.select(
        "conv", "d", "kind", "last", "pa", "pb", "n", "least", "ends", "end", "words",
        above.alias("parent"),
        F.coalesce("r_child", "b_child").alias("child"),
        (F.col("r_saved") + F.coalesce("b_saved", zero)).alias("saved_below"),
        (F.col("r_leaf") + F.coalesce("b_leaf", zero)).alias("leaves_below"),
    )


def prefix_trie(rows: DataFrame, lengths: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """The nodes (columns of ``NODE`` and ``words``, the words of the node's last
    turn) of rows (conv, d, a, b, words, length) and conversations (conv, length),
    as :func:`positions` or :func:`rebuilt` give them.

    ``conv_id`` and ``depth`` are a node's key, ``parent_conv_id`` and ``depth - 1``
    its parent's."""
    lengths = stored(lengths.select("conv", "length"), "trie-lengths")
    (n_all, root) = lengths.agg(F.count(F.lit(1)), F.min("conv")).first()
    if not n_all:
        return rows.sparkSession.createDataFrame([], f"{NODE}, words long")
    looked = screened(prefixes(rows), most_cells)
    shared = looked.where(~F.col("alone"))
    # Stored, so that the join below meets two plain tables and a prefix that very
    # many conversations share can be split.
    groups = stored(
        shared.groupBy("pa", "pb").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("conv").alias("least"),
            F.count_if("last").alias("ends"),
            F.min(F.when(F.col("last"), F.col("conv"))).alias("end"),
        ),
        "trie-groups",
    )
    one = F.lit(1).cast("long")
    single = {"n": one, "least": F.col("conv"), "ends": F.col("last").cast("long"), "end": F.when(F.col("last"), F.col("conv"))}
    # The first node of each tail, and the last where it is another, for the leaves above.
    tails = looked.where(F.col("alone") & (~F.col("alone_before") | F.col("last"))).withColumns(single)
    kept = ["conv", "d", "words", "last", "pa", "pb", "alone_before", "n", "least", "ends", "end"]
    kind = F.when(F.col("alone_before"), F.lit("end")).otherwise(F.lit("tail"))
    line = shared.join(groups, ["pa", "pb"]).select(*kept, F.lit("shared").alias("kind"))
    line = stored(_along(line.unionByName(tails.select(*kept, kind.alias("kind")))), "trie-lines")

    def text_hash(c: Column) -> Column:
        return F.sha2(F.coalesce(c.cast("string"), F.lit("")), 256)

    parent = F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent"))
    members = line.where("kind = 'shared'")
    common = members.groupBy("pa", "pb").agg(
        F.min("least").alias("conv_id"),
        F.min("d").alias("depth"),
        F.min(F.when(F.col("conv") == F.col("least"), F.col("parent"))).alias("parent"),
        F.min("n").alias("n_convs"),
        F.count_if(F.col("child") == F.col("conv")).alias("n_children"),
        F.sum("leaves_below").alias("n_leaves"),
        F.sum("saved_below").alias("saved_tokens"),
        F.min("ends").alias("ends"),
        F.min("end").alias("end"),
        F.min("words").alias("words"),
    )
    many = members.where("last AND ends > 1").select(F.col("least").alias("conv_id"), F.col("d").alias("depth"), "conv")
    many = many.unionByName(lengths.where("length = 0").select(F.lit(root).alias("conv_id"), F.lit(0).cast("long").alias("depth"), "conv"))
    digests = stored(_digest(many), "trie-ends").withColumnRenamed("ends_sha256", "many_sha256")
    common = common.join(digests, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("many_sha256", text_hash(F.col("end"))).alias("ends_sha256"), "words",
    )
    zero = F.lit(0).cast("long")

    def alone(df: DataFrame, above: Column) -> DataFrame:
        return df.select(
            F.col("conv").alias("conv_id"), F.col("d").alias("depth"), above.alias("parent_conv_id"), one.alias("n_convs"),
            F.when(F.col("last"), zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
            text_hash(F.when(F.col("last"), F.col("conv"))).alias("ends_sha256"), "words",
        )

    starts = alone(line.where("kind = 'tail'"), F.when(F.col("d") == 1, F.lit(root)).otherwise(F.col("parent")))
    rest = alone(looked.where("alone AND alone_before"), F.col("conv"))
    nodes = stored(common.unionByName(starts).unionByName(rest), "trie-nodes")
    top = nodes.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"),
        F.greatest(F.count_if(F.col("n_children") == 0), one).alias("n_leaves"),
        F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("words")), zero).alias("saved_tokens"),
    )
    turnless = digests.where("depth = 0").first()  # one row at most
    top = top.select(
        F.lit(root).alias("conv_id"), zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(n_all).alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.lit(turnless.many_sha256 if turnless else _EMPTY).alias("ends_sha256"), zero.alias("words"),
    )
    return nodes.unionByName(top)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns for every node of the rebuilt ``conversations``."""
    rows, lengths = rebuilt(ordered_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie(rows, lengths).drop("words")
