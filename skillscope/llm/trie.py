r"""Prefix trie of conversations by Spark SQL's ROLLUP over positional turn-id columns.

A turn's id is a 128-bit digest of its role and text. A block holds the ids of ``width`` consecutive turns
as columns t1, t2, ...; ``GROUP BY prior, ROLLUP (t1, t2, ...)`` aggregates all its prefixes together, and
``grouping_id`` tells each one's depth. ``prior`` is the key of the node at which the block begins (a digest
of all ids on the way from the root), so a conversation that is longer goes on in a further block. Only
conversations that share the node with others do; what is left of one that is alone is a chain of nodes
with one member each, and needs no aggregation. So the number of blocks follows the longest shared prefix.

Sums over subtrees need no walk along the tree. A node belongs to its smallest member, and a member's own nodes
are the deepest ones of its path; hence the sum over a subtree is the sum of all members' own nodes, less
those of the smallest member that lie above. It comes from a second ROLLUP.

Groups: all counts are combined before the shuffle; a conversation is cut into blocks, and its places come from
a global sort, so neither a long conversation nor a common first turn gathers in one task. The ids
that end in a node are joined to text in chunks of ``CHUNK``, and hashed as a stream.

Defined results: null roles and texts count as empty. Turns are ordered by their number, null first; rows
of one number by the digest of role and text, and repeated rows stay. Rows without a ``conv_id`` belong to no
conversation and are left out. An empty table gives no rows. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import ship
from skillscope.llm.words import word_count

WIDTHS = (8, 16, 32)  # turns of a block; the last width holds for all further blocks
CHUNK = 4096
ROOT = hashlib.md5(b"").digest()
FAMILY, HEADS = 20, 4


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value))


def numbered_turns(scratch: Scratch, conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn): every turn's place from 0, and its id and words; texts are not shuffled.

    A global sort deals long conversations out to several tasks; what each task holds of a conversation is
    counted, and the counts of the tasks before are added.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string").cast("binary")
    turn = F.struct(_digest(F.concat(size, F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary"))).alias("id"),
                    word_count(text).alias("words"))
    order = ["conv_id", "number", "turn"]
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("number"), turn.alias("turn"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.keep(rows.withColumn("at", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("task", F.shiftright("at", 33))
    spans = rows.groupBy("conv_id", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    placed = rows.join(spans, ["conv_id", "task"])
    placed = scratch.keep(placed.select("conv_id", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "turn"), "turns")
    scratch.drop("sorted")
    return placed


def graft_heads(scratch: Scratch, turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns whose first h places are those of the family's first conversation, and all (conv_id, n_turns).

    h = crc32(decimal conv_id) modulo ``heads``; the family's first is conv_id - conv_id % ``family``.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("pos") < heads - 1)).groupBy(
        F.col("conv_id").alias("first")).agg(F.sort_array(F.collect_list(F.struct("pos", "turn"))).alias("head"))
    convs = convs.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("first"), "left")
    head = F.slice(F.coalesce("head", F.array().cast(first.schema["head"].dataType)), F.lit(1), F.col("h").cast("int"))
    convs = convs.select("conv_id", "own", "h", head.alias("head"))
    convs = scratch.keep(convs.withColumn("n_turns", F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "convs")
    given = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.turn")
    shift = convs.select("conv_id", "h", F.size("head").alias("given"))
    own = turns.join(shift, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "turn")
    return scratch.keep(given.unionByName(own), "grafted"), convs.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"))


def _block(turns: DataFrame, members: DataFrame, start: int, width: int) -> DataFrame:
    """(prior, conv_id, n_turns, t1 ... t_width) of members (prior, conv_id, n_turns)."""
    here = turns.where(F.col("pos").between(start, start + width - 1)).groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "turn"))), lambda t: t["turn"]).alias("ts"))  # of width at most
    rows = members.join(here, "conv_id", "left")
    return rows.select("prior", "conv_id", "n_turns", *[F.get("ts", F.lit(i)).alias(f"t{i + 1}") for i in range(width)])


def _ids(width: int, base: str = "prior") -> Column:
    """The node's key and the ids below it, one after the other."""
    return F.concat(F.col(base), *[F.coalesce(F.col(f"t{i + 1}.id"), F.lit(b"")) for i in range(width)])


def _prefixes(block: DataFrame, start: int, width: int, aggregates: str) -> DataFrame:
    """A row per prefix of the block's turns: key, parent, depth, n_words of its last turn, and the aggregates."""
    names = [f"t{i + 1}" for i in range(width)]
    listed = ", ".join(names)
    rolled = block.sparkSession.sql(
        f"SELECT prior, {listed}, {width} - bit_count(grouping_id()) AS deep, {aggregates} "
        f"FROM {{block}} GROUP BY prior, ROLLUP ({listed})", block=block)
    # A conversation that ends inside the block has no turns beyond; those are no prefixes.
    last = reduce(lambda rest, i: F.when(F.col("deep") == i + 1, F.col(f"t{i + 1}")).otherwise(rest), range(width), F.lit(None))
    kept = rolled.withColumn("last", last).where("deep = 0 OR last IS NOT NULL")
    ids = _ids(width)
    above = F.when(F.col("deep") > 1, _digest(F.substring(ids, F.lit(1), F.octet_length(ids) - 16))).when(F.col("deep") == 1, F.col("prior"))
    rest = [c for c in rolled.columns if c not in ("prior", "deep", *names)]
    return kept.select(F.when(F.col("deep") > 0, _digest(ids)).otherwise(F.col("prior")).alias("key"), above.alias("parent"),
                       (F.col("deep") + start).cast("long").alias("depth"), F.coalesce("last.words", F.lit(0)).alias("n_words"), *rest)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's chunks, joined by commas, as they come."""
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    keys, digests = [], []
    for key, chunks in itertools.groupby(rows(), key=lambda r: r[0]):
        whole = hashlib.sha256()
        for i, (_, chunk) in enumerate(chunks):
            whole.update(f",{chunk}".encode() if i else chunk.encode())
        keys.append(key)
        digests.append(whole.hexdigest())
        if len(keys) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
            keys, digests = [], []
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv_id)."""
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ends.groupBy("key", F.floor(F.col("conv_id") / F.lit(CHUNK)).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))
    chunks = chunks.repartition("key").sortWithinPartitions("key", "chunk")
    return chunks.select("key", "ids").mapInArrow(_hash_ends, "key binary, ends_sha256 string")


def prefix_trie(scratch: Scratch, turns: DataFrame, convs: DataFrame, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """A row per node, from ``turns`` (conv_id, pos, turn) and all conversations (conv_id, n_turns), both stored.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (words of
    turns that further members repeat, over the subtree) and ends_sha256 (of the members that end here).
    """
    ship()
    spark = scratch.spark
    members = convs.select(F.lit(ROOT).alias("prior"), "conv_id", "n_turns")
    blocks, nodes, ends, alone = [], [], [], []
    start = 0
    while True:
        width = widths[min(len(blocks), len(widths) - 1)]
        stop, label = start + width, len(blocks)
        block = scratch.keep(_block(turns, members, start, width), f"block-{label}")
        found = scratch.keep(_prefixes(block, start, width, "min(conv_id) AS conv_id, count(1) AS n_convs, max(n_turns) AS longest"), f"prefixes-{label}")
        blocks.append((block, start, width))
        nodes.append(found.where(F.col("depth") > start) if start else found)
        key = F.when(F.col("n_turns") > start, _digest(_ids(width))).otherwise(F.col("prior"))
        ends.append(block.where(F.col("n_turns") <= stop).select(key.alias("key"), "conv_id"))
        longer = block.where(F.col("n_turns") > stop).select(key.alias("key"), "conv_id", "n_turns")
        shared = found.where((F.col("depth") == stop) & (F.col("longest") > stop)).select("key", (F.col("n_convs") > 1).alias("shared"))
        longer = scratch.keep(longer.join(shared, "key"), f"longer-{label}")
        alone.append(longer.where("NOT shared").select("key", "conv_id", "n_turns", F.lit(stop).cast("long").alias("from")))
        members = longer.where("shared").select(F.col("key").alias("prior"), "conv_id", "n_turns")
        start = stop
        if not members.limit(1).count():
            break
    nodes = scratch.keep(reduce(DataFrame.unionByName, nodes), "nodes")
    alone = reduce(DataFrame.unionByName, alone)

    # What each conversation's own nodes add to every node that it is a member of.
    saved = (F.col("n_convs") - 1) * F.col("n_words")
    is_leaf = (F.col("longest") == F.col("depth")).cast("long")
    own = nodes.groupBy("conv_id").agg(F.sum(saved).alias("saved"), F.sum(is_leaf).alias("leaves"))
    own = own.unionByName(alone.select("conv_id", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves")))
    own = own.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).where("saved > 0 OR leaves > 0")
    own = scratch.keep(own, "own")
    sums = [_prefixes(block.join(own, "conv_id"), at, width, "sum(saved) AS saved, sum(leaves) AS n_leaves") for block, at, width in blocks]
    sums = [s.where(F.col("depth") > at) if at else s for s, (_, at, _) in zip(sums, blocks, strict=True)]
    sums = reduce(DataFrame.unionByName, sums).select("key", "saved", "n_leaves")
    children = nodes.select("parent").unionAll(alone.select("key")).where("parent IS NOT NULL").groupBy(
        F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    earlier = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = nodes.withColumn("earlier", F.coalesce(F.sum(saved).over(earlier), F.lit(0)))
    rows = rows.join(sums, "key", "left").join(children, "key", "left").join(above, "parent", "left")
    rows = rows.join(_end_digests(reduce(DataFrame.unionByName, ends)), "key", "left")
    nobody = F.sha2(F.lit(""), 256)
    rows = rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (F.col("saved") - F.col("earlier")).alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"))
    is_end = F.col("depth") == F.col("n_turns")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    chains = alone.select("conv_id", "n_turns", F.explode(F.sequence(F.col("from") + 1, F.col("n_turns"))).alias("depth")).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(is_end, none).otherwise(one).alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(is_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nobody).alias("ends_sha256"))
    return rows.unionByName(chains)


def conversation_trie(conversations: DataFrame, family: int | None = FAMILY, heads: int = HEADS) -> DataFrame:
    """The trie of all conversations, with the heads of their families grafted on unless ``family`` is None."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = numbered_turns(scratch, conversations)
    if family:
        turns, convs = graft_heads(scratch, turns, family, heads)
    else:
        convs = scratch.keep(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns")), "convs")
    return prefix_trie(scratch, turns, convs)
