"""Prefix trie over rebuilt conversations (operator 12).

Whole-sequence collapse: conversations with the same rebuilt turns become one
weighted sequence with the list of its conversations; sequences that are a
proper prefix of another are dropped by an anti-join, which leaves the leaves;
the weighted prefixes of the distinct sequences are then aggregated into nodes.

A prefix is known by its depth and the sum of 128-bit hashes (four 32-bit
lanes) of its (depth, role, text), so prefixes of a conversation are running
sums.  Rows are ordered by ranges, and every running sum has two levels (blocks
of at most 4,096 turns, then blocks), so a conversation of any length is spread
over tasks.  Texts are shuffled once, for the order.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, materialize

SHARED_EVERY = 5     # conversation c starts like c - c % 5
SHARED_TURNS = 9     # by its first crc32(c) % 9 turns
_BLOCK_BITS = 12
_LANES = ("l0", "l1", "l2", "l3")
ROOT = "root"


def head_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % SHARED_TURNS


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_hash, bytes): turns numbered from 1 by (turn, null first; role; text).

    The order is a range shuffle; ``pos`` follows from the row's number in its
    range and the rows of the conversation in earlier ranges.
    """
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"))  # repeated rows need not share a range
    placed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv_id", F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("turn_hash"),
        F.octet_length("text").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("at")), "trie_turns")
    placed = placed.withColumn("range", F.shiftright("at", 33))
    ranges = placed.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("conv_id", "range", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    return placed.join(ranges, ["conv_id", "range"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("earlier") + 1).alias("pos"), "turn_hash", "bytes")


def rebuild(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, turn_hash, bytes) of every rebuilt conversation, with a row of depth 0 for its (empty) start."""
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = sizes.select("conv_id", "n", head_turns(F.col("conv_id")).alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % SHARED_EVERY).alias("source"))
    source = sizes.select(F.col("conv_id").alias("source"), F.col("n").alias("source_n"))
    convs = convs.join(source, "source", "left").select(
        "conv_id", "source", "h", F.least("h", F.coalesce("source_n", F.lit(0))).alias("shared"))
    heads = turns.where(F.col("pos") < SHARED_TURNS).withColumnRenamed("conv_id", "source")
    heads = heads.join(convs, "source").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "turn_hash", "bytes")
    own = turns.join(convs, "conv_id").where("pos > h").select(
        "conv_id", (F.col("shared") + F.col("pos") - F.col("h")).alias("depth"), "turn_hash", "bytes")
    starts = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("turn_hash"),
                          F.lit(0).cast("long").alias("bytes"))
    return heads.unionByName(own).unionByName(starts)


def _node(depth: Column, lanes: list[Column]) -> Column:
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.md5(F.concat_ws(".", depth, *lanes)))


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, bytes, before): the prefix ending at each turn and the bytes before that turn."""
    mixed = F.md5(F.concat_ws(":", "depth", "turn_hash"))
    lane = [F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.conv(F.substring(mixed, 1 + 8 * i, 8), 16, 10).cast("long"))
            for i in range(4)]
    rows = rebuilt.select("conv_id", "depth", "bytes", F.shiftright("depth", _BLOCK_BITS).alias("block"),
                          *[e.alias(n) for e, n in zip(lane, _LANES)])
    summed = ("bytes", *_LANES)
    inside = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in summed])
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_earlier") for c in summed])
    run = rows.select("conv_id", "block", "depth", *summed, *[F.sum(c).over(inside).alias(f"{c}_run") for c in summed])
    run = run.join(blocks, ["conv_id", "block"])
    total = {c: F.col(f"{c}_run") + F.col(f"{c}_earlier") for c in summed}
    return run.select(
        "conv_id", "depth", "bytes", (total["bytes"] - F.col("bytes")).alias("before"),
        _node(F.col("depth"), [total[c] for c in _LANES]).alias("node"),
        F.when(F.col("depth") > 0, _node(F.col("depth") - 1, [total[c] - F.col(c) for c in _LANES])).alias("parent"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, conv_id) -> (node, ends_sha256): SHA-256 of the ids, ascending, comma-joined.

    Ids are ordered by ranges and joined in runs of at most 4,096; a node's
    runs then stream through one hash (SHA-256 takes its input in order), in
    constant memory.
    """
    keys = ("node", "conv_id")
    runs = (ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select(*keys, F.shiftright(F.monotonically_increasing_id(), _BLOCK_BITS).alias("run"))
            .groupBy("node", "run").agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    bound_batches(ends.sparkSession)

    def run(batches):
        node, state = None, None
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if name == node:
                    state.update(b",")
                else:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = name, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    return (runs.repartition("node").sortWithinPartitions("node", "run").select("node", "ids")
            .mapInArrow(run, "node string, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The text of a node of depth d is the d-th rebuilt turn of conversation
    conv_id.  Null roles and texts are empty, null turns first, equal turns
    ordered by role and text; repeated rows are turns of their own; rows with
    a null conv_id belong to no conversation; other columns are ignored; an
    empty table gives no rows (no root either).

    Bytes saved in a subtree are summed without visiting it: each sequence adds
    its weight times its bytes from the node on, and each leaf takes off, once,
    the bytes of those nodes it owns (is the least leaf of).
    """
    p = materialize(prefixes(rebuild(materialize(positions(conversations), "trie_positions"))), "trie_prefixes")
    last = p.groupBy("conv_id").agg(F.max_by("node", "depth").alias("end"), F.sum("bytes").alias("total"))
    last = materialize(last, "trie_ends")
    sequences = last.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.max("total").alias("total"))
    paths = materialize(p.join(sequences, "conv_id"), "trie_paths")
    inner = paths.where("node <> end").select(F.col("node").alias("end")).distinct()
    leaves = sequences.join(inner, "end", "left_anti").select("conv_id")
    least = (paths.join(leaves, "conv_id").groupBy("node", "before").agg(F.min("conv_id").alias("conv_id")))
    owned = least.groupBy("conv_id").agg(F.min("before").alias("owned_from"))  # a leaf owns the tail of its path
    weight, total, before = F.col("weight"), F.col("total"), F.col("before")
    nodes = materialize(
        paths.join(owned, "conv_id", "left").groupBy("node", "parent", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.count("owned_from").alias("n_leaves"),
            (F.sum(weight * (total - before))
             - F.sum(F.when(F.col("owned_from").isNotNull(), total - F.greatest("before", "owned_from")).otherwise(0)))
            .alias("saved_tokens")), "trie_nodes")
    children = nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    digests = end_digests(last.select(F.col("end").alias("node"), "conv_id"))
    zero = F.lit(0).cast("long")
    return (nodes.join(children.withColumnRenamed("parent", "node"), "node", "left")
            .join(digests, "node", "left").join(above, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
                    "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
