"""Prefix trie of conversations that share their first turns, built from whole sequences.

Equal conversations collapse into one weighted sequence with the list of those that end there; a sequence that is a
proper prefix of another is an inner node, the others are leaves; the prefixes of the weighted sequences, added up, are
the nodes. Texts are never shuffled: after the scan a turn is a digest and a length.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedweave.session import scratch, stage

FAMILY = 100  # conversations share the first turns of the one whose id ends the range
HEADS = 6  # of 0 to 5 turns
ROOT = hashlib.sha256(b"").digest()[:16]
ENDS_CHUNK = 512  # ids of an end list that are joined to one text before the lists are put together

STEPS = "conv_id long, depth long, node binary, parent binary, chars long, ends boolean"


def shared_head(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its family."""
    return zlib.crc32(str(conv_id).encode()) % HEADS


def turn_digests(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, chars``; rows without a conversation id are left out, null role or text is empty."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    both = F.concat_ws("\n", F.char_length(role).cast("string"), role, text)
    return turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.substring(F.unhex(F.sha2(both, 256)), 1, 16).alias("digest"), F.char_length(text).cast("long").alias("chars"))


def _rebuild(batches):
    """Prefixes of every conversation, from turns sorted by family, the family's first conversation before the others.

    Holds the first turns of one family and the digest of one prefix, however long conversations are.
    """
    out: list[tuple] = []
    family = conv = None
    head: list[tuple[bytes, int]] = []
    own = depth = shared = 0
    node = ROOT

    def put(digest: bytes, chars: int) -> None:
        nonlocal node, depth
        above, node = node, hashlib.sha256(node + digest).digest()[:16]
        depth += 1
        out.append((conv, depth, node, above, chars, False))

    def ended() -> None:
        if conv is not None:
            out[-1] = (*out[-1][:-1], True)

    def start(new: int) -> None:
        nonlocal conv, own, depth, node, shared
        ended()
        conv, own, depth, node, shared = new, 0, 0, ROOT, shared_head(new)
        out.append((conv, 0, ROOT, None, 0, False))
        if conv != family:
            for x in head[:shared]:
                put(*x)

    def flushed():
        columns = list(zip(*out))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["conv_id", "depth", "node", "parent", "chars", "ends"])

    for batch in batches:
        for base, this, digest, chars in zip(*(c.to_pylist() for c in batch.columns)):
            if base != family:
                family, head = base, []
            if this != conv:
                start(this)
            own += 1
            if this == family:
                if own < HEADS:
                    head.append((digest, chars))
                put(digest, chars)
            elif own > shared:
                put(digest, chars)
            # The newest row waits until it is known whether its conversation goes on.
            if len(out) > 10_000:
                last = out.pop()
                yield flushed()
                out.append(last)
    ended()
    if out:
        yield flushed()


def prefixes(turns: DataFrame) -> DataFrame:
    """A row for each prefix of each rebuilt conversation, the empty one included: ``conv_id, depth, node`` (digest of
    the prefix), ``parent``, ``chars`` of its last turn, ``ends`` (whether it is the whole conversation).

    Turns are in the order of ``turn``, null first; turns of equal number are ordered by a digest of role and text.
    Every conversation takes its first turns, as many as a hash of its id says, from the first conversation of its
    family and goes on with its own turns after as many. A family passes through one task as a stream.
    """
    id_ = F.col("conv_id")
    keyed = turn_digests(turns).withColumn("family", id_ - id_ % FAMILY)
    dealt = keyed.repartition("family").sortWithinPartitions(
        "family", F.when(id_ == F.col("family"), 0).otherwise(1), "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return dealt.select("family", "conv_id", "digest", "chars").mapInArrow(_rebuild, STEPS)


def end_lists(sequence_ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of rows ``node, conv_id``: SHA-256 of the ids, ascending, joined by commas.

    Ids are sorted and joined in ranges, so one node's list spreads over tasks; the digest, which is sequential by
    definition, then reads a list as a stream of texts of at most 512 ids.
    """

    def joined(batches):
        node, first, ids = None, None, []
        for batch in batches:
            nodes, firsts, texts = [], [], []
            for this, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if this != node or len(ids) == ENDS_CHUNK:
                    if ids:
                        nodes.append(node), firsts.append(first), texts.append(",".join(ids))
                    node, first, ids = this, conv, []
                ids.append(str(conv))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()), pa.array(texts, pa.string())],
                                             names=["node", "first", "ids"])
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])],
                                             names=["node", "first", "ids"])

    def digested(batches):
        node, state = None, None
        for batch in batches:
            nodes, sums = [], []
            for this, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if this == node:
                    state.update(b",")
                else:
                    if state:
                        nodes.append(node), sums.append(state.hexdigest())
                    node, state = this, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], names=["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    ranged = sequence_ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    texts = ranged.mapInArrow(joined, "node binary, first long, ids string")
    streams = texts.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
    return streams.mapInArrow(digested, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (see ``prefixes``).

    ``conv_id`` its smallest member, ``depth``, ``parent_conv_id`` the parent's (null at the root), ``n_convs`` members,
    ``n_children``, ``n_leaves`` nodes without children in its subtree, ``saved_tokens`` over its subtree the members
    but one times the code points of the last text, ``ends_sha256`` of the ids of members that end here.

    No turns give no nodes, not even a root. Repeated rows are repeated turns. Columns other than ``conv_id, turn,
    role, text`` are not looked at.
    """
    spark = turns.sparkSession
    with scratch(spark, "trie") as folder:
        steps = stage(prefixes(turns), "steps", folder)
        ends = steps.filter("ends")
        # Equal conversations are one sequence from here on, known by its smallest conversation.
        sequences = stage(ends.groupBy("node").agg(F.min("conv_id").alias("rep"), F.count("*").alias("weight"),
                                                   F.max("depth").alias("length")), "sequences", folder)
        ids = end_lists(ends)
        paths = stage(steps.select(F.col("conv_id").alias("rep"), "depth", "node", "parent", "chars")
                      .join(sequences.select("rep", "weight", "length"), "rep"), "paths", folder)
        # What is the parent of a prefix is a proper prefix itself.
        inner = paths.filter("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
        leaves = sequences.join(inner, "node", "left_anti").select("rep", F.lit(1).alias("leaf"))
        nodes = stage(paths.groupBy("node").agg(
            F.min("rep").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"),
            F.min("chars").alias("chars"), F.sum("weight").alias("n_convs")), "nodes", folder)
        # A node is on the path of its smallest member, once: its own saving is counted there.
        own = nodes.select(F.col("conv_id").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("own"))
        below = Window.partitionBy("rep").orderBy(F.col("depth").desc())
        summed = (paths.select("rep", "depth", "node").join(own, ["rep", "depth"], "left").join(leaves, "rep", "left")
                  .withColumn("saved", F.sum(F.coalesce("own", F.lit(0))).over(below))
                  .groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.count("leaf").alias("n_leaves")))
        children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
        parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        none = hashlib.sha256(b"").hexdigest()
        found = (nodes.join(summed, "node").join(children, "node", "left").join(ids, "node", "left")
                 .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                 .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none))))
        above = nodes.filter("parent IS NOT NULL").select("node", "parent").join(parents, "parent").select("node", "parent_conv_id")
        out = found.join(above, "node", "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                       "saved_tokens", "ends_sha256")
        return stage(out, "trie-nodes")
