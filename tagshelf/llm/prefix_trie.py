"""Conversation prefix trie: what conversations share from their first turn on.

Conversations are cut into blocks of a fixed number of turns. A block's digest is chained to
that of the block before it, so that equal digests are equal histories, and conversations
are grouped by their blocks first. Only below a block whose successors differ are the
turns inside these looked at one by one; a block that has one successor only gives its turns
as nodes at once.

What a node's subtree holds is not summed up the tree, level by level, but from the
conversations: a node belongs to its smallest member, a conversation owns the last part of
its path, and all it passes before that is shared with a smaller one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..sources.scratch import materialize
from .common import ArrowFunction, by_value, text_or_empty

by_value(__name__)

# Turns of a block.
BLOCK = 4
# Bytes of a digest.
WIDTH = 16
ROOT = bytes(WIDTH)
# Ids of conversations that are put together in one row, at most.
LISTED = 10_000


def prefix_trie(turns: DataFrame, convs: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of all conversations of (conv_id, turn, role, text), a row each.

    A node of depth d is a distinct sequence of the first d turns (role and text) of some
    conversation; the root, of depth 0, is that of all. Its members are the conversations that
    begin with it. Returns conv_id (smallest member), depth, parent_conv_id (the parent's
    conv_id; NULL for the root), n_convs (members), n_children, n_leaves (nodes without children
    in its subtree, itself included), saved_tokens (over its subtree, each node's members but
    one times the code points of its last text) and ends_sha256 (of the members that end here:
    their decimal ids in ascending order, joined by commas).

    Turns are ordered by ``turn``, NULL first, those with one number by what they say. A NULL
    role or text is an empty one. Repeated rows are turns of their own. ``convs`` names
    conversations that count even without a turn (a column ``conv_id``, repeats do no harm).
    Rows without a ``conv_id`` belong to no conversation. No conversation, no node. Other columns
    are not read.

    Texts are hashed where they are read (128 bits of SHA-256) and don't move. The chain of
    digests of one conversation is computed by one task, which streams it.
    """
    blocks = materialize(_chained(turns, block))
    members = blocks.select("conv_id")
    if convs is not None:
        members = members.unionByName(convs.filter("conv_id is not null").select("conv_id"))
    members = members.distinct()
    ended = materialize(members.join(
        blocks.groupBy("conv_id").agg(F.max_by("id", "k").alias("id"), F.sum("chars").alias("chars")), "conv_id", "left"))

    kinds = materialize(_distinct_blocks(blocks))
    shape = materialize(_nodes(kinds, block, {"n_convs": F.col("n_convs")}))
    children = materialize(shape.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
                           .withColumnRenamed("parent", "id"))
    sums = _subtree_sums(blocks, ended, shape, children, block)
    nodes = _nodes(kinds.join(sums, "id"), block, {
        "n_convs": F.col("n_convs"), "n_leaves": F.col("n_leaves"),
        "saved_tokens": F.element_at(F.array(*[f"saved_{j}" for j in range(1, block + 1)]), F.col("j"))})
    nodes = materialize(nodes.select("id", "parent", "depth", "conv_id", "n_convs", "n_leaves", "saved_tokens"))
    return _completed(nodes.unionByName(_root(nodes, ended)), children, ended)


def _h(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 2 * WIDTH))


def _chained(turns: DataFrame, block: int) -> DataFrame:
    """(conv_id, k, parent, id, turns, lens, before, chars) of each block of each conversation.

    ``turns`` has the digests of its turns behind each other, ``lens`` the lengths of their texts;
    ``before`` is the length of all texts before the block.
    """
    role, text = text_or_empty("role"), text_or_empty("text")
    spoken = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    hashed = turns.filter("conv_id is not null").select(
        "conv_id", "turn", _h(F.encode(spoken, "UTF-8")).alias("said"), F.char_length(text).cast("long").alias("n"))
    ordered = hashed.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "said")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "said", "n").mapInArrow(_chain(block), (
        f"conv_id {kind}, k int, parent binary, id binary, turns binary, lens array<long>, before long, chars long"))


def digest(parent: bytes, turns: bytes) -> bytes:
    """The id of the node that is reached from ``parent`` by some turns."""
    return hashlib.sha256(parent + turns).digest()[:WIDTH]


def _chain(block: int) -> ArrowFunction:
    names = ["conv_id", "k", "parent", "id", "turns", "lens", "before", "chars"]

    def run(batches):
        conv = parent = None
        k = before = 0
        said, lens = [], []
        out = []

        def close():
            nonlocal parent, k, before, said, lens
            turns = b"".join(said)
            node = digest(parent, turns)
            out.append((conv, k, parent, node, turns, lens, before, sum(lens)))
            parent, k, before, said, lens = node, k + 1, before + sum(lens), [], []

        for batch in batches:
            kind = batch.schema.field(0).type
            for c, t, n in zip(*(column.to_pylist() for column in batch.columns)):
                if c != conv:
                    if said:
                        close()
                    conv, parent, k, before = c, ROOT, 0, 0
                said.append(t)
                lens.append(n)
                if len(said) == block:
                    close()
            if out:
                yield _batch(out, kind, names)
                out.clear()
        if said:
            close()
            yield _batch(out, kind, names)
    return run


def _batch(rows: list[tuple], kind: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = (kind, pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _distinct_blocks(blocks: DataFrame) -> DataFrame:
    """Each block once, with its members; ``split`` if it is not the only one below its parent."""
    kinds = blocks.groupBy("id").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        *[F.any_value(c).alias(c) for c in ("parent", "k", "turns", "lens")])
    kinds = materialize(kinds)
    diverging = (kinds.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                 .select("parent", F.lit(True).alias("split")))
    return lookup_join(kinds, diverging, "parent", "left")


def _nodes(kinds: DataFrame, block: int, summed: dict[str, Column]) -> DataFrame:
    """A row per node (id, parent, depth, conv_id, chars) and the sums of ``summed`` over its blocks.

    ``j`` counts the turns of a block up to the node. Turns of blocks that were ``split`` are
    grouped; those of the others are nodes as they are.
    """
    steps = kinds.withColumn("j", F.explode(F.sequence(F.lit(1), F.size("lens"))))

    def reached(j: Column) -> Column:
        return _h(F.concat("parent", F.substring("turns", F.lit(1), j * WIDTH)))

    j = F.col("j")
    rows = steps.select(
        F.when(j == F.size("lens"), F.col("id")).otherwise(reached(j)).alias("id"),
        F.when(j == 1, F.col("parent")).otherwise(reached(j - 1)).alias("parent"),
        (F.col("k") * block + j).alias("depth"), "conv_id", F.element_at("lens", j).alias("chars"),
        "split", *[value.alias(name) for name, value in summed.items()])
    alone = rows.filter("split is null").drop("split")
    refined = rows.filter("split").groupBy("id").agg(
        F.any_value("parent").alias("parent"), F.any_value("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.any_value("chars").alias("chars"),
        *[F.sum(name).alias(name) for name in summed])
    return alone.unionByName(refined)


def _subtree_sums(blocks: DataFrame, ended: DataFrame, shape: DataFrame, children: DataFrame, block: int) -> DataFrame:
    """Per block id: n_leaves, and saved_1 ... of the nodes in it.

    A conversation saves, in the subtree of a node on its path, the texts from that node to
    where its own nodes begin.
    """
    own = (shape.join(children, "id", "left").groupBy("conv_id")
           .agg(F.sum("chars").alias("own_chars"), F.max(F.col("n_children").isNull().cast("int")).alias("leaf")))
    shared = ended.filter("id is not null").join(own, "conv_id", "left").select(
        "conv_id", (F.col("chars") - F.coalesce("own_chars", F.lit(0))).alias("shared"),
        F.coalesce("leaf", F.lit(0)).alias("leaf"))
    passed = lookup_join(blocks.select("conv_id", "id", "lens", "before"), shared, "conv_id", "inner")

    def left(j: int) -> Column:
        inside = F.aggregate(F.slice("lens", 1, j - 1), F.lit(0).cast("long"), lambda total, x: total + x)
        return F.greatest(F.lit(0).cast("long"), F.col("shared") - F.col("before") - inside)
    return passed.groupBy("id").agg(
        F.sum("leaf").alias("n_leaves"), *[F.sum(left(j)).alias(f"saved_{j}") for j in range(1, block + 1)])


def _root(nodes: DataFrame, ended: DataFrame) -> DataFrame:
    every = ended.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    top = nodes.filter("depth = 1").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    # Two rows, one of each; the maximum of a column is the one value it has.
    both = every.unionByName(top, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns]).filter("n_convs > 0")
    return one.select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), "conv_id",
        "n_convs", F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"))


def _completed(nodes: DataFrame, children: DataFrame, ended: DataFrame) -> DataFrame:
    nodes = materialize(nodes)
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    placed = lookup_join(nodes, parents, "parent", "left")
    ends = _end_digests(ended.select(F.coalesce("id", F.lit(ROOT)).alias("id"), "conv_id"))
    nothing = F.lit(hashlib.sha256().hexdigest())
    return placed.join(children, "id", "left").join(ends, "id", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def _end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of each node where conversations end.

    Ids are sorted by range, which deals out the ids of one node as well, and put together
    in lists; what one task then has to take in per node are the few lists.
    """
    ordered = ends.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
    kind = ends.schema["conv_id"].dataType.simpleString()
    lists = ordered.mapInArrow(_listed, f"id binary, first {kind}, ids string")
    return lists.repartition("id").sortWithinPartitions("id", "first").mapInArrow(_digested, "id binary, ends_sha256 string")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple[bytes, int, list[str]]] = []
        for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not rows or rows[-1][0] != node or len(rows[-1][2]) >= LISTED:
                rows.append((node, conv, []))
            rows[-1][2].append(str(conv))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], batch.schema.field(1).type),
             pa.array([",".join(r[2]) for r in rows], pa.string())], ["id", "first", "ids"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                           pa.array([r[1].hexdigest() for r in rows], pa.string())],
                                          ["id", "ends_sha256"])
    current = None
    for batch in batches:
        done = []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if current is not None and current[0] == node:
                current[1].update(b"," + ids.encode())
            else:
                if current is not None:
                    done.append(current)
                current = (node, hashlib.sha256(ids.encode()))
        if done:
            yield batch_of(done)
    if current is not None:
        yield batch_of([current])
