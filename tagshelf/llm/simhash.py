"""SimHash near-dedup: fingerprints of shingles, linked within a Hamming distance.

Equal fingerprints are one row from the start. The distinct ones are dealt out by a
vantage-point tree: each goes to its home shard, and as a visitor to those shards on the
outer side of a boundary that the triangle inequality doesn't rule out. Within a shard, rings around two more
vantage points leave few pairs to compare. A shard hands on a spanning forest of its
links, never all pairs; the forests are joined by rounds of label exchange.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import lookup_join
from ..sources.scratch import materialize
from .common import ArrowFunction, by_value, fresh, id_and_text, texts_of

by_value(__name__)

SEED = 42
BITS = 64
# Fingerprints that a shard is to be the home of, on average.
SHARD_SIZE = 50_000
# Fingerprints (about so many, by a filter on their hash) that the tree of vantage points
# is built on: it only deals out rows, so its choice does not change what is found. The
# tree has at most 1/16 as many shards.
TREE_SAMPLE = 32_768


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp long) of each row of (doc_id, text); see ``fingerprint``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return id_and_text(docs).mapInArrow(_fingerprinter(words), f"doc_id {kind}, fp long")


def components(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp long, component_id): documents linked at ``distance`` or fewer differing bits.

    ``component_id`` is the smallest ``doc_id`` reachable by links, a row's own included.
    A NULL or empty text has fingerprint zero and is linked like any other. Repeated
    rows are repeated; rows of one id with different texts link separately. A NULL
    ``doc_id`` never names a component that has another id. No rows give none.
    """
    marked = materialize(fingerprints(docs, words))
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = links(distinct.select("fp"), distance)
    roots = connect(edges)
    known = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = known.withColumn("root", F.coalesce("root", "fp"))
    named = (rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    of_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return lookup_join(marked, of_fp, "fp")


def one_of_each(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` names their component, all columns as they are.

    Repeated rows of such an id stay as often as they are; of rows of one id those whose
    own text is in the component of that id. Rows without an id stay only where no row of
    their component has one.
    """
    found = components(docs, words, distance).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    name = fresh(docs, "kept")
    keep = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")


# ---- fingerprints ----------------------------------------------------------

def fingerprint(text: bytes, words: int = 4) -> int:
    """Unsigned 64-bit SimHash: a bit is set if it is in over half of the shingles' XXH64.

    Shingles are ``words`` words of the text with A-Z in lower case, joined by spaces, with
    repeats; a text of fewer words is one shingle, one without words has fingerprint 0.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    spans = zip(starts[:n].tolist(), ends[min(words, len(parts)) - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, max(1, n // 65_536)):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprinter(words: int) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, words) for t in texts_of(batch)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])
    return run


# ---- links -----------------------------------------------------------------

def links(distinct: DataFrame, distance: int) -> DataFrame:
    """(a, b) edges of a spanning forest of each shard: all fingerprints reachable from each
    other by links of ``distance`` or fewer bits are connected by them. ``distinct`` is (fp)."""
    tree = _plant(distinct)
    shards = len(tree[0]) + 1
    # A visitor is wanted in many shards, so they are dealt over blocks; homes go to all of them.
    blocks = max(1, math.ceil(1.6 ** math.log2(shards) / 16))
    dealt = distinct.mapInArrow(_dealer(tree, distance, blocks), "shard int, block int, fp long, home boolean")
    return (dealt.groupBy("shard", "block").applyInArrow(_linker(distance), "a long, b long"))


def _plant(distinct: DataFrame) -> tuple[list[int], list[int]]:
    """Vantage points and medians of a full binary tree, in heap order."""
    n = distinct.count()
    depth = max(0, math.ceil(math.log2(max(1, n / SHARD_SIZE))))
    depth = min(depth, int(math.log2(TREE_SAMPLE / 16)))
    if not depth:
        return [], []
    share = F.lit(int(min(1.0, TREE_SAMPLE / n) * 2 ** 32))
    rows = distinct.filter(F.pmod(F.xxhash64("fp"), F.lit(2 ** 32)) < share).collect()
    sample = np.sort(np.array([row.fp for row in rows], np.int64).view(np.uint64))
    sample = np.random.default_rng(SEED).permutation(sample)
    points, medians = [0] * (2 ** depth - 1), [0] * (2 ** depth - 1)
    groups = {0: sample}
    for node in range(2 ** depth - 1):
        own = groups.pop(node)
        points[node] = int(own[0]) if len(own) else int(xxhash.xxh64_intdigest(str(node)))
        far = np.bitwise_count(own ^ np.uint64(points[node])).astype(np.int64)
        medians[node] = int(np.median(far)) if len(own) else BITS // 2
        groups[2 * node + 1], groups[2 * node + 2] = own[far <= medians[node]], own[far > medians[node]]
    return points, medians


def _dealer(tree: tuple[list[int], list[int]], distance: int, blocks: int) -> ArrowFunction:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, found, home in routes(fps, tree, distance):
                own = found[home]
                block = (found[~home] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(blocks)
                values = np.concatenate([np.tile(own, blocks), found[~home]])
                at = np.concatenate([np.repeat(np.arange(blocks), len(own)), block.astype(np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), shard, np.int32)), pa.array(at.astype(np.int32)),
                     pa.array(values.view(np.int64)), pa.array(np.arange(len(values)) < len(own) * blocks)],
                    ["shard", "block", "fp", "home"])
    return run


def routes(fps: np.ndarray, tree: tuple[list[int], list[int]], distance: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per shard that is reached: its number, the fingerprints, and whether it is their home."""
    points, medians = tree
    stack = [(0, fps, np.ones(len(fps), bool))]
    while stack:
        node, own, home = stack.pop()
        if not len(own):
            continue
        if node >= len(points):
            yield node - len(points), own, home
            continue
        far = np.bitwise_count(own ^ np.uint64(points[node])).astype(np.int64)
        inside = far <= medians[node]
        # Of two homes on either side the inner one visits the outer; a visitor has to go
        # wherever a home within the distance may be.
        left = np.where(home, inside, far - distance <= medians[node])
        right = far + distance > medians[node]
        stack.append((2 * node + 1, own[left], home[left]))
        stack.append((2 * node + 2, own[right], (home & ~inside)[right]))


def _linker(distance: int):
    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        own, root = forest(fps, table.column("home").to_numpy(zero_copy_only=False), distance)
        return pa.table({"a": pa.array(own.view(np.int64)), "b": pa.array(root.view(np.int64))})
    return run


def forest(fps: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root of its tree) of all that are linked to a home within a shard."""
    if not len(fps):
        return fps, fps
    points = fps[[0, len(fps) // 2]]
    far = np.bitwise_count(fps[:, None] ^ points[None, :]).astype(np.int64)
    order = np.lexsort((far[:, 1], far[:, 0]))
    fps, home, ring = fps[order], home[order], far[order, 0] * (BITS + 1) + far[order, 1]
    label = np.arange(len(fps))
    cells, first = np.unique(ring, return_index=True)
    last = np.append(first[1:], len(fps))
    for cell, a, b in zip(cells.tolist(), first.tolist(), last.tolist()):
        rows = np.arange(a, b)[home[a:b]]
        if not len(rows):
            continue
        outer, inner = divmod(cell, BITS + 1)
        for other in range(max(0, outer - distance), min(BITS, outer + distance) + 1):
            low = other * (BITS + 1) + max(0, inner - distance)
            high = other * (BITS + 1) + min(BITS, inner + distance)
            c, d = np.searchsorted(ring, (low, high + 1)).tolist()
            step = max(1, 2_000_000 // max(1, len(rows)))
            for s in range(c, d, step):
                e = min(d, s + step)
                near = np.bitwise_count(fps[rows, None] ^ fps[None, s:e]) <= distance
                i, j = np.nonzero(near)
                i, j = rows[i], j + s
                merge(label, i[i != j], j[i != j])
    root = _settled(label)
    linked = root != np.arange(len(fps))
    return fps[linked], fps[root[linked]]


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of the pairs (i, j); labels point to smaller places."""
    while len(i):
        a, b = _roots(label, i), _roots(label, j)
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))


def _roots(label: np.ndarray, i: np.ndarray) -> np.ndarray:
    root = label[i]
    while (label[root] != root).any():
        root = label[root]
    label[i] = root
    return root


def _settled(label: np.ndarray) -> np.ndarray:
    while (label[label] != label).any():
        label = label[label]
    return label


# ---- components ------------------------------------------------------------

def connect(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each end of an edge (a, b) reaches.

    Alternates two rounds that point each node at the smallest of its neighbours, from
    the larger ones and from the smaller ones, until nothing changes. Every round is an
    aggregate and a join, written to the shared folder, and keeps at most one row per edge.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = _written(both)
    while True:
        now, after = _written(_small_star(_large_star(now)))
        if after == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = after


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    table = materialize(edges)
    state = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return table, tuple(state)


def _large_star(edges: DataFrame) -> DataFrame:
    """Point the larger neighbours of each node at its smallest neighbour (or itself)."""
    sides = edges.union(edges.select("b", "a"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (sides.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Point the smaller neighbours of each node, and the node, at the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
